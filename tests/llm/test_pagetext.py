"""Main text of pages: small pages with stated results, votes of hosts, and the given pages read by a plain pattern."""

import html
import re

import pytest
from pyspark.sql import functions as F

from seriesloom.llm import pagetext, queries

FOLDER = "/root/testdata/sf0.001"
LONG = "Some words of a long paragraph, which goes on and on. "


def text(page, paths=()):
    return pagetext.Page(page).text(paths)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", ""),
        ("plain text only", "plain text only"),
        ("<p>a&amp;b&nbsp;&#233; &lt;p&gt;<p>c<br>d  \n e", "a&b é <p>\n\nc d e"),
        ("<article><header class='entry-header'><h1>T</h1></header><p>x</article><footer>f", "T\n\nx"),
        ("<header>H</header><main><p>x</p><aside>s</aside><form><p>f</p><input></form></main>", "x"),
        ("<article><p>x<section id=comments><p>c</section><ol class=commentlist><li>d</ol><p>y", "x\n\ny"),
        ("<article><p>in <b>bold <i>it</p><p>next</article>", "in bold it\n\nnext"),
        ("<article><p>a <span class='ad'>buy <span>now</span> x</span> b</p></article>", "a b"),
        ("<article><div class='cookie-notice'>c</div><div class='has-sidebar'><p>kept</div>", "kept"),
        ("<article>a<script>if (1<2) '</p>'</script>b<style>p{}</style><!-- <p>no --> c</article>", "ab c"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>x<td>y<tr><td>z</table></article>", "one\n\ntwo\n\nx\n\ny\n\nz"),
        ("<article><p title='a>b'>x</p><p title='open>y</p></article>", "x\n\ny"),
        ("<article><p>1 < 2 & 3 <4 </p></article>", "1 < 2 & 3 <4"),
        ("<article>cut <p>off<", "cut\n\noff<"),
        ("<article><p>x<div style='display:none'>h</div><div hidden>h</div><p>y</article>", "x\n\ny"),
        ("<script>never closed <article>x</article>", ""),
        ("<nav><a href=/>home</a></nav><div><a href=/>" + LONG + "</a></div><div><p>" + LONG + "</div>", LONG.strip()),
        ("<body><h1>T</h1><div>" + LONG + "</div></body>", "T\n\n" + LONG.strip()),
    ],
)
def test_page(page, want):
    assert text(page) == want


def test_long_and_hostile_pages():
    assert text("<article>" + "<p>x</p>" * 20_000).count("x") == 20_000
    assert text("<article>" + "<div>" * 3000 + "deep") == "deep"
    for page in ("<a" * 50_000, '<a "' * 20_000 + ">", "<" * 50_000, "<!--" * 20_000, "&" * 50_000):
        text(page)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


@pytest.mark.parametrize("limit", [8 << 20, 0])
def test_host_agrees_on_a_path(spark, monkeypatch, limit):
    monkeypatch.setattr(pagetext, "BROADCAST_CHARS", limit)
    page = "<div class='story-{}'><h1>T{}</h1><p>{}</div><div class='box'><p>{}</div>"
    rows = [(i, f"http://User@Host.example:80/{i}", page.format(i, i, LONG * 5, "box")) for i in range(30)]
    # by itself this page would vote for the box
    odd = f"<div class='story-7'><p>short</div><div class='box'><p>{LONG * 9}</div>"
    rows += [(30, "https://host.example/x", odd), (31, "https://other.example/x", odd)]
    rows.append((32, None, "<p>no address"))
    rows.append((33, "http://host.example", "<div class='plain'>another kind of page</div>"))
    got = {r["key"]: r["text"] for r in pagetext.main_text(pages(spark, rows)).collect()}
    assert got[30] == "short" and got[31] == (LONG * 9).strip()
    assert got[32] == "no address" and got[33] == "another kind of page" and got[4].startswith("T4\n\nSome")
    winners = pagetext.winning_paths(pages(spark, rows).withColumn("host", F.lit("h"))).collect()
    assert winners[0]["paths"][0] == "body>div.story-#"


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "http://a.b", None), (1, "http://a.b", ""), (None, "http://a.b", "<p>x"), (None, "http://a.b", "<p>x")]
    df = pages(spark, rows)
    for extra in ("key", "host", "paths", "n", "path", "total", "text", "n_chars"):
        df = df.withColumn(extra, F.lit(1))
    got = sorted((tuple(r) for r in pagetext.main_text(df).collect()), key=repr)
    want = [(1, "http://a.b", "", 0)] * 2 + [(None, "http://a.b", "x", 1)] * 2
    assert got == sorted(want, key=repr)
    assert pagetext.main_text(df.limit(0)).collect() == []


def test_given_pages(spark):
    given = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "html")
    for row in queries.op12_pagetext(spark, FOLDER).join(given, "page_id").collect():
        article = re.search(r"<article>(.*)</article>", row["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert row["text"] == "\n\n".join(filter(None, blocks)) and row["n_chars"] == len(row["text"])
