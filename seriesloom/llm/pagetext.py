"""Main text of web pages by paths on which the pages of a host agree.

Each page's containers are scored by the text they hold without links; the page votes for the path of the container
that holds its article. A path is the chain of tags and classes from the body, digits generalised. Votes are
counted per host; paths with at least ``share`` of a host's votes win, so a host has at most ``1 / share`` of
them. Every page is then read again with the first winning path that it has, or, where it has none, with its own vote.

Text is left out of elements that say by tag, role, class, id or style that they are menus, headers, footers,
sidebars, notices, adverts, forms, comments of readers or hidden. A header inside an article stays, since it holds
the title. Blocks are what block-level tags enclose; line breaks and other white space inside them become one space.

Votes are summed before they are shuffled, so a host of any size is many small counts. The winners are stored and
measured: up to ``BROADCAST_CHARS`` they are broadcast and no page is moved, beyond it pages and winners are joined by
host, where Spark splits a hot host.

Defined results: a null or empty page gives an empty text, a null or malformed address belongs to the host
``''``; repeated rows vote and return one by one; ties between paths go to the one that sorts first; markup
that is never closed ends with the page; pages of any length are read whole; an empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import mapped, stored

#: Winning paths up to this size, by count of characters, are sent to all tasks; larger ones are joined by shuffle.
BROADCAST_CHARS = 8 << 20

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup; it is skipped up to the end tag.
_RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
_LEFT_OUT = frozenset(
    "nav footer aside form button select option noscript template svg math object canvas audio video dialog menu".split()
)
_CONTAINERS = frozenset(
    "html body main article section div header footer nav aside form table tbody thead tfoot tr td th ul ol dl li dd "
    "details figure fieldset blockquote center".split()
)
_BLOCKS = _CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 pre address hr dt figcaption summary caption legend hgroup".split()
)
#: An element of these that is still open ends where one of the same group starts, if no list or table lies between.
_SIBLINGS = {"li": ("li",), "tr": ("tr",)} | dict.fromkeys(("dt", "dd"), ("dt", "dd"))
_SIBLINGS |= dict.fromkeys(("td", "th"), ("td", "th"))
_BOUNDS = frozenset("ul ol dl table article main body".split())

#: Words of a class, id or role that say what an element is for.
_BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc sidebar sidebars rail aside complementary "
    "header masthead topbar footer contentinfo cookie cookies consent gdpr notice notices alert popup modal overlay dialog "
    "comment comments disqus replies respond share sharing social newsletter subscribe signup login search form "
    "related recommended recommendations widget widgets hidden".split()
)
_STARTS = ("advert", "breadcrumb", "comment", "cookie", "newsletter", "sidebar")
_HARMLESS = frozenset("has with no without is".split())
_STATED = re.compile(r"\b(?:class|id|role|hidden|style)\b", re.I)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'=<>`]+))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")


class Node(NamedTuple):
    parent: int
    path: str
    tag: str


class Block(NamedTuple):
    node: int
    text: str
    linked: int
    title: bool


def _attributes(raw: str) -> dict[str, str]:
    if not _STATED.search(raw):
        return {}
    return {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(raw)}


def _is_boilerplate(tag: str, given: dict[str, str], in_article: bool) -> bool:
    if tag in _LEFT_OUT or tag == "header" and not in_article:
        return True
    if "hidden" in given or given.get("aria-hidden") == "true" or _UNSEEN.search(given.get("style", "")):
        return True
    if tag in ("html", "body", "main", "article") and given.get("role", "") in ("", "main", "article"):
        names = [n for n in given.get("class", "").split() if n.lower() in ("comment", "comments", "ad")]
        return bool(names) and tag == "article"
    for name in (given.get(k, "") for k in ("class", "id", "role")):
        for part in name.split():
            words = [w.lower() for w in _WORD.findall(part)]
            if not words or words[0] in _HARMLESS:
                continue
            said = {w for w in words if w in _BOILERPLATE or w.startswith(_STARTS)}
            if said and not (in_article and said == {"header"}):
                return True
    return False


def _label(tag: str, given: dict[str, str]) -> str:
    """Tag and classes, or the id where there is no class; digits count alike."""
    names = given.get("class", "").split() or given.get("id", "").split()
    return ".".join([tag, *sorted({re.sub(r"\d+", "#", n.lower()) for n in names})])


def _tag_end(page: str, at: int) -> int:
    """Where the tag that starts at ``at`` ends; a ``>`` in quotes does not end it, unless the quote stays open."""
    plain = end = page.find(">", at)
    quote = _QUOTE.search(page, at, end + 1) if end >= 0 else None
    while quote:
        close = page.find(quote[0][-1], quote.end())
        if close < 0:
            return plain
        end = page.find(">", close)
        if end < 0:
            return plain
        quote = _QUOTE.search(page, close + 1, end + 1)
    return end


_QUOTE = re.compile(r"""=\s*["']""")


class Page:
    """Containers and blocks of a page, boilerplate left out."""

    def __init__(self, page: str):
        self.nodes = [Node(-1, "body", "body")]
        self.blocks: list[Block] = []
        # open elements: tag, container, whether text below is left out, whether it is a link
        self._open: list[tuple[str, int, bool, bool]] = []
        self._text: list[str] = []
        self._linked = 0
        self._read(page)
        self._flush()

    def _top(self) -> tuple[str, int, bool, bool]:
        return self._open[-1] if self._open else ("body", 0, False, False)

    def _flush(self) -> None:
        if self._text:
            text = " ".join(html.unescape("".join(self._text)).split())
            if text:
                title = any(e[0] == "h1" for e in self._open[-3:])
                self.blocks.append(Block(self._top()[1], text, self._linked, title))
            self._text, self._linked = [], 0

    def _add(self, text: str) -> None:
        _, _, left_out, link = self._top()
        if text and not left_out:
            self._text.append(text)
            if link:
                self._linked += len(text)

    def _pop_to(self, tags: Sequence[str], bounds: frozenset[str]) -> None:
        """Close the nearest open element of the tags and all inside it, unless a bound lies between."""
        for k in range(len(self._open) - 1, -1, -1):
            tag = self._open[k][0]
            if tag in tags:
                if tag in _BLOCKS:
                    self._flush()
                del self._open[k:]
                return
            if tag in bounds:
                return

    def _start(self, tag: str, raw: str) -> None:
        if tag == "br":
            self._add(" ")
            return
        block = tag in _BLOCKS
        if block:
            self._flush()
            self._pop_to(("p",), _CONTAINERS)
            if tag in _SIBLINGS:
                self._pop_to(_SIBLINGS[tag], _BOUNDS)
        if tag in _VOID or tag in ("html", "head", "body"):
            return
        _, node, left_out, link = self._top()
        if not left_out:
            given = _attributes(raw)
            in_article = any(e[0] in ("article", "main") for e in self._open)
            left_out = _is_boilerplate(tag, given, in_article)
            if left_out:
                if raw.endswith("/") and tag in ("svg", "math"):
                    return
            elif tag in _CONTAINERS:
                path = f"{self.nodes[node].path}>{_label(tag, given)}"
                self.nodes.append(Node(node, path, tag))
                node = len(self.nodes) - 1
        if block or left_out or tag == "a":
            self._open.append((tag, node, left_out, link or tag == "a"))

    def _end(self, tag: str) -> None:
        if tag in _CONTAINERS:
            self._flush()
            self._pop_to((tag,), frozenset())
        elif tag in _BLOCKS:
            self._flush()
            self._pop_to((tag,), _CONTAINERS)
        else:
            self._pop_to((tag,), _CONTAINERS - {tag} if tag not in _LEFT_OUT else frozenset())

    def _read(self, page: str) -> None:
        at, last = 0, page.rfind(">")
        while True:
            start = page.find("<", at)
            if start < 0:
                self._add(page[at:])
                return
            self._add(page[at:start])
            following = page[start + 1 : start + 2]
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                at = end + 3
                if end < 0:
                    return
                continue
            letter = following.isascii() and following.isalpha()
            if start > last or not (letter or following in ("/", "!", "?")):
                # no tag begins here; one that is cut off by the end of the page is dropped
                if letter:
                    return
                self._add("<")
                at = start + 1
                continue
            name = _NAME.match(page, start + 1 + (following == "/"))
            if name is None:
                at = page.find(">", start) + 1
                continue
            end = _tag_end(page, name.end())
            tag = name[0].lower()
            at = end + 1
            if following == "/":
                self._end(tag)
            elif tag in _RAW:
                # a raw element never holds text of the article
                found = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
                if found is None:
                    return
                at = page.find(">", found.end()) + 1 or len(page)
            else:
                self._start(tag, page[name.end() : end])

    def _below(self, chosen: set[int]) -> list[Block]:
        inside = set(chosen)
        for i, node in enumerate(self.nodes):
            if node.parent in inside:
                inside.add(i)
        return [b for b in self.blocks if b.node in inside]

    def vote(self) -> int:
        """The container that holds the article.

        Scores are characters without links, summed up the tree. From the body the search goes down while one child
        holds most of the score and keeps the title; if an article element lies on the way or below, it is taken.
        """
        score = [0] * len(self.nodes)
        titles = [0] * len(self.nodes)
        for block in self.blocks:
            score[block.node] += max(len(block.text) - 3 * block.linked, 0)
            titles[block.node] += block.title
        children: dict[int, list[int]] = {}
        for i in range(len(self.nodes) - 1, 0, -1):
            parent = self.nodes[i].parent
            score[parent] += score[i]
            titles[parent] += titles[i]
            children.setdefault(parent, []).append(i)
        articles = [i for i, n in enumerate(self.nodes) if n.tag == "article" and score[i]]
        if articles:
            return max(articles, key=lambda i: (score[i], -i))
        at = 0
        while at in children:
            best = max(children[at], key=lambda i: (score[i], -i))
            if 5 * score[best] < 3 * score[at] or not score[best] or titles[at] and not titles[best]:
                break
            at = best
        # rows, cells and items are parts of a list or table
        while self.nodes[at].tag in ("tr", "td", "th", "tbody", "thead", "tfoot", "li", "dd"):
            at = self.nodes[at].parent
        return at

    def text(self, paths: Sequence[str]) -> str:
        """Blocks below the first of the paths that has text, else below the page's own vote."""
        for path in paths:
            chosen = {i for i, n in enumerate(self.nodes) if n.path == path}
            blocks = self._below(chosen) if chosen else []
            if blocks:
                return "\n\n".join(b.text for b in blocks)
        return "\n\n".join(b.text for b in self._below({self.vote()}))


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = []
        for cell in batch.column(1):
            page = Page(cell.as_py())
            paths.append(page.nodes[page.vote()].path if page.blocks else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.string())], ["host", "path"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column("paths").to_pylist()
        texts = [
            Page(cell.as_py()).text(own or []) if cell.is_valid else ""
            for cell, own in zip(batch.column("html"), paths, strict=True)
        ]
        kept = [batch.column("key"), batch.column("url")]
        lengths = pa.array([len(t) for t in texts], pa.int64())
        columns = [*kept, pa.array(texts, pa.string()), lengths]
        yield pa.RecordBatch.from_arrays(columns, ["key", "url", "text", "n_chars"])


def winning_paths(pages: DataFrame, share: float = 0.05) -> DataFrame:
    """Per ``host`` its ``paths``, most votes first, from pages (host, html)."""
    votes = mapped(pages.where("html is not null").select("host", "html"), _votes, "host string, path string")
    counts = votes.where("path is not null").groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("host").agg(F.sum("n").alias("total"))
    best = counts.join(totals, "host").where(F.col("n") >= F.lit(share) * F.col("total"))
    # at most 1 / share entries
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "path")))
    return best.groupBy("host").agg(ranked.alias("_ranked")).select("host", F.col("_ranked.path").alias("paths"))


def main_text(
    pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html", share: float = 0.05
) -> DataFrame:
    """Per page ``key``, ``url``, ``text`` (blocks joined by an empty line) and ``n_chars``."""
    address = F.col(f"`{url}`")
    host = F.lower(F.regexp_extract(address, r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(
        F.col(f"`{key}`").alias("key"), address.alias("url"), F.coalesce(host, F.lit("")).alias("host"),
        F.col(f"`{html}`").alias("html"),
    )
    winners = stored(winning_paths(rows, share))
    size = winners.agg(F.sum(F.length("host") + F.length(F.array_join("paths", "")) + 100)).first()[0] or 0
    known = rows.join(F.broadcast(winners) if size <= BROADCAST_CHARS else winners, "host", "left")
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, url string, text string, n_chars long"
    return mapped(known.select("key", "url", "html", "paths"), _texts, schema)
