import math
import random
from collections import Counter
from fractions import Fraction

import pytest

from seriesloom.llm import quality

from .support import ODD_TEXTS, documents, words


def expected(text):
    w = words(text)
    runs = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if runs[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def test_measures_against_brute_force(spark):
    rng = random.Random(3)
    texts = [*ODD_TEXTS, *(" ".join(rng.choice("abc\n") for _ in range(rng.randrange(60))) for _ in range(300))]
    docs = documents(spark, texts).repartition(3)
    got = {r.doc_id: r["_measures"].asDict() for r in quality.with_measures(docs).collect()}
    for i, text in enumerate(texts):
        want = expected(text)
        assert {k: got[i][k] for k in want} == want, repr(text)[:80]


def test_binomial_bound_is_exact():
    assert quality.binomial_at_most(0, 300, 0.01) == pytest.approx(0.99**300)
    assert quality.binomial_at_most(5, 5, 0.2) == 1.0
    assert quality.binomial_at_most(1, 3, 0.5) == pytest.approx(0.5)


def test_cutoff_stops_at_the_first_failure():
    pick = quality.certified_cutoff
    assert pick([3, 2, 1], [0, 0, 40], [5, 9, 90], 1000, 0.01, 0.01) == 2
    assert pick([3, 2, 1], [0, 40, 0], [5, 9, 90], 1000, 0.01, 0.01) == 3
    assert pick([3, 2, 1], [0, 0, 0], [5, 9, 90], 20, 0.01, 0.01) is None
    assert pick([3, 2], [0, 0], [0, 0], 1000, 0.01, 0.01) is None
    assert pick([3], [0], [1], 0, 0.01, 0.01) is None


def test_rules_catch_junk_and_keep_the_rest(spark):
    good = [f"plain words number {i} and some more of them to read here" for i in range(2000)]
    junk = [" ".join(f"$$${i}" for _ in range(3)) + f" a{i} b c d e f g h ### |||" for i in range(200)]
    docs = documents(spark, [*good, *junk, None, "short"])
    labels = spark.createDataFrame([(i, int(i < 2000), 0) for i in range(2200)], "doc_id long, quality int, toxic int")
    out = quality.judged(docs.withColumn("_extra", docs.doc_id), labels, alpha=0.01).collect()
    kept = {r.doc_id for r in out if r["_kept"]}
    assert kept == set(range(2000))
    none = quality.judged(docs, labels.where("false")).collect()
    assert {r.doc_id for r in none if r["_kept"]} == set(range(2200))
    left = quality.accepted(docs, labels)
    assert left.columns == docs.columns and left.count() == 2000


def verdicts(texts, langs, labels, alpha=0.01, delta=0.05):
    """Which texts stay, by the definition: exact sums of fractions, one trial for each text of a language."""
    rows = []
    for text in texts:
        m = expected(text)
        lines = [line for line in (text or "").split("\n") if words(line)]
        m |= {
            "n_lines": len(lines),
            "n_upper": sum("A" <= c <= "Z" for c in text or ""),
            "n_letters": sum("A" <= c <= "Z" or "a" <= c <= "z" for c in text or ""),
            "n_shouts": (text or "").count("!"),
            "n_digits": sum("0" <= c <= "9" for c in text or ""),
        }
        rows.append(m)
    failed = [m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"] for m in rows]

    def over(i, rule, cutoff):
        top, bottom, _ = quality.RULES[rule]
        return rows[i][bottom] > 0 and rows[i][top] / rows[i][bottom] > cutoff

    trials = {}
    for doc, mark in labels:
        if doc is not None and 0 <= doc < len(texts) and mark in (0, 1) and not failed[doc]:
            trials.setdefault(langs[doc], {}).setdefault(texts[doc], (doc, set()))[1].add(mark)
    level = Fraction(delta) / (max(len(trials), 1) * len(quality.RULES))
    a = Fraction(alpha)
    cut = {}
    for lang, group in trials.items():
        good = [d for d, marks in group.values() if marks == {1}]
        bad = [d for d, marks in group.values() if marks == {0}]
        for rule, (_, _, grid) in quality.RULES.items():
            best = 0
            for cutoff in grid:
                lost = sum(over(d, rule, cutoff) for d in good)
                n = len(good)
                tail = sum(math.comb(n, k) * a**k * (1 - a) ** (n - k) for k in range(lost + 1))
                if n == 0 or lost > a * n or tail > level:
                    break
                gain = sum(over(d, rule, cutoff) for d in bad) - quality.GOOD_WEIGHT * lost
                if gain > best:
                    best, cut[lang, rule] = gain, cutoff
    return [
        not failed[i] and not any(over(i, r, cut[langs[i], r]) for r in quality.RULES if (langs[i], r) in cut)
        for i in range(len(texts))
    ]


def marked(rng, n, junk):
    """Documents and labels with repeats, conflicts and labels of nothing."""
    texts = [f"plain text number {i} with {rng.choice('!abc')} more of them to read here today" for i in range(n)]
    texts += [f"LOUD!! $$$ ### {i} " + " ".join(rng.choice(["a", "B!", "||", "7"]) for _ in range(12)) for i in range(junk)]
    labels = [(i, int(i < n)) for i in range(n + junk)]
    labels += [rng.choice(labels) for _ in range(300)] + [(3, 0), (4, None), (5, 7), (None, 1), (10**6, 1)]
    texts += [texts[rng.randrange(n)] for _ in range(100)]
    labels += [(len(texts) - 1, 0), (len(texts) - 2, 1)]
    return texts, labels


@pytest.mark.parametrize(("n", "junk"), [(30, 30), (900, 120), (2500, 100)])
def test_verdicts_against_their_definition(spark, n, junk):
    rng = random.Random(n)
    texts, labels = marked(rng, n, junk)
    langs = [rng.choice(["en", "en", "en", "de", None]) for _ in texts]
    rows = [(i, t, lang) for i, (t, lang) in enumerate(zip(texts, langs, strict=True))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.doc_id: r["_kept"] for r in quality.judged(docs, marks).collect()}
    assert [got[i] for i in range(len(texts))] == verdicts(texts, langs, labels)


def test_repeated_labels_prove_nothing(spark):
    good = [f"plain words number {i} and some more of them to read here" for i in range(30)]
    junk = [f"$$${i} $$$ $$$ a{i} b c d e f g h ### |||" for i in range(30)]
    docs = documents(spark, good + junk)
    labels = spark.createDataFrame([(i, int(i < 30)) for i in range(60)] * 32, "doc_id long, quality int")
    assert quality.accepted(docs, labels).count() == 60
    # nor do repeated documents
    many = documents(spark, (good + junk) * 32)
    labels = spark.createDataFrame([(i, int(i % 60 < 30)) for i in range(60 * 32)], "doc_id long, quality int")
    assert quality.accepted(many, labels).count() == 60 * 32


def test_empty_tables_and_null_strata(spark):
    labels = spark.createDataFrame([(1, 1), (None, 0), (1, None)], "doc_id long, quality int")
    docs = documents(spark, ["ten words are in this text so that it stays", None], lang=None)
    assert [r["_kept"] for r in quality.judged(docs, labels).orderBy("doc_id").collect()] == [True, False]
    assert quality.judged(docs.limit(0), labels).count() == 0
