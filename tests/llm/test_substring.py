import random

import numpy as np

from seriesloom.llm import substring
from seriesloom.llm.fmindex import WaveletMatrix, WindowIndex

from .support import ODD_TEXTS, documents, words


def expected(texts, window):
    first, out = {}, {}
    split = [words(t) for t in texts]
    for doc, w in enumerate(split):
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), doc)
    for doc, w in enumerate(split):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < doc:
                gone.update(range(i, i + window))
        out[doc] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def corpus(rng):
    vocabulary = [f"w{i}" for i in range(60)]
    pick = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [pick(rng.choice((5, 13, 14, 30, 80))) for _ in range(12)]
    texts = list(ODD_TEXTS)
    for _ in range(120):
        parts = []
        for _ in range(rng.randrange(6)):
            passage = rng.choice(passages)
            parts.append(pick(rng.randrange(20)) if rng.random() < 0.5 else passage[rng.randrange(4) :])
        text = " ".join(x for p in parts for x in p)
        texts += [text] * rng.choice((1, 1, 1, 3))
    texts.append("same " * 500)
    texts.append("\tsame\n" * 300 + "other")
    rng.shuffle(texts)
    return texts


def run(spark, texts, window):
    docs = documents(spark, texts).withColumnRenamed("source", "spans").repartition(3)
    out = substring.without_repeats(docs, window=window)
    assert out.columns == [*docs.columns, "_n_words", "_n_removed", "_kept"]
    return {r.doc_id: (r["_n_words"], r["_n_removed"], r["_kept"]) for r in out.collect()}


def test_against_brute_force(spark, monkeypatch):
    texts = corpus(random.Random(6))
    assert run(spark, texts, 13) == expected(texts, 13)
    assert run(spark, texts, 50) == expected(texts, 50)
    # anchors split by window, and many small indices
    monkeypatch.setattr(substring, "HOT", 2)
    monkeypatch.setattr(substring, "BLOCK_BYTES", 2000)
    assert run(spark, texts, 13) == expected(texts, 13)


def test_narrow_form_is_the_same(spark):
    texts = corpus(random.Random(7))[:60]
    docs = documents(spark, texts)
    out = substring.without_repeats(docs, window=13, carry=["doc_id"])
    got = {r.doc_id: (r["_n_words"], r["_n_removed"], r["_kept"]) for r in out.collect()}
    assert got == expected(texts, 13)


def test_ranks_and_windows():
    rng = np.random.default_rng(3)
    sequence = rng.integers(0, 37, 1000)
    matrix = WaveletMatrix(sequence, 37)
    for at in (0, 1, 63, 64, 65, 500, 1000):
        counts = np.bincount(sequence[:at], minlength=37)
        assert (matrix.rank(np.arange(37), np.full(37, at)) == counts).all()
    segments = [rng.integers(0, 4, n).astype(np.uint64) for n in (1, 3, 4, 9, 30, 200, 0)]
    first = np.concatenate(([0], np.cumsum([len(s) for s in segments])))
    for window in (1, 3, 4, 7):
        index = WindowIndex(np.concatenate(segments), first, window)
        values = np.array([5, 3, 9, 1, 8, 7, 0])
        got, begin = index.least(values)
        have = {}
        for value, s in zip(values, segments):
            for i in range(len(s) - window + 1):
                have.setdefault(tuple(s[i : i + window]), []).append(value)
        want = [min(have[tuple(s[i : i + window])]) for s in segments for i in range(len(s) - window + 1)]
        assert got.tolist() == want and begin[-1] == len(want)


def test_null_ids_repeated_rows_and_empty_table(spark):
    long = " ".join(map(str, range(20)))
    docs = documents(spark, ["x", long, long])
    docs = docs.union(docs).union(docs.selectExpr("cast(null as long)", "text", "lang", "source", "n_chars"))
    rows = sorted((str(r.doc_id), r["_n_removed"]) for r in substring.without_repeats(docs, window=13).collect())
    assert rows == sorted([("0", 0), ("1", 0), ("2", 20)] * 2 + [("None", 0)] * 3)
    narrow = substring.without_repeats(docs, window=13, carry=["doc_id"])
    assert sorted((str(r.doc_id), r["_n_removed"]) for r in narrow.collect()) == rows
    assert substring.without_repeats(docs.limit(0), window=13).count() == 0


def test_texts_are_shuffled_once(spark, tmp_path):
    documents(spark, corpus(random.Random(1))[:40]).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = substring.without_repeats(docs, window=13, carry=["doc_id"])._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.split("\n")
    shuffled = [
        line for i, line in enumerate(lines)
        if "- Exchange hashpartitioning(doc#" in line and "AS body#" in lines[i + 1]
    ]
    assert len(shuffled) == 1
