import random

import numpy as np

from seriesloom.llm import neardup

from .support import ODD_TEXTS, documents, lower, words


def shingles(text, size):
    w = words(lower(text))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def expected(texts, size, percent=80):
    sets = [shingles(t, size) for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return {i: (len(s), root(i), root(i) == i) for i, s in enumerate(sets)}


def corpus(rng):
    vocabulary = [f"w{i}" for i in range(400)]
    texts = list(ODD_TEXTS)
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((3, 12, 60, 150)))]
        for _ in range(rng.choice((1, 2, 6))):
            copy = list(base)
            for _ in range(rng.randrange(1 + len(base) // 12)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    # a chain of near copies whose ends are unlike each other
    chain = [rng.choice(vocabulary) for _ in range(100)]
    for step in range(12):
        chain[step * 4] = f"new{step}"
        texts.append(" ".join(chain))
    rng.shuffle(texts)
    return texts


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 3)
    monkeypatch.setattr(neardup, "FAMILY_BLOCK", 2)
    texts = corpus(random.Random(5))
    docs = documents(spark, texts).withColumnRenamed("source", "node").repartition(3)
    # cells that span Arrow batches
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    for size in (2, 5):
        got = {r.doc: (r.n_shingles, r.component, r.kept) for r in neardup.near_duplicates(docs, size=size).collect()}
        assert got == expected(texts, size)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = pool[:2000], pool[500:2500]
    one, other = neardup.registers(a), neardup.registers(b)
    assert (neardup.merged(one, other) == neardup.registers(np.union1d(a, b))).all()
    guess = neardup.estimated(one[None], other[None], np.array([2000]), np.array([2000]))[0]
    assert abs(guess - 0.6) < 0.15
    assert neardup.estimated(one[None], one[None], np.array([9]), np.array([9]))[0] == 1


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = documents(spark, ["a b c d e f", "a b c d e f", None])
    docs = docs.union(docs).union(docs.selectExpr("cast(null as long)", "text", "lang", "source", "n_chars"))
    rows = sorted((str(r.doc), r.component, r.kept) for r in neardup.near_duplicates(docs).collect())
    assert rows == sorted([("0", 0, True), ("1", 0, False), ("2", 2, True)] * 2 + [("None", None, True)] * 3)
    left = neardup.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == ["0", "2", "None", "None"]
    assert neardup.near_duplicates(docs.limit(0)).count() == 0
