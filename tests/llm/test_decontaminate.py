import random
from collections import Counter

from seriesloom.llm import decontaminate as D

from .support import ODD_TEXTS, documents, lower, words


def multiset(w, width):
    return Counter(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def alike(one, other):
    weight = lambda s: sum(len(x.encode()) for x in s)
    both = sum(min(n, other[s]) * weight(s) for s, n in one.items())
    return both / (sum(n * weight(s) for s, n in (one + other).items()) - both) if both else 0.0


def expected(texts, items, least=0.8):
    out = {}
    for doc, text in enumerate(texts):
        w = words(lower(text))
        for number, item in items:
            v = words(lower(item))
            width = min(5, len(v))
            n = min(len(v), len(w))
            if not v or not w:
                continue
            best = max((alike(multiset(w[i : i + n], width), multiset(v, width)) for i in range(len(w) - n + 1)), default=0)
            if best >= least:
                out[doc, number] = round(best, 9)
    return out


def case(rng):
    vocabulary = [f"v{i}" * (1 + i % 3) for i in range(200)]
    pick = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(pick(rng.choice((1, 3, 5, 20, 45))))) for i in range(25)]
    texts = list(ODD_TEXTS)
    for _ in range(150):
        w = words(rng.choice(items)[1])
        for _ in range(rng.choice((0, 0, 1, 2, 4))):
            kind, at = rng.randrange(3), rng.randrange(len(w) + 1)
            w[at : at + (kind > 0)] = pick(kind < 2)
        texts.append(" ".join(pick(rng.randrange(40)) + [x.upper() for x in w] + pick(rng.randrange(40))))
    return texts, [*items, (None, None), (99, ""), (98, "solo")]


def test_against_brute_force(spark):
    texts, items = case(random.Random(8))
    docs = documents(spark, texts).withColumnRenamed("lang", "item_id").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc, r.item): round(r.similarity, 9) for r in D.matches(docs, benchmark).collect()}
    assert got == expected(texts, items)
    left = D.clean(docs, benchmark)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == set(range(len(texts))) - {d for d, _ in got}


def test_blocks_give_the_same(spark, monkeypatch):
    texts, items = case(random.Random(9))
    docs, benchmark = documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(str, D.matches(docs, benchmark).collect()))
    monkeypatch.setattr(D, "BLOCK_BYTES", 400)
    assert sorted(map(str, D.matches(docs, benchmark).collect())) == whole


def test_index_finds_all_within_radius():
    rng = random.Random(1)
    index = D.Index([(i, " ".join(str(rng.random()) for _ in range(20))) for i in range(60)], 5)
    _, known, _ = index.tables[20]
    import numpy as np

    prints = np.unpackbits(known, axis=1)
    for row in prints:
        row[rng.sample(range(128), D.RADIUS)] ^= 1
    got = {(a, i) for a, i, _ in index.near(20, np.packbits(prints, axis=1))}
    assert {(i, i) for i in range(60)} <= got


def test_empty_tables(spark):
    docs, benchmark = documents(spark, ["a b c"]), spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert D.matches(docs.limit(0), benchmark).count() == 0
    assert D.matches(docs, benchmark.limit(0)).count() == 0
    assert D.clean(docs, benchmark.limit(0)).count() == 1
    assert D.clean(docs, benchmark).count() == 0


def test_runs_of_one_word_lose_no_match():
    import pyarrow as pa

    found = 0
    rng = random.Random(6)
    for length, run in ((300, 32), (200, 21), (150, 16)):
        for _ in range(10):
            item = [f"w{rng.randrange(10**6)}" for _ in range(length)]
            at = rng.randrange(length - 2 * run)
            item[at : at + run] = ["--"] * run
            other = list(item)
            other[at : at + run] = ["||"] * run
            texts = [" ".join([*["before"] * 7, *other, *["after"] * 9])]
            items = [(0, " ".join(item))]
            got = list(D.Index(items, 5).matches(pa.array(texts), 0.8))
            found += len(got)
            assert {(d, i): round(alike, 9) for d, i, _, _, alike, _ in got} == expected(texts, items)
    assert found == 30


def test_moving_sums_number_repeats_within_each_window():
    import pyarrow as pa

    from seriesloom.llm import text as X

    rng = random.Random(7)
    words_ = [rng.choice("abcd") * rng.randrange(1, 3) for _ in range(5000)]
    index = D.Index([(i, " ".join(words_[i * 40 : i * 40 + 12])) for i in range(120)], 2)
    w = X.words(X.lowered(X.column_bytes(pa.array([" ".join(words_)]))))
    shingles, weights = X.grams(w.hashes, 2), D._weights(w, 2)
    zero = {(at, i) for at, i, distance in index._windows(12, shingles, weights, 11) if distance == 0}
    assert {(i * 40, i) for i in range(120)} <= zero
