import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from seriesloom.llm import hmm

from .support import ODD_TEXTS, documents, lower, words


def base(texts):
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    counts = Counter()
    for out, text in zip(held, texts):
        if not out:
            counts.update([*words(lower(text)), None])
    n, v = sum(counts.values()), len(counts)
    rows = {}
    for i, text in enumerate(texts):
        tokens = [*words(lower(text)), None]
        score = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        rows[i] = (held[i], len(tokens), sum(counts[t] > 0 for t in tokens), n, score)
    return rows


def topics(rng, documents_=400):
    kinds = [[f"{kind}{i}" for i in range(50)] for kind in "abc"]
    return [" ".join(rng.choice(kinds[i % 3]) for _ in range(rng.randrange(80))) for i in range(documents_)]


@pytest.mark.parametrize("common", [60_000, 20])
def test_scores(spark, monkeypatch, common):
    monkeypatch.setattr(hmm, "COMMON", common)
    texts = [*ODD_TEXTS, *topics(random.Random(1))]
    docs = documents(spark, texts).withColumnRenamed("source", "row").repartition(3)
    rows = {r.doc: r for r in hmm.scored(docs, states=4).collect()}
    want = base(texts)
    for i, r in rows.items():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[i][:4]
        assert r.base_score == pytest.approx(want[i][4], rel=1e-9)
    held = [r for r in rows.values() if r.held_out and r.doc >= len(ODD_TEXTS)]
    gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert gain > (0.2 if common > 1000 else 0.05)


def sequence_chance(model, tokens):
    """Sum over all paths, by plain recursion."""
    now = model.start * model.emit[tokens[0]]
    for t in tokens[1:]:
        now = np.array([sum(now[i] * model.move[i, j] for i in range(len(now))) * model.emit[t, j] for j in range(len(now))])
    return math.log(now.sum())


def toy(rng, states=3, classes=6):
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return hmm.Model(norm(rng.random(states), 0), norm(rng.random((states, states)), 1), norm(rng.random((classes, states)), 0))


def test_forward_and_expected_counts_against_all_paths():
    rng = np.random.default_rng(5)
    model = toy(rng)
    sequences = [rng.integers(0, 6, n).astype(np.uint16) for n in (1, 4, 3, 1, 5)]
    group = hmm.Group(sequences)
    got, _, _ = hmm.forward(model, group, False)
    assert got == pytest.approx([sequence_chance(model, s.tolist()) for s in sequences])
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((6, 3))
    hmm.expected_counts(model, group, start, move, emit)
    want_start, want_move, want_emit = np.zeros(3), np.zeros((3, 3)), np.zeros((6, 3))
    import itertools

    for s in sequences:
        paths = list(itertools.product(range(3), repeat=len(s)))
        chances = []
        for path in paths:
            p = model.start[path[0]] * model.emit[s[0], path[0]]
            for t in range(1, len(s)):
                p *= model.move[path[t - 1], path[t]] * model.emit[s[t], path[t]]
            chances.append(p)
        for path, p in zip(paths, np.array(chances) / sum(chances)):
            want_start[path[0]] += p
            for t in range(len(s)):
                want_emit[s[t], path[t]] += p
                if t:
                    want_move[path[t - 1], path[t]] += p
    assert start == pytest.approx(want_start) and emit == pytest.approx(want_emit)
    assert move * model.move == pytest.approx(want_move)


def test_training_raises_likelihood_and_tokens_add_up_to_one(spark, monkeypatch):
    monkeypatch.setattr(hmm, "COMMON", 30)
    monkeypatch.setattr(hmm, "BUCKETS", 8)
    docs = documents(spark, topics(random.Random(2), 120)).selectExpr("doc_id as doc", "false as held_out", "text")
    counts = hmm.word_counts(docs)
    lex = hmm.lexicon(counts, 120)
    rows = hmm.encoded(docs, lex).selectExpr("*", "doc as row").cache()
    sequences = [np.frombuffer(r.classes, "<u2") for r in rows.collect()]
    model, before = hmm.initial(lex, 3), -np.inf
    for _ in range(4):
        now = hmm.forward(model, hmm.Group(sequences), False)[0].sum()
        assert now > before
        before, model = now, hmm.step(model, rows, lex)
    table = counts.toPandas()
    hashes = table["word"].to_numpy(np.int64).view(np.uint64)
    classes, common = lex.classify(hashes)
    share = np.where(common, 1.0, (table["n"].to_numpy() + 1) / lex.weights[classes])
    unknown = (model.emit[30:38] / lex.weights[30:38, None]).sum(axis=0)
    total = (model.emit[classes] * share[:, None]).sum(axis=0) + unknown + model.emit[-1]
    assert total == pytest.approx(1)


def test_null_ids_no_training_documents_and_empty_table(spark):
    docs = documents(spark, ["a b", None])
    nulls = docs.selectExpr("cast(null as long)", "text", "lang", "source", "n_chars")
    assert hmm.scored(docs.union(docs).union(nulls)).count() == 6
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    none = documents(spark, ["a b"]).selectExpr(f"cast({held[0]} as long) as doc_id", "text")
    row = hmm.scored(none).collect()[0]
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (True, 3, 0, 0, 0.0)
    assert hmm.scored(docs.limit(0)).count() == 0


def test_rarer_words_have_emissions_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(hmm, "COMMON", 10)
    monkeypatch.setattr(hmm, "BUCKETS", 1)  # a shared emission would tell the rarer words' states nothing
    monkeypatch.setattr(hmm, "BLOCK_TOKENS", 700)
    texts = topics(random.Random(3), 300)
    docs = documents(spark, texts).selectExpr("doc_id as doc", "doc_id % 7 = 0 as held_out", "text").repartition(2)
    counts = hmm.word_counts(docs.where("not held_out")).cache()
    lex = hmm.lexicon(counts, docs.where("not held_out").count())
    rows = hmm.encoded(docs, lex).cache()
    found = hmm.uses(rows, counts).cache()
    model = hmm.trained(rows, lex, 4, found)
    table = model.words.join(counts, "word").toPandas()
    c = table[[f"s{i}" for i in range(4)]].to_numpy()
    assert len(table) == 150 - 10 and c.sum(axis=1) == pytest.approx(table["n"].to_numpy())
    weight = np.append(table["n"].to_numpy() + 1.0, 1.0)  # the last place is for words never seen
    c = np.vstack((c, np.zeros(4)))
    emit = (c + hmm.SMOOTHING * (weight / lex.weights.sum())[:, None]) / (model.totals + hmm.SMOOTHING)
    assert emit.sum(axis=0) == pytest.approx(model.emit[10])
    spread = (emit / weight[:, None])[:-1]
    assert (spread.max(axis=0) > 3 * spread.min(axis=0)).any()


def test_more_rarer_words_than_the_cap_lose_no_gain(spark, monkeypatch):
    monkeypatch.setattr(hmm, "BUCKETS", 1)
    docs = documents(spark, topics(random.Random(1))).repartition(3)
    gains = []
    for common in (60_000, 0):
        monkeypatch.setattr(hmm, "COMMON", common)
        held = [r for r in hmm.scored(docs, states=4).collect() if r.held_out]
        gains.append(sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held))
    assert gains[1] > 0.5 * gains[0]


def test_parts_of_the_blocks_add_up(spark, monkeypatch):
    monkeypatch.setattr(hmm, "COMMON", 10)
    monkeypatch.setattr(hmm, "BLOCK_TOKENS", 700)
    docs = documents(spark, topics(random.Random(3), 150)).repartition(2)
    by_block, seen = hmm._by_block, []

    def counted(rows, found, *more):
        seen.append({r.block for r in rows.select("block").distinct().collect()})
        return by_block(rows, found, *more)

    monkeypatch.setattr(hmm, "_by_block", counted)
    scores = []
    for passes in (1, 3):
        monkeypatch.setattr(hmm, "PASSES", passes)
        scores.append({r.doc: r.score for r in hmm.scored(docs, states=4).collect()})
        assert len(seen) == hmm.WARM + 2 * passes
        last = seen[-passes:]
        assert sum(map(len, last)) == len(set().union(*last)) > 1
        seen.clear()
    assert scores[1] == pytest.approx(scores[0]) and len(scores[0]) == 150


class Looked(np.ndarray):
    """Emissions that count how often they are looked up."""

    times = 0

    def __getitem__(self, key):
        Looked.times += 1
        return np.asarray(self)[key]


@pytest.mark.parametrize("tokens", [1, 7, 1 << 16])
def test_emissions_are_looked_up_by_stretches(monkeypatch, tokens):
    """Not for every step of a long text; stretches of any size give the same."""
    rng = np.random.default_rng(11)
    model = toy(rng)
    sequences = [rng.integers(0, 6, n) for n in (400, 400, 250, 9, 1)]
    wanted = hmm.forward(model, hmm.Group(sequences), False)[0]
    counts = [np.zeros(3), np.zeros((3, 3)), np.zeros((6, 3))]
    hmm.expected_counts(model, hmm.Group(sequences), *counts)
    monkeypatch.setattr(hmm, "STRETCH_TOKENS", tokens)
    Looked.times = 0
    group = hmm.Group(sequences)
    got = hmm.forward(model._replace(emit=model.emit.view(Looked)), group, False)[0]
    again = [np.zeros(3), np.zeros((3, 3)), np.zeros((6, 3))]
    hmm.expected_counts(model._replace(emit=model.emit.view(Looked)), group, *again)
    assert Looked.times == 3 * len(group.stretches())
    if tokens > 1000:
        assert Looked.times == 3
    assert got == pytest.approx(wanted, rel=1e-12)
    for a, b in zip(counts, again):
        assert b == pytest.approx(a, rel=1e-9)
    assert counts[2].sum() == pytest.approx(sum(map(len, sequences)))
