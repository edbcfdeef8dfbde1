"""A hidden Markov language model: Baum-Welch over partitions, exact scores by the scaled forward recursion.

Tokens are the words of a text, A-Z in lower case, and an end. Training counts cover all training documents,
and every training word has an emission of its own in every state. The COMMON most frequent words are classes
of a table that is sent to executors; all rarer words live in a stored table by word. Documents are kept in
blocks of BLOCK_TOKENS; in every step and in scoring a block's distinct rarer words are joined with that
table, and the two meet by block. The rarer words of a hash bucket add up to one of BUCKETS classes, with one
more place in every bucket for words never seen: for every state the probabilities of all tokens add up to 1.
Neither the vocabulary nor the rarer words' emissions ever pass through the driver.

Training: WARM steps of Baum-Welch on disjoint folds of the training documents, then one on all of
them. A block adds up expected counts over its documents; Spark sums them by class and by word; the driver gets one row
per class and state, a bounded number. Emissions are smoothed towards the base model with weight SMOOTHING.
Work on all documents goes over the blocks in PASSES parts, so that only one part's shuffle files lie on disk at once.

Documents of a batch are stepped through together, sorted by length, in whole length.

Defined results: null and empty texts are the end alone; a null id counts as the empty text when
documents are assigned; rows that repeat a document count and are scored each; a text of any length is scored
whole, token by token; without training
documents every token is unknown. Other columns are carried along by name only where asked for.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as X
from .shared import mapped, ship, stored

COMMON, BUCKETS, STATES = 60_000, 1024, 8
FOLDS, WARM, SMOOTHING = 16, 6, 100.0
#: Tokens whose forward values are kept at once while counts are collected.
GROUP_TOKENS = 1 << 20
#: Tokens of consecutive steps whose emissions are looked up at once.
STRETCH_TOKENS = 1 << 16
#: Tokens of a block of documents, or one longer document.
BLOCK_TOKENS = 1 << 21
#: Parts of the blocks that are shuffled one after the other where all documents are gone through.
PASSES = 4
#: Words, distinct in each slice, that a task holds before it hands on their counts.
HELD_WORDS = 1_000_000


def is_held_out(key: Column) -> Column:
    """Whether a document is not for training: crc32 of its id as text, modulo 7, is 2."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 7 == 2


class Lexicon(NamedTuple):
    """Common words by hash, and the classes' summed (count + 1)."""

    common: np.ndarray
    place: np.ndarray
    weights: np.ndarray
    tokens: int
    distinct: int

    @property
    def buckets(self) -> int:
        return len(self.weights) - len(self.common) - 1

    @property
    def classes(self) -> int:
        return len(self.weights)

    def base_total(self) -> float:
        return float(self.tokens + self.distinct + 1)

    def classify(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each word, and whether it is common."""
        bucket = len(self.common) + (hashes % np.uint64(self.buckets)).astype(np.int64)
        if not len(self.common):
            return bucket, np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.common, hashes), len(self.common) - 1)
        known = self.common[at] == hashes
        return np.where(known, self.place[at], bucket), known


class Model(NamedTuple):
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # class, state; a bucket's is the sum over its words
    totals: np.ndarray | None = None  # expected tokens by state; none before the first step
    words: DataFrame | None = None  # expected counts of rarer words by state, where a step found any


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` over all texts, words as signed hashes."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        words, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([p[1] for p in parts]), len(words))
        return _rows(word=words.view(np.int64), n=counts.astype(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in X.slices(batches):
            hashes = X.words(X.lowered(X.column_bytes(batch.column(0)))).hashes
            parts.append(np.unique(hashes, return_counts=True))
            if sum(len(words) for words, _ in parts) >= HELD_WORDS:
                yield merged(parts)
                parts = []
        if parts:
            yield merged(parts)

    return mapped(docs.select("text"), run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _rows(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


def lexicon(counts: DataFrame, ends: int) -> Lexicon:
    """From stored word counts and the number of training documents."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = counts.orderBy(F.desc("n"), "word").limit(COMMON).toPandas()
    words = top["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    common = [F.col("word"), F.col("n")]
    # what stays outside the common words: all below the last of them in the same order
    rare = counts.select(*common)
    if len(top):
        n, word = int(top["n"].iloc[-1]), int(top["word"].iloc[-1])
        rare = rare.where((F.col("n") < n) | ((F.col("n") == n) & (F.col("word") > word)))
    # a signed hash modulo a power of two is the unsigned one's
    bucket = F.pmod(F.col("word"), F.lit(BUCKETS)).alias("bucket")
    sums = rare.groupBy(bucket).agg(F.sum(F.col("n") + 1).alias("z")).toPandas()
    buckets = np.ones(BUCKETS)
    buckets[sums["bucket"].to_numpy(np.int64)] += sums["z"].to_numpy(float)
    weights = np.concatenate((top["n"].to_numpy(float) + 1, buckets, [ends + 1.0]))
    distinct = int(total["v"]) + (ends > 0)
    return Lexicon(words[order], order, weights, int(total["n"]) + ends, distinct)


def encoded(docs: DataFrame, lex: Lexicon) -> DataFrame:
    """Rows in blocks: class numbers of the tokens, places of rarer words among the block's, and the base score of common ones.

    The first row of a block has its distinct rarer words as ``own``, and in ``folds`` a bit for each fold of training
    documents that has the word.
    """

    def block(held: list[tuple]) -> pa.RecordBatch:
        hashes = np.concatenate([row[-1] for row in held])
        own, place = np.unique(hashes, return_inverse=True)
        folds = np.zeros(len(own), np.int32)
        sizes = [len(row[-1]) for row in held]
        bits = [0 if row[2] else 1 << row[3] for row in held]
        np.bitwise_or.at(folds, place, np.repeat(np.array(bits, np.int32), sizes))
        cuts = np.cumsum(sizes)[:-1]
        which = [part.astype("<u4").tobytes() for part in np.split(place, cuts)]
        rest = [None] * (len(held) - 1)
        columns = [*[list(c) for c in zip(*(row[:-1] for row in held), strict=True)], which]
        columns += [[held[0][0]] * len(held), [own.view(np.int64), *rest], [folds, *rest]]
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = np.log10(lex.weights)
        total = np.log10(lex.base_total())
        end_known = lex.weights[-1] > 1
        held, tokens = [], 0
        for batch in X.slices(batches):
            w = X.words(X.lowered(X.column_bytes(batch.column(2))))
            classes, common = lex.classify(w.hashes)
            about = [batch.column(i).to_pylist() for i in (4, 0, 1, 3)]
            for a, b, *row in zip(w.first[:-1].tolist(), w.first[1:].tolist(), *about, strict=True):
                own, known = classes[a:b], common[a:b]
                held.append(
                    (
                        *row,
                        b - a + 1,
                        int(known.sum()) + int(end_known),
                        float(logs[own[known]].sum() + logs[-1] - (b - a + 1) * total),
                        np.append(own, lex.classes - 1).astype("<u2").tobytes(),
                        w.hashes[a:b][~known],
                    )
                )
                tokens += b - a + 1
                if tokens >= BLOCK_TOKENS:
                    yield block(held)
                    held, tokens = [], 0
        if held:
            yield block(held)

    names = ["number", "doc", "held_out", "fold", "n_tokens", "known", "base", "classes", "which", "block", "own", "folds"]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.binary()]
    kinds += [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    numbered = docs.select("doc", "held_out", "text", F.monotonically_increasing_id().alias("number"))
    fold = F.pmod(F.xxhash64("doc", "number"), F.lit(FOLDS)).cast("int").alias("fold")
    return mapped(
        numbered.select("doc", "held_out", "text", fold, "number"), run,
        "number long, doc long, held_out boolean, fold int, n_tokens long, known long, base double, classes binary, "
        "which binary, block long, own array<long>, folds array<int>",
    )


def uses(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``word, home, at, folds, n``: the rarer words of every block, with their training counts."""
    one = F.explode(F.arrays_zip("own", "folds", F.sequence(F.lit(0), F.size("own") - 1).alias("at")))
    listed = rows.where(F.size("own") > 0).select(F.col("block").alias("home"), one.alias("one"))
    named = listed.select(F.col("one.own").alias("word"), "home", F.col("one.at").alias("at"), F.col("one.folds").alias("folds"))
    return named.join(counts, "word", "left")


class Group:
    """Sequences stepped through together, the longest first; step t is a block of rows."""

    def __init__(self, sequences: list[np.ndarray]):
        self.order = np.argsort([-len(s) for s in sequences], kind="stable")
        lengths = np.array([len(sequences[i]) for i in self.order])
        self.active = np.searchsorted(-lengths, -np.arange(int(lengths[0])), "left")
        self.begin = np.concatenate(([0], np.cumsum(self.active)))
        flat = np.concatenate([sequences[i] for i in self.order])
        first = np.cumsum(lengths) - lengths
        self.tokens = np.empty(len(flat), np.int64)
        for t, n in enumerate(self.active.tolist()):
            self.tokens[self.begin[t] : self.begin[t] + n] = flat[first[:n] + t]

    def block(self, t: int) -> slice:
        return slice(int(self.begin[t]), int(self.begin[t + 1]))

    def stretches(self) -> list[tuple[int, int]]:
        """Consecutive steps of STRETCH_TOKENS tokens, or one step of more."""
        out, at = [], 0
        while at < len(self.active):
            stop = int(np.searchsorted(self.begin, self.begin[at] + STRETCH_TOKENS, "right")) - 1
            out.append((at, max(stop, at + 1)))
            at = out[-1][1]
        return out


def forward(model: Model, group: Group, keep: bool) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
    """Natural log likelihoods by sequence; where ``keep``, scaled forward values and scales by row.

    A step has few sequences where texts are long, so only what needs the step before it is done step by step.
    """
    score = np.zeros(len(group.order))
    values = np.empty((len(group.tokens), model.emit.shape[1])) if keep else None
    scales = np.empty(len(group.tokens)) if keep else None
    before = None
    for first, stop in group.stretches():
        rows = slice(int(group.begin[first]), int(group.begin[stop]))
        part = model.emit[group.tokens[rows]]
        scale = np.empty((len(part), 1))
        begin = (group.begin[first : stop + 1] - rows.start).tolist()
        for low, high in zip(begin[:-1], begin[1:], strict=True):
            now, own = part[low:high], scale[low:high]
            now *= model.start if before is None else before[: high - low] @ model.move
            np.add.reduce(now, axis=1, keepdims=True, out=own)
            now /= own
            before = now
        sequence = np.arange(len(part)) - np.repeat(begin[:-1], group.active[first:stop])
        score += np.bincount(sequence, np.log(scale[:, 0]), len(score))
        if keep:
            values[rows], scales[rows] = part, scale[:, 0]
    out = np.empty(len(score))
    out[group.order] = score
    return out, values, scales


def expected_counts(model: Model, group: Group, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
    """Add the expected counts of a group to ``start``, ``move`` and ``emit``."""
    _, values, scales = forward(model, group, True)
    to_before = np.ascontiguousarray(model.move.T)
    carried = np.ones((int(group.active[-1]), values.shape[1]))
    for first, stop in reversed(group.stretches()):
        rows = slice(int(group.begin[first]), int(group.begin[stop]))
        begin = (group.begin[first : stop + 1] - rows.start).tolist()
        weighted = model.emit[group.tokens[rows]]
        weighted /= scales[rows, None]
        back = np.ones_like(weighted)
        back[begin[-2] :] = carried
        for k in range(len(begin) - 2, -1, -1):
            low, high = begin[k], begin[k + 1]
            now = weighted[low:high]
            now *= back[low:high]
            if k:
                np.matmul(now, to_before, out=back[begin[k - 1] : begin[k - 1] + high - low])
            elif first:
                carried = np.ones((int(group.active[first - 1]), values.shape[1]))
                np.matmul(now, to_before, out=carried[: high - low])
        # the first step comes from none
        later = max(first, 1)
        came = np.arange(int(group.begin[later]), rows.stop) - np.repeat(group.active[later - 1 : stop - 1], group.active[later:stop])
        move += values[came].T @ weighted[len(weighted) - len(came) :]
        values[rows] *= back  # now the chance of each state
    start += values[group.block(0)].sum(axis=0)
    for state in range(emit.shape[1]):
        emit[:, state] += np.bincount(group.tokens, values[:, state], len(emit))


def _groups(sequences: list[np.ndarray]) -> Iterator[tuple[Group, np.ndarray]]:
    """Sequences of similar length and their places, GROUP_TOKENS at a time or one longer."""
    order = np.argsort([-len(s) for s in sequences], kind="stable")
    lengths = np.cumsum([len(sequences[i]) for i in order])
    at = 0
    while at < len(order):
        limit = (lengths[at - 1] if at else 0) + GROUP_TOKENS
        stop = max(int(np.searchsorted(lengths, limit, "right")), at + 1)
        chosen = order[at:stop]
        yield Group([sequences[i] for i in chosen]), chosen
        at = stop


class Block(NamedTuple):
    """Documents of a block with their rarer words as classes after the others."""

    words: np.ndarray
    n: np.ndarray
    model: Model
    sequences: list[np.ndarray]
    which: list[np.ndarray]


def opened(model: Model, lex: Lexicon, docs: pa.Table, found: pa.Table) -> Block:
    """A block from its rows and its rows of ``uses``, joined with the model's counts where it has any."""
    at = found.column("at").to_numpy()
    size = int(at.max()) + 1 if len(at) else 0
    words, n = np.zeros(size, np.int64), np.zeros(size)
    words[at] = found.column("word").to_numpy()
    n[at] = pc.fill_null(found.column("n"), 0).to_numpy()
    bucket = _bucket(lex, words)
    if model.totals is None:
        emit = model.emit[bucket] * ((n + 1) / lex.weights[bucket])[:, None]
    else:
        counts = np.zeros((size, len(model.totals)))
        for i in range(len(model.totals)) if model.words is not None else ():
            counts[at, i] = pc.fill_null(found.column(f"s{i}"), 0.0).to_numpy()
        emit = (counts + SMOOTHING * ((n + 1) / lex.weights.sum())[:, None]) / (model.totals + SMOOTHING)
    sequences, which = [], []
    for classes, places in zip(docs.column("classes").to_pylist(), docs.column("which").to_pylist(), strict=True):
        tokens = np.frombuffer(classes, "<u2").astype(np.int64)
        own = np.frombuffer(places, "<u4").astype(np.int64)
        tokens[(tokens >= len(lex.common)) & (tokens < lex.classes - 1)] = lex.classes + own
        sequences.append(tokens)
        which.append(own)
    return Block(words, n, model._replace(emit=np.concatenate((model.emit, emit))), sequences, which)


def _bucket(lex: Lexicon, words: np.ndarray) -> np.ndarray:
    return len(lex.common) + (words.view(np.uint64) % np.uint64(lex.buckets)).astype(np.int64)


def _by_block(rows: DataFrame, found: DataFrame, model: Model, run, schema: str) -> DataFrame:  # noqa: ANN001
    """``run(model, rows, uses)`` of every block; the rarer words come with the model's counts."""
    if model.words is not None:
        found = found.join(model.words, "word", "left")
    found = found.drop("folds")
    ship(rows.sparkSession)
    plain = model._replace(words=None if model.words is None else True)
    each = rows.groupBy("block").cogroup(found.groupBy("home"))
    return each.applyInArrow(lambda docs, words: run(plain, docs, words), schema)


def _freed(spark: SparkSession) -> None:
    """Spark drops shuffle files once the driver's JVM has collected their plan.

    Its listeners hold the plan of the last query, so a query of no size goes in between.
    """
    spark.range(1).collect()
    spark.sparkContext._jvm.System.gc()


def _passes(rows: DataFrame, found: DataFrame, passes: int, run: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """``run`` on the rows and uses of every part of the blocks, each stored before the next one starts."""

    def part(frame: DataFrame, block: str, i: int) -> DataFrame:
        return frame.where(F.pmod(F.xxhash64(block), F.lit(passes)) == i)

    out = []
    for i in range(passes):
        out.append(stored(run(part(rows, "block", i), part(found, "home", i))))
        _freed(rows.sparkSession)
    return functools.reduce(DataFrame.unionAll, out)


def step(model: Model, rows: DataFrame, lex: Lexicon, found: DataFrame | None = None, passes: int = 1) -> Model:
    """One Baum-Welch step over all rows; the same model where there are none.

    ``found`` has the ``uses`` of the rows' blocks; without it rarer words count as their buckets.
    """
    states = len(model.start)
    names = [f"s{i}" for i in range(states)]

    def table(start: np.ndarray, move: np.ndarray, emit: np.ndarray, words: np.ndarray) -> pa.RecordBatch:
        # rows of transitions and of the start follow the classes; those of words come last
        bucketed, own = emit[: lex.classes], emit[lex.classes :]
        np.add.at(bucketed, _bucket(lex, words), own)
        sums = np.concatenate((bucketed, move, start[None]))
        used, met = np.flatnonzero(sums.any(axis=1)), np.flatnonzero(own.any(axis=1))
        rare = np.repeat([False, True], [len(used), len(met)])
        values = np.concatenate((sums[used], own[met]))
        values = values.astype(np.float32)
        return _rows(rare=rare, key=np.concatenate((used, words[met])), **{name: values[:, i] for i, name in enumerate(names)})

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros((lex.classes, states))
        for batch in batches:
            for group, _ in _groups([np.frombuffer(s, "<u2") for s in batch.column(0).to_pylist()]):
                expected_counts(model, group, start, move, emit)
        yield table(start, move, emit, np.zeros(0, np.int64))

    def run(model: Model, docs: pa.Table, words: pa.Table) -> pa.Table:
        block = opened(model, lex, docs, words)
        start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros(block.model.emit.shape)
        for group, _ in _groups(block.sequences):
            expected_counts(block.model, group, start, move, emit)
        return pa.Table.from_batches([table(start, move, emit, block.words)])

    schema = "rare boolean, key long, " + ", ".join(f"{n} float" for n in names)
    added = [F.sum(n).alias(n) for n in names]
    if found is None:
        parts = mapped(rows.select("classes"), plain, schema)
    elif passes == 1:
        parts = _by_block(rows.select("block", "classes", "which"), found, model, run, schema)
    else:

        def counted(rows: DataFrame, found: DataFrame) -> DataFrame:
            return _by_block(rows, found, model, run, schema).groupBy("rare", "key").agg(*added)

        parts = _passes(rows.select("block", "classes", "which"), found, passes, counted)
    summed = parts.groupBy("rare", "key").agg(*[F.sum(n).cast("float").alias(n) for n in names])
    summed = summed if found is None else stored(summed)
    own = summed.where(~F.col("rare")).toPandas()
    if own.empty:
        return model
    sums = np.zeros((lex.classes + states + 1, states))
    sums[own["key"].to_numpy()] = own[names].to_numpy()
    emit, move, start = sums[: lex.classes], sums[lex.classes : -1] * model.move, sums[-1]
    return Model(
        (start + 1) / (start + 1).sum(),
        (move + 1) / (move + 1).sum(axis=1, keepdims=True),
        smoothed(emit, lex),
        emit.sum(axis=0),
        None if found is None else summed.where("rare").select(F.col("key").alias("word"), *names),
    )


def smoothed(counts: np.ndarray, lex: Lexicon) -> np.ndarray:
    base = lex.weights / lex.weights.sum()
    return (counts + SMOOTHING * base[:, None]) / (counts.sum(axis=0) + SMOOTHING)


def initial(lex: Lexicon, states: int) -> Model:
    """States that prefer different words, and to stay."""
    noise = X.mixed(np.arange(lex.classes * states, dtype=np.uint64), 41).reshape(lex.classes, states)
    emit = lex.weights[:, None] * (0.2 + noise / 2.0**64)
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(axis=0))


def trained(rows: DataFrame, lex: Lexicon, states: int = STATES, found: DataFrame | None = None) -> Model:
    """WARM steps on a fold each, then one on all training rows."""
    model = initial(lex, states)
    training = rows.where(~F.col("held_out"))
    for i in range(WARM):
        own = None if found is None else found.where(F.col("folds").bitwiseAND(1 << i) != 0)
        model = step(model, training.where(F.col("fold") == i), lex, own)
        _freed(rows.sparkSession)
    model = step(model, training, lex, None if found is None else found.where("folds != 0"), PASSES)
    _freed(rows.sparkSession)
    return model


def scored(docs: DataFrame, *, key: str = "doc_id", text: str = "text", states: int = STATES) -> DataFrame:
    """``doc, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    named = docs.select(
        F.col(f"`{key}`").cast("long").alias("doc"), is_held_out(F.col(f"`{key}`")).alias("held_out"),
        F.col(f"`{text}`").alias("text"),
    )
    training = named.where(~F.col("held_out"))
    counts = stored(word_counts(training))
    lex = lexicon(counts, training.count())
    rows = stored(encoded(named, lex))
    found = stored(uses(rows, counts))
    model = trained(rows, lex, states, found)

    def run(model: Model, docs: pa.Table, words: pa.Table) -> pa.Table:
        block = opened(model, lex, docs, words)
        likely = np.empty(len(block.sequences))
        for group, chosen in _groups(block.sequences):
            likely[chosen] = forward(block.model, group, False)[0]
        logs = np.log10(block.n + 1)
        seen = np.array([int((block.n[own] > 0).sum()) for own in block.which], np.int64)
        sums = np.array([logs[own].sum() for own in block.which])
        out = {name: docs.column(name) for name in ("doc", "held_out", "n_tokens")}
        out |= {
            "n_known": pc.add(docs.column("known"), pa.array(seen)), "train_tokens": pa.array([lex.tokens] * len(seen), pa.int64()),
            "base_score": pc.add(docs.column("base"), pa.array(sums)), "score": pa.array(likely / np.log(10)),
        }
        return pa.table(out)

    schema = "doc long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return _passes(
        rows.drop("own", "folds", "fold", "number"), found, PASSES,
        lambda rows, found: _by_block(rows, found, model, run, schema),
    )
