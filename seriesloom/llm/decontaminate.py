"""Benchmark passages in documents: SimHash windows, Hamming blocks, exact weighted similarity.

An item of n words is looked for in every window of n words of a document (a shorter document is one
window). Texts are compared as multisets of shingles of ``size`` words, each weighing as many bytes
as its words have: similarity is the weight of what both share over the weight of what either has.

* A 128-bit SimHash fingerprint is summed up for windows by moving sums. Occurrences of a shingle within a text are
  numbered, and each number has signs of its own, so a repeated shingle counts linearly, as in the similarity. Windows that share no shingle
  with any item of their length have similarity 0 and get no fingerprint; all others do.
* An index finds the items within RADIUS bits of a fingerprint: it has BLOCKS blocks, and by the
  pigeonhole principle a pair within the radius differs by at most RADIUS // BLOCKS bits in one of
  them, so looking up each block's near values misses none.
* Candidates are compared exactly.

Similarity 0.8 means a cosine of at least 0.89 for weights under a root, hence 19.4 expected differing
bits with a deviation of 4.1; RADIUS lies six deviations above.

Items are taken in blocks of at most BLOCK_BYTES of text; a block's index goes to the executors and the documents are
passed over once per block. Nothing is shuffled.

Defined results: null texts and texts without words match nothing; an item of fewer words than a
shingle is one shingle; rows that repeat a document or an item are reported each; a text of any length is
searched whole; an empty table on
either side gives no match. Other columns of the documents are carried by ``clean`` and not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as X
from .shared import mapped

BITS, BLOCKS, RADIUS = 128, 16, 44
BLOCK_BYTES = 2 << 20
_MARKS = 1 << 20


class Item(NamedTuple):
    number: int | None
    words: int
    width: int
    shingles: np.ndarray
    counts: np.ndarray
    weights: np.ndarray
    print: np.ndarray


def _weights(w: X.Words, width: int) -> np.ndarray:
    sizes = np.concatenate(([0], np.cumsum(w.end - w.begin)))
    return sizes[width:] - sizes[:-width] if len(sizes) > width else np.zeros(0, np.int64)


def _signs(shingles: np.ndarray) -> np.ndarray:
    """128 signs of each shingle, as a row of +1 and -1."""
    halves = np.stack([X.mixed(shingles, 31), X.mixed(shingles, 32)], axis=1)
    return np.unpackbits(halves.view(np.uint8), axis=1).astype(np.float32) * 2 - 1


def _terms(shingles: np.ndarray, numbers: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """What the occurrences with these numbers within their text add to its sums; whole, so that sums are exact."""
    with np.errstate(over="ignore"):
        again = X.mixed(shingles + numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 33)
    signs = _signs(np.where(numbers > 0, again, shingles))
    return signs * np.rint(np.sqrt(weights) * 4096)[:, None]


class _Places:
    """Counts of equal shingles by position."""

    def __init__(self, shingles: np.ndarray):
        _, self.kind = np.unique(shingles, return_inverse=True)
        self.span = len(shingles) + 1
        order = np.argsort(self.kind, kind="stable")
        self.keys = self.kind[order] * self.span + order

    def between(self, at: np.ndarray, lo: np.ndarray | int, hi: np.ndarray | int) -> np.ndarray:
        """How often the shingle at each position occurs from ``lo`` to before ``hi``."""
        kind = self.kind[at] * self.span
        return np.searchsorted(self.keys, kind + hi) - np.searchsorted(self.keys, kind + lo)


def _printed(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=-1)


def similarity(one: tuple, other: tuple) -> float:
    """Weighted Jaccard similarity of (sorted shingles, counts, weights) and another."""
    common, a, b = np.intersect1d(one[0], other[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    both = (np.minimum(one[1][a], other[1][b]) * one[2][a]).sum()
    return float(both / ((one[1] * one[2]).sum() + (other[1] * other[2]).sum() - both))


def _multiset(shingles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found, at, counts = np.unique(shingles, return_index=True, return_counts=True)
    return found, counts, weights[at]


class Index:
    """Items by length, with the block tables of each length."""

    def __init__(self, rows: list[tuple[int | None, str]], size: int):
        w = X.words(X.lowered(X.column_bytes(pa.array([text for _, text in rows], pa.string()))))
        self.items: list[Item] = []
        for (number, _), a, b in zip(rows, w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
            if b > a:
                width = min(size, b - a)
                own = X.Words(w.hashes[a:b], np.array([0, b - a]), w.begin[a:b], w.end[a:b])
                shingles, weights = X.grams(own.hashes, width), _weights(own, width)
                at = np.arange(len(shingles))
                sums = _terms(shingles, _Places(shingles).between(at, 0, at), weights).sum(axis=0)
                self.items.append(Item(number, b - a, width, *_multiset(shingles, weights), _printed(sums)))
        self.widths = {}
        for width in {item.width for item in self.items}:
            pairs = {(int(s), item.words) for item in self.items if item.width == width for s in item.shingles}
            hashes = np.array([p[0] for p in pairs], np.uint64)
            order = np.argsort(hashes, kind="stable")
            marks = np.zeros(_MARKS, bool)
            marks[(hashes % np.uint64(_MARKS)).astype(np.int64)] = True
            self.widths[width] = (hashes[order], np.array([p[1] for p in pairs])[order], marks)
        self.tables = {}
        distance = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8))
        for n in {item.words for item in self.items}:
            own = [i for i, item in enumerate(self.items) if item.words == n]
            prints = np.array([self.items[i].print for i in own])
            near = distance[:, prints] <= RADIUS // BLOCKS  # value, item, block
            self.tables[n] = (own, prints, np.ascontiguousarray(near.transpose(2, 0, 1)))

    def near(self, n: int, prints: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(window, item, distance) of all pairs within the radius."""
        own, known, tables = self.tables[n]
        candidate = np.zeros((len(prints), len(own)), bool)
        for block in range(BLOCKS):
            candidate |= tables[block][prints[:, block]]
        at, item = np.nonzero(candidate)
        distance = np.bitwise_count(prints[at] ^ known[item]).sum(axis=1)
        for i in np.flatnonzero(distance <= RADIUS):
            yield int(at[i]), own[item[i]], int(distance[i])

    def _regions(self, hashes: np.ndarray, first: np.ndarray) -> dict[tuple[int, int, int], list[np.ndarray]]:
        """By (text, item length, width): positions of shingles that an item of that length has."""
        out: dict[tuple[int, int, int], list[np.ndarray]] = {}
        for width, (known, lengths, marks) in self.widths.items():
            runs = X.grams(hashes, width)
            at = np.flatnonzero(marks[(runs & np.uint64(_MARKS - 1)).astype(np.int64)])
            doc = np.searchsorted(first, at, "right") - 1
            inside = at + width <= first[doc + 1]
            at, doc = at[inside], doc[inside]
            lo, hi = np.searchsorted(known, runs[at]), np.searchsorted(known, runs[at], "right")
            rows = X.ranges(lo, hi - lo)
            where = np.repeat(np.arange(len(at)), hi - lo)
            order = np.lexsort((at[where], lengths[rows], doc[where]))
            where, rows = where[order], rows[order]
            keys = np.stack([doc[where], lengths[rows]], axis=1)
            cuts = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            for part in np.split(np.arange(len(where)), cuts):
                if len(part):
                    d, n = keys[part[0]].tolist()
                    out[d, n, width] = at[where[part]] - first[d]
        return out

    def matches(self, column: pa.Array, least: float) -> Iterator[tuple]:
        """(text, item, first word, words, similarity, distance), the best window of each text and item."""
        w = X.words(X.lowered(X.column_bytes(column)))
        best: dict[tuple[int, int], tuple] = {}
        for (doc, n, width), hits in self._regions(w.hashes, w.first).items():
            a, b = int(w.first[doc]), int(w.first[doc + 1])
            own = X.Words(w.hashes[a:b], w.first[:0], w.begin[a:b], w.end[a:b])
            size = min(n, b - a)
            change = np.zeros(b - a - size + 2, np.int64)
            np.add.at(change, np.clip(hits - (size - width), 0, b - a - size), 1)
            np.add.at(change, np.minimum(hits, b - a - size) + 1, -1)
            starts = np.flatnonzero(np.cumsum(change)[:-1] > 0)
            for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                lo, hi = int(run[0]), int(run[-1]) + size
                shingles = X.grams(own.hashes[lo:hi], width)
                weights = _weights(X.Words(shingles, shingles, own.begin[lo:hi], own.end[lo:hi]), width)
                for at, item, distance in self._windows(n, shingles, weights, size - width + 1):
                    window = slice(at, at + size - width + 1)
                    it = self.items[item]
                    alike = similarity(
                        _multiset(shingles[window], weights[window]), (it.shingles, it.counts, it.weights)
                    )
                    if alike >= least and alike > best.get((doc, item), (0, 0, 0.0))[2]:
                        best[doc, item] = (lo + at, size, alike, distance)
        for (doc, item), found in best.items():
            yield doc, self.items[item].number, *found

    def _windows(self, n: int, shingles: np.ndarray, weights: np.ndarray, count: int) -> Iterator[tuple]:
        """Pairs within the radius among all windows of ``count`` shingles, in bounded pieces."""
        step = 4096
        places = _Places(shingles)
        for lo in range(0, len(shingles) - count + 1, step):
            hi = min(lo + step, len(shingles) - count + 1)
            first = np.arange(lo, lo + count)
            out = np.arange(lo, hi - 1)  # leaves when the window moves on, and ``out + count`` enters
            sums = np.zeros((hi - lo, BITS))
            sums[0] = _terms(shingles[first], places.between(first, lo, first), weights[first]).sum(axis=0)
            sums[1:] -= _terms(shingles[out], places.between(out, out + 1, out + count), weights[out])
            new = out + count
            sums[1:] += _terms(shingles[new], places.between(new, out + 1, new), weights[new])
            for at, item, distance in self.near(n, _printed(np.cumsum(sums, axis=0))):
                yield lo + at, item, distance


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[int | None, str]]]:
    rows, held = [], 0
    chosen = benchmark.select(F.col(f"`{item}`").cast("long"), F.col(f"`{text}`")).where(F.col(f"`{text}`").isNotNull())
    for number, passage in chosen.toLocalIterator():
        rows.append((number, passage))
        held += len(passage)
        if held >= BLOCK_BYTES:
            yield rows
            rows, held = [], 0
    if rows:
        yield rows


MATCHES = "doc long, item long, start long, n_words long, similarity double, distance long"


def matches(
    docs: DataFrame, benchmark: DataFrame, *, size: int = 5, least: float = 0.8,
    key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """MATCHES of every document with every item that one of its windows resembles."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))
    out = docs.sparkSession.createDataFrame([], MATCHES)
    for block in _blocks(benchmark, item, item_text):
        index = Index(block, size)

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in X.slices(batches):
                found = list(index.matches(batch.column(1), least))
                if found:
                    doc, *rest = zip(*found, strict=True)
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64())
                    columns = [pa.array(c, kind) for c, kind in zip(rest, kinds, strict=True)]
                    names = ["doc", "item", "start", "n_words", "similarity", "distance"]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), *columns], names)

        out = out.union(mapped(rows, run, MATCHES))
    return out


def clean(
    docs: DataFrame, benchmark: DataFrame, *, size: int = 5, least: float = 0.8,
    text: str = "text", item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` without a match, with their columns."""
    for block in _blocks(benchmark, item, item_text):
        index = Index(block, size)
        at = docs.columns.index(text)

        def run(batches: Iterator[pa.RecordBatch], index: Index = index, at: int = at) -> Iterator[pa.RecordBatch]:
            for batch in X.slices(batches, text):
                keep = np.ones(batch.num_rows, bool)
                keep[[found[0] for found in index.matches(batch.column(at), least)]] = False
                yield batch.filter(pa.array(keep))

        docs = mapped(docs, run, docs.schema)
    return docs
