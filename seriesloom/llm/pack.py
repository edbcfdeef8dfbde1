"""Packing along a space-filling curve.

A document is hashed to a vector of token counts in DIMENSIONS buckets, scaled to length one, and
projected to three numbers by fixed random signs. Each number becomes a coordinate of
COORDINATE_BITS bits, and the Hilbert index of the point is the sort key: neighbours on the curve are
alike. Documents are range sorted by (key, id) and each range is one stream of tokens, cut into
sequences of ``length`` without regard to document borders. What is left at the end of a range is cut
into powers of two, so nothing is padded there either.

The tokens are written once, sorted by Spark as rows of (key, id, compressed ids), and packed while a
range is read; a task holds one sequence and one document.

Defined results: null and empty texts are the end token alone; a null id sorts first; rows that
repeat an id are packed each; documents equal in key, id and length keep the order in which they were
read; a text of any length is encoded whole, in memory, and cut into as many pieces as it fills sequences; an empty
table gives no pieces. Other columns of the input are not used.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as X
from .shared import mapped, stored
from .tokens import encoder

DIMENSIONS, AXES, COORDINATE_BITS = 256, 3, 16
#: Ends of token ids packed behind each document.
END = np.zeros(1, "<u4").tobytes()

_SIGNS = ((X.mixed(np.arange(DIMENSIONS * AXES, dtype=np.uint64), 21) & np.uint64(1)).astype(np.int64) * 2 - 1).reshape(
    DIMENSIONS, AXES
) / np.sqrt(AXES)


@functools.lru_cache
def _buckets(size: int) -> np.ndarray:
    """The bucket of each token id below ``size``."""
    return (X.mixed(np.arange(size, dtype=np.uint64), 22) % np.uint64(DIMENSIONS)).astype(np.int64)


def hashed_point(ids: np.ndarray) -> np.ndarray:
    """Coordinates in [0, 2**COORDINATE_BITS) of a document's hashed and projected vector."""
    counts = np.bincount(_buckets(1 << int(ids.max(initial=0)).bit_length())[ids], minlength=DIMENSIONS).astype(float)
    norm = np.sqrt((counts**2).sum())
    point = counts @ _SIGNS / norm if norm else np.zeros(AXES)
    side = 1 << COORDINATE_BITS
    # a unit vector times signs / sqrt(3) mostly lies within -1 .. 1; what lies beyond is set to the border
    return np.clip((point + 1) / 2 * side, 0, side - 1).astype(np.int64)


def hilbert_index(points: np.ndarray, bits: int = COORDINATE_BITS) -> np.ndarray:
    """Positions of points (a row each) on the Hilbert curve through a cube of 2**bits a side."""
    x = points.astype(np.int64).T.copy()
    axes = len(x)
    # undo the turns of the sub-cubes, from the largest down
    for bit in range(bits - 1, 0, -1):
        high, below = 1 << bit, (1 << bit) - 1
        for i in range(axes):
            set_ = (x[i] & high) != 0
            swap = (x[0] ^ x[i]) & below
            x[0] = np.where(set_, x[0] ^ below, x[0] ^ swap)
            if i:
                x[i] = np.where(set_, x[i], x[i] ^ swap)
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn = np.where((x[-1] >> bit) & 1, turn ^ ((1 << bit) - 1), turn)
    x ^= turn
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(axes):
            out = (out << 1) | ((x[i] >> bit) & 1)
    return out


def tokenised(docs: DataFrame, vocabulary: str, key: str, text: str) -> DataFrame:
    """``curve, doc, tokens, ids`` of every row: the sort key and zstd-compressed ids with the end token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        press = zstandard.ZstdCompressor(level=1)
        for batch in X.slices(batches):
            ids = [found + END for found in encode(batch.column(1).to_pylist())]
            # ids below 2**16 make half of the bytes zero, which compression removes
            points = np.array([hashed_point(np.frombuffer(one, "<u4")[:-1]) for one in ids]).reshape(-1, AXES)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hilbert_index(points)),
                    batch.column(0),
                    pa.array([len(one) // 4 for one in ids], pa.int64()),
                    pa.array([press.compress(one) for one in ids], pa.binary()),
                ],
                ["curve", "doc", "tokens", "ids"],
            )

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))
    return mapped(rows, run, "curve long, doc long, tokens long, ids binary", vocabulary=True)


class Stream:
    """Cuts one range of documents into sequences; pieces come out once their sequence is settled."""

    def __init__(self, length: int, first_sequence: int):
        self.length, self.sequence = length, first_sequence
        self.open: list[tuple] = []
        self.used = 0

    def add(self, doc: int | None, tokens: int, ids: bytes) -> Iterator[tuple]:
        at = 0
        while at < tokens:
            n = min(tokens - at, self.length - self.used)
            self.open.append((doc, at, n, ids[4 * at : 4 * (at + n)], tokens, self.used))
            self.used += n
            at += n
            if self.used == self.length:
                yield from self._close(self.open)
                self.open, self.used = [], 0

    def _close(self, pieces: list[tuple]) -> Iterator[tuple]:
        for doc, start, n, ids, tokens, offset in pieces:
            yield doc, start, n, ids, tokens, self.sequence, offset
        self.sequence += 1

    def rest(self) -> Iterator[tuple]:
        """The tokens left over, in sequences whose lengths are powers of two."""
        left = self.open
        while self.used:
            size = 1 << (self.used.bit_length() - 1)
            now, later, filled = [], [], 0
            for doc, start, n, ids, tokens, _ in left:
                take = min(n, size - filled)
                if take:
                    now.append((doc, start, take, ids[: 4 * take], tokens, filled))
                if n > take:
                    later.append((doc, start + take, n - take, ids[4 * take :], tokens, 0))
                filled += take
            yield from self._close(now)
            left, self.used = later, self.used - size


PIECES = "doc long, start long, length long, ids binary, tokens long, sequence long, offset long"


def packed(
    docs: DataFrame, *, vocabulary: str, length: int = 1024, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces of documents in sequences: PIECES, where ids are little-endian unsigned 32-bit.

    Sequence numbers are unique and rise along the curve; the range is in the upper half of the number.
    """
    # the row number lets rows that are equal in all else go to several ranges
    rows = stored(tokenised(docs, vocabulary, key, text).withColumn("row", F.monotonically_increasing_id()))
    order = ("curve", "doc", "tokens", "row")
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = Stream(length, TaskContext.get().partitionId() << 32)
        open_frame = zstandard.ZstdDecompressor()

        def out(pieces: list[tuple]) -> pa.RecordBatch:
            names = [part.split()[0] for part in PIECES.split(", ")]
            kinds = [pa.binary() if name == "ids" else pa.int64() for name in names]
            columns = zip(*pieces, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        done: list[tuple] = []
        for batch in batches:
            for doc, tokens, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                done.extend(stream.add(doc, tokens, open_frame.decompress(ids)))
                if len(done) >= 2000:
                    yield out(done)
                    done = []
        done.extend(stream.rest())
        if done:
            yield out(done)

    return mapped(ranges.select("doc", "tokens", "ids"), run, PIECES)
