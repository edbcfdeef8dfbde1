"""Words, lines and their hashes for whole Arrow columns, without one Python object per word.

A word is a run of bytes other than space and the controls 9-13. Hashes are 64 bits wide: a
polynomial over the bytes, read off prefix sums, then mixed together with the length. Two different
words of a corpus of a billion distinct words share a hash with a chance of a few per cent, and
everything built on them compares several words at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Text bytes handled at a time; a longer document is handled alone and whole.
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x + np.uint64((seed * 0xD6E8FEB86659FD93 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(kind: str, base: int, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps)
    return _powers[kind][:n]


class Bytes(NamedTuple):
    """UTF-8 bytes of consecutive texts; text i is data[first[i]:first[i + 1]]."""

    data: np.ndarray
    first: np.ndarray


class Words(NamedTuple):
    """Words of consecutive texts; those of text i are first[i]:first[i + 1]."""

    hashes: np.ndarray
    first: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def column_bytes(column: pa.Array) -> Bytes:
    """The bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    first = np.frombuffer(column.buffers()[1], wide)[column.offset : column.offset + len(column) + 1]
    first = first.astype(np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)
    return Bytes(data[first[0] : first[-1]], first - first[0])


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches so that a piece holds at most SLICE_BYTES of text, or one longer row."""
    for batch in batches:
        first = column_bytes(batch.column(column)).first
        row = 0
        while row < batch.num_rows:
            stop = int(np.searchsorted(first, first[row] + SLICE_BYTES, "right")) - 1
            stop = min(max(stop, row + 1), batch.num_rows)
            yield batch.slice(row, stop - row)
            row = stop


def lowered(text: Bytes) -> Bytes:
    """A-Z become a-z; other letters stay."""
    upper = (text.data >= 65) & (text.data <= 90)
    return Bytes(text.data + (upper.view(np.uint8) << 5), text.first)


def blank(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data - np.uint8(9)) <= 4)


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes begin:end of each span; equal bytes give equal hashes anywhere."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, len(data)), out=sums[1:])
    down = _power("down", _INVERSE, len(data) + 1)
    return mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def words(text: Bytes) -> Words:
    """All words of the texts, in order."""
    space = blank(text.data)
    before = np.empty(len(space), bool)
    after = np.empty(len(space), bool)
    before[1:] = space[:-1]
    after[:-1] = space[1:]
    inner = text.first[:-1][text.first[:-1] < len(space)]
    before[inner] = True
    ends = text.first[1:]
    after[ends[ends > 0] - 1] = True
    begin = np.flatnonzero(~space & before)
    end = np.flatnonzero(~space & after) + 1
    return Words(span_hashes(text.data, begin, end), np.searchsorted(begin, text.first), begin, end)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` consecutive words, across texts too."""
    count = max(len(hashes) - size + 1, 0)
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total = total * np.uint64(_BASE) + hashes[k : k + count]
    return mixed(total, size)


def gram_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Positions of the runs that lie inside one text."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    return ranges(first[:-1], counts)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... counts[0] of them, then those of starts[1], and so on."""
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(starts - before, counts)
