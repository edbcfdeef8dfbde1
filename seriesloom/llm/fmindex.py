"""A compressed full-text index over word ids: wavelet matrix, backward search, matching windows."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Ranks of symbols in a sequence, with a bit per symbol and level and a count per 64 bits."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.blocks, self.counts, self.zeros = [], [], []
        n = len(sequence)
        for level in range(self.levels - 1, -1, -1):
            bits = ((sequence >> level) & 1).astype(np.uint8)
            packed = np.zeros((n // 64 + 1) * 8, np.uint8)
            packed[: (n + 7) // 8] = np.packbits(bits, bitorder="little")
            blocks = packed.view(np.uint64)
            ones = np.bitwise_count(blocks).astype(np.int64)
            self.blocks.append(blocks)
            self.counts.append(np.cumsum(ones) - ones)
            self.zeros.append(n - int(bits.sum()))
            sequence = np.concatenate((sequence[bits == 0], sequence[bits == 1]))
        self.start = self._descend(np.arange(symbols), np.zeros(symbols, np.int64))

    def _descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i in range(self.levels):
            block = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[i][block] + np.bitwise_count(self.blocks[i][block] & below)
            up = (symbols >> (self.levels - 1 - i)) & 1 == 1
            at = np.where(up, self.zeros[i] + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._descend(symbols, at) - self.start[symbols]


class WindowIndex:
    """Finds where windows of ``window`` words occur among indexed segments.

    Suffixes are sorted by their first ``window`` words, as far as a search for so many words looks.
    """

    def __init__(self, words: np.ndarray, first: np.ndarray, window: int):
        """Segments are words[first[i]:first[i + 1]], as hashes."""
        self.window = window
        self.lengths = np.diff(first)
        _, ids = np.unique(words, return_inverse=True)
        # a segment ends with symbol 0, so no window runs into the next one
        owner = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.ends = first[1:] + np.arange(len(self.lengths))
        text = np.zeros(len(words) + len(self.lengths), np.int64)
        text[np.arange(len(words)) + owner] = ids + 1
        self.text = text
        self.segment = np.repeat(np.arange(len(self.lengths)), self.lengths + 1)
        n = len(text)

        def shifted(rank: np.ndarray, by: int) -> np.ndarray:
            out = np.zeros(n, np.int64)
            if by < n:
                out[: n - by] = rank[by:]
            return out

        rank, span = text, 1
        while span * 2 <= window:
            rank = np.unique(rank * (n + 2) + shifted(rank, span), return_inverse=True)[1]
            span *= 2
        key = rank * (n + 2) + shifted(rank, window - span)
        self.order = np.argsort(key, kind="stable")
        key = key[self.order]
        self.class_start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        self.class_stop = np.append(self.class_start[1:], n)
        self.class_of = np.repeat(np.arange(len(self.class_start)), self.class_stop - self.class_start)
        symbols = int(text.max()) + 1
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))[:-1]))
        self.wavelet = WaveletMatrix(text[self.order - 1], symbols)

    def extended(self, symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: intervals of patterns with one more word in front."""
        both = self.wavelet.rank(np.concatenate((symbols, symbols)), np.concatenate((lo, hi)))
        base = self.before[symbols]
        return base + both[: len(lo)], base + both[len(lo) :]

    def classes(self) -> tuple[np.ndarray, np.ndarray]:
        """Interval number of each window of each segment, and where each segment's windows begin.

        All segments are read from their ends together. A match longer than a window gives up its last
        word: the interval of all suffixes that share its first ``window`` words.
        """
        windows = np.maximum(self.lengths - self.window + 1, 0)
        begin = np.concatenate(([0], np.cumsum(windows)))
        found = np.zeros(int(begin[-1]), np.int64)
        by_length = np.argsort(-self.lengths, kind="stable")
        lengths, ends, starts = self.lengths[by_length], self.ends[by_length], begin[:-1][by_length]
        lo = np.zeros(len(lengths), np.int64)
        hi = np.full(len(lengths), len(self.text), np.int64)
        for step in range(int(lengths[0]) if len(lengths) else 0):
            active = int(np.searchsorted(-lengths, -step, "left"))
            lo, hi = self.extended(self.text[ends[:active] - 1 - step], lo[:active], hi[:active])
            if step + 1 >= self.window:
                match = self.class_of[lo]
                lo, hi = self.class_start[match], self.class_stop[match]
                found[starts[:active] + lengths[:active] - 1 - step] = match
        return found, begin

    def least(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each window the smallest value among the segments that have it; values go by segment."""
        if not len(self.text):
            return np.empty(0, np.int64), np.zeros(len(self.lengths) + 1, np.int64)
        found, begin = self.classes()
        return np.minimum.reduceat(values[self.segment[self.order]], self.class_start)[found], begin
