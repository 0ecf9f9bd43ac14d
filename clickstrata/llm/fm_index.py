"""A compressed full-text index: Burrows-Wheeler transform in a wavelet matrix.

Suffixes are ordered by their first ``depth`` symbols, which is enough to search
for patterns of up to that length. The transform's symbols are kept bit by bit,
one packed bit vector a level, with counts every 64 bits.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A packed bit vector that counts the ones before a place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class FMIndex:
    """Search in a text of symbols 0, 1, ... whose patterns have ``depth`` symbols."""

    def __init__(self, text: np.ndarray, depth: int):
        self.n, self.depth = len(text), depth
        ranks = {1: np.unique(text, return_inverse=True)[1]}
        size = 1
        while 2 * size < depth:
            ranks[2 * size] = self._joined(ranks[size], size, size)
            size *= 2
        # Ranks by one symbol less, where a search widens, and by all.
        whole = self._joined(ranks[size], depth - size, size)
        shorter = self._joined(ranks[size], depth - 1 - size, size) if depth > 1 else whole * 0
        order = np.argsort(whole, kind="stable")
        self.suffixes = order
        self.run = whole[order]
        self.low, self.high = self._runs(shorter[order])
        before = text[order - 1]
        symbols = int(text.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.levels = []
        self.zeros = []
        for bit in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            ones = (before >> bit & 1).astype(np.uint8)
            self.levels.append((bit, Bits(ones)))
            self.zeros.append(int(self.n - ones.sum()))
            before = np.concatenate([before[ones == 0], before[ones == 1]])

    @staticmethod
    def _joined(rank: np.ndarray, step: int, size: int) -> np.ndarray:
        """Ranks by ``size + step`` symbols from those by ``size``."""
        after = np.zeros(len(rank), dtype=np.int64)
        after[: len(rank) - step] = rank[step:] + 1
        return np.unique(rank * np.int64(len(rank) + 2) + after, return_inverse=True)[1]

    @staticmethod
    def _runs(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the run of equal ranks around each place begins and ends."""
        starts = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]]))
        number = np.cumsum(np.concatenate([[False], rank[1:] != rank[:-1]]))
        ends = np.append(starts[1:], len(rank))
        return starts[number].astype(np.int32), ends[number].astype(np.int32)

    def widened(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of all suffixes that agree in ``depth - 1`` symbols."""
        return self.low[low].astype(np.int64), self.high[low].astype(np.int64)

    def extended(
        self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: the places of the patterns with a symbol put in front."""
        start, a, b = np.zeros_like(low), low, high
        for (bit, bits), zeros in zip(self.levels, self.zeros):
            one = (symbol >> bit & 1).astype(bool)
            s1, a1, b1 = bits.ones(start), bits.ones(a), bits.ones(b)
            start = np.where(one, zeros + s1, start - s1)
            a = np.where(one, zeros + a1, a - a1)
            b = np.where(one, zeros + b1, b - b1)
        base = self.first[symbol]
        return base + a - start, base + b - start
