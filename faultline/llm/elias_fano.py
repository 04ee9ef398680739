"""Elias-Fano coding of monotone whole numbers: upper parts in unary, lower parts in a fixed number of bits."""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


def _select_in_word(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the set bit with ``rank`` (from 0) in each word."""
    at = np.zeros(len(words), np.int64)
    words, rank = words.copy(), rank.copy()
    for width in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count(words & np.uint64((1 << width) - 1)).astype(np.int64)
        beyond = rank >= below
        rank -= below * beyond
        move = beyond * width
        words >>= move.astype(np.uint64)
        at += move
    return at


class EliasFano:
    """A level of a trie. ``arrays`` are all it holds, so they may lie in a mapped file."""

    def __init__(self, values: np.ndarray | None, top: int = 0, arrays: tuple | None = None, low_bits: int = 0, size: int = 0):
        if arrays is not None:
            self.low_bits, self.size, self.top = low_bits, size, top
            self.lower, self.upper, self.zeros = arrays
            return
        values = values.astype(np.int64)
        self.size, self.top = n, top = len(values), max(top, int(values[-1]) if len(values) else 0)
        self.low_bits = max(0, (top // max(1, n)).bit_length() - 1)
        high = (values >> self.low_bits) + np.arange(n)
        bits = np.zeros(-(-(n + (top >> self.low_bits) + 2) // 64) * 64, np.uint8)
        bits[high] = 1
        self.upper = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = np.cumsum(np.bitwise_count(self.upper).astype(np.int64))
        # Zeros before each word, to find where an upper part begins.
        self.zeros = np.arange(len(self.upper), dtype=np.int64) * 64 - np.concatenate([[0], ones[:-1]])
        low = values & ((1 << self.low_bits) - 1)
        width = next(x for x in (8, 16, 32, 64) if self.low_bits <= x)
        self.lower = low.astype(f"<u{width // 8}")

    @property
    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.lower, self.upper, self.zeros

    def _zero(self, rank: np.ndarray) -> np.ndarray:
        """Place of the zero with ``rank`` in the unary part; -1 for rank -1."""
        known = np.maximum(rank, 0)
        word = np.searchsorted(self.zeros, known, "right") - 1
        at = word * 64 + _select_in_word(~self.upper[word], known - self.zeros[word])
        return np.where(rank < 0, -1, at)

    def at(self, index: np.ndarray) -> np.ndarray:
        """The values at ``index``."""
        ones_before = np.arange(len(self.upper), dtype=np.int64) * 64 - self.zeros
        word = np.searchsorted(ones_before, index, "right") - 1
        high = word * 64 + _select_in_word(self.upper[word], index - ones_before[word]) - index
        return high << self.low_bits | self.lower[index].astype(np.int64)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Index of each value, -1 if absent."""
        out = np.full(len(values), -1, np.int64)
        rows = np.flatnonzero((values >= 0) & (values <= self.top))
        high = values[rows] >> self.low_bits
        low = values[rows] & ((1 << self.low_bits) - 1)
        at = self._zero(high - 1) + 1 - high
        end = self._zero(high) - high
        lower = np.asarray(self.lower)
        while len(going := np.flatnonzero(at < end)):
            rows, low, at, end = rows[going], low[going], at[going], end[going]
            middle = (at + end) >> 1
            own = lower[middle].astype(np.int64)
            out[rows[own == low]] = middle[own == low]
            at, end = np.where(own < low, middle + 1, at), np.where(own > low, middle, np.where(own < low, end, at))
        return out
