"""A compressed FM-index over integer sequences: wavelet matrix, backward search, thresholded matching statistics."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Packed bits with a running count at each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        padded = np.zeros((self.n // 64 + 1) * 64, np.uint8)
        padded[: self.n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.ones = int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Rank of any symbol at any position in log2(alphabet) bit ranks."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.bits = max(1, int(alphabet - 1).bit_length())
        self.levels: list[tuple[BitVector, int]] = []
        current = symbols
        for b in reversed(range(self.bits)):
            bit = (current >> b & 1).astype(np.uint8)
            self.levels.append((BitVector(bit), len(bit) - int(bit.sum())))
            current = np.concatenate([current[bit == 0], current[bit == 1]])

    def rank_pair(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each symbol before low, and before high."""
        first = np.zeros(len(symbol), np.int64)
        for level, b in enumerate(reversed(range(self.bits))):
            vector, zeros = self.levels[level]
            one = (symbol >> b & 1).astype(bool)
            ranks = vector.rank(np.concatenate([first, low, high]))
            f, lo, hi = np.split(ranks, 3)
            first = np.where(one, zeros + f, first - f)
            low = np.where(one, zeros + lo, low - lo)
            high = np.where(one, zeros + hi, high - hi)
        return low - first, high - first


class FMIndex:
    """Index of one text of symbols 0..alphabet-1 for patterns of up to `depth` symbols; 0 separates sequences."""

    def __init__(self, text: np.ndarray, alphabet: int, depth: int):
        n = len(text)
        rank, width = text.astype(np.int64), 1
        # suffixes sorted by their first `depth` symbols: as far as backward search looks
        while width < depth:
            following = np.zeros(n, np.int64)
            following[: n - width] = rank[width:] + 1
            order = np.argsort(rank * (n + alphabet + 2) + following, kind="stable")
            key = rank[order] * (n + alphabet + 2) + following[order]
            rank[order] = np.cumsum(np.append(0, key[1:] != key[:-1]))
            width *= 2
        self.suffixes = np.argsort(rank, kind="stable")
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet))])
        self.wavelet = WaveletMatrix(text[self.suffixes - 1], alphabet)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of each row from its last symbol on: its suffix interval, and how many symbols matched.

        The match length is the matching statistic at the row's end, cut at the row's width; where it is less than the
        width the interval is empty.
        """
        last = patterns[:, -1]
        low, high = self.before[last], self.before[last + 1]
        matched = (high > low).astype(np.int64)
        for j in range(patterns.shape[1] - 2, -1, -1):
            symbol = patterns[:, j]
            lo, hi = self.wavelet.rank_pair(symbol, low, high)
            low, high = self.before[symbol] + lo, self.before[symbol] + hi
            matched += high > low
        return low, high, matched

    def least(self, values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least of values[suffix] over each interval of patterns of one length: such intervals are equal or disjoint."""
        out = np.full(len(low), np.iinfo(np.int64).max)
        found = np.flatnonzero(high > low)
        if not len(found):
            return out
        starts, first, inverse = np.unique(low[found], return_index=True, return_inverse=True)
        ordered = np.append(values[self.suffixes], np.iinfo(np.int64).max)
        edges = np.column_stack([starts, high[found][first]]).ravel()
        out[found] = np.minimum.reduceat(ordered, edges)[::2][inverse]
        return out
