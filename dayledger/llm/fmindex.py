"""A compressed full-text index over symbol sequences: the Burrows-Wheeler
transform in a wavelet matrix, searched backward for many patterns at once."""

from __future__ import annotations

import numpy as np

FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


class Bits:
    """A bit vector packed into 64-bit words with the ones before each word."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(np.concatenate([bits, np.zeros(-n % 64 + 64, bool)]), bitorder="little")
        self.words = packed.view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.ones = int(self.before[-1])
        self.zeros = n - self.ones

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        word = i >> 6
        mask = ~(FULL << (i & 63).astype(np.uint64))
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FMIndex:
    """Index of a sequence of symbols 0 .. size-1. Suffixes are sorted by their
    first ``depth`` symbols, so patterns of up to ``depth`` symbols are found."""

    def __init__(self, text: np.ndarray, size: int, depth: int):
        n = len(text)
        rank, step = text.astype(np.int64), 1
        order = np.argsort(rank, kind="stable")
        while step < depth:
            ahead = np.zeros(n, np.int64)
            ahead[:n - step] = rank[step:] + 1 if step < n else 0
            key = rank * (int(rank.max(initial=0)) + 2) + ahead
            order = np.argsort(key, kind="stable")
            new = np.ones(n, np.int64)
            new[0:1] = 0
            new[1:] = key[order][1:] != key[order][:-1]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new)
            step *= 2
        self.order = order
        bwt = text[order - 1].astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])
        self.levels: list[tuple[int, Bits]] = []
        for level in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            bit = (bwt >> level & 1).astype(bool)
            self.levels.append((level, Bits(bit)))
            bwt = np.concatenate([bwt[~bit], bwt[bit]])
        self.base = self._down(np.zeros(size, np.int64), np.arange(size))

    def _down(self, i: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        for level, bits in self.levels:
            ones = bits.rank(i)
            i = np.where(symbol >> level & 1, bits.zeros + ones, i - ones)
        return i

    def extend(self, lo: np.ndarray, hi: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one more symbol in front."""
        shift = self.first[symbol] - self.base[symbol]
        return self._down(lo, symbol) + shift, self._down(hi, symbol) + shift

    def matches(self, text: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics up to ``length`` for patterns that end before the
        given positions of ``text`` and occur in the index: the symbols matched
        while the interval holds more than one suffix, and the last interval. A
        search ends once its pattern occurs only once."""
        last = text[ends - 1]
        lo, hi = self.first[last].copy(), self.first[last + 1].copy()
        matched = np.ones(len(ends), np.int64)
        live = np.flatnonzero(hi - lo > 1)
        for k in range(2, length + 1):
            if not len(live):
                break
            lo[live], hi[live] = self.extend(lo[live], hi[live], text[ends[live] - k])
            live = live[hi[live] - lo[live] > 1]
            matched[live] = k
        return matched, lo, hi
