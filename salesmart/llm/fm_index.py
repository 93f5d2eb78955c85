"""FM-index over sequences of small integers, with numpy inside.

The text is a collection of runs, each closed by its own terminator.  Built
from the full suffix order: a wavelet tree (one bit vector with rank counts
per level) over the last column answers rank queries for backward search, and
every ``step``-th text position is kept to locate occurrences.  All queries
run over arrays of patterns at once.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64


class Bits:
    """A bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(U64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(counts)[:-1]))
        self.ones = int(counts.sum())

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        w = i >> 6
        low = (U64(1) << (i & 63).astype(U64)) - U64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & low).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(U64)) & U64(1)).astype(np.int64)


class WaveletTree:
    """Rank of a symbol before a position, for arrays of both (levels are
    kept as a wavelet matrix: zeros of a level first, then its ones)."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.n = len(symbols)
        self.levels: list[tuple[int, Bits, int]] = []
        s = symbols
        for shift in range(max(1, int(top).bit_length()) - 1, -1, -1):
            bit = (s >> shift) & 1
            self.levels.append((shift, Bits(bit.astype(np.uint8)), int(self.n - bit.sum())))
            s = np.concatenate((s[bit == 0], s[bit == 1]))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        lo, hi = np.zeros_like(i), i.copy()
        for shift, bits, zeros in self.levels:
            one = ((symbol >> shift) & 1).astype(bool)
            a, b = bits.rank(lo), bits.rank(hi)
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
        return hi - lo

    def access(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros_like(i)
        for shift, bits, zeros in self.levels:
            bit, a = bits.get(i), bits.rank(i)
            out |= bit << shift
            i = np.where(bit == 1, zeros + a, i - a)
        return out


def suffix_order(text: np.ndarray, top: int) -> np.ndarray:
    """Suffix array of ``text`` (symbols 0..top), by prefix doubling over the
    suffixes that are still tied.  Symbol 0 ends a run; each 0 is its own
    symbol, smaller than all others and ordered by position."""
    n = len(text)
    zeros = np.flatnonzero(text == 0)
    rank0 = text.astype(np.int64) + len(zeros)
    rank0[zeros] = np.arange(len(zeros))
    order = np.argsort(rank0, kind="stable")
    rank = np.empty(n, np.int64)
    first = np.concatenate(([True], np.diff(rank0[order]) != 0))
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    # Suffixes whose rank is shared stay in `order` at their group's places.
    h = 1
    while True:
        last = np.concatenate((first[1:], [True]))
        tied = np.flatnonzero(~(first & last))
        if not len(tied):
            return order
        sub = order[tied]
        group = rank[sub]
        # A tied suffix has at least h symbols before its terminator, so
        # sub + h is inside the text.
        key = group * n + rank[sub + h]
        by = np.argsort(key, kind="stable")
        sub, key = sub[by], key[by]
        order[tied] = sub
        new = np.concatenate(([True], np.diff(key) != 0))
        first[tied] = new
        rank[sub] = np.maximum.accumulate(np.where(new, tied, 0))
        h *= 2


class FMIndex:
    def __init__(self, text: np.ndarray, top: int, step: int = 16):
        """``text`` holds symbols 1..top and 0 after each run; it ends in 0."""
        self.n, self.step = len(text), step
        order = suffix_order(text, top)
        last = text[order - 1]  # of the first position: the final terminator
        counts = np.bincount(text, minlength=top + 1)
        self.smaller = np.concatenate(([0], np.cumsum(counts)))
        self.tree = WaveletTree(last, top)
        # Run starts are kept too: a walk must not cross a terminator, as the
        # terminators' order in the last column is not that of their places.
        kept = (order % step == 0) | (last == 0)
        self.kept, self.samples = Bits(kept.astype(np.uint8)), order[kept]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of the patterns (rows, symbols 1..top, the
        first ``lengths`` of each row count; 0 elsewhere)."""
        lo = np.zeros(len(patterns), np.int64)
        hi = np.full(len(patterns), self.n, np.int64)
        for j in range(patterns.shape[1]):
            at = lengths - 1 - j
            on = np.flatnonzero((at >= 0) & (lo < hi))
            if not len(on):
                break
            c = patterns[on, at[on]]
            lo[on] = self.smaller[c] + self.tree.rank(c, lo[on])
            hi[on] = self.smaller[c] + self.tree.rank(c, hi[on])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, walking back to sampled ones."""
        out = np.empty(len(rows), np.int64)
        at, which, moved = rows.copy(), np.arange(len(rows)), 0
        while len(at):
            hit = self.kept.get(at) == 1
            out[which[hit]] = self.samples[self.kept.rank(at[hit])] + moved
            at, which = at[~hit], which[~hit]
            c = self.tree.access(at)
            at = self.smaller[c] + self.tree.rank(c, at)
            moved += 1
        return out
