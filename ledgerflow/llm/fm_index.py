"""FM-index over word ids in numpy: backward search by wavelet ranks, location by sampled suffix positions.

The text is an array of symbols. Symbol 0 is a stop: each stop stands for
itself alone, never matches, and sorts before all words by position. The
wavelet matrix keeps one bit vector per bit of the symbol, packed with a
running count per 64-bit word, so a rank takes two lookups a level.
"""

from __future__ import annotations

import numpy as np

#: Every so many text positions one suffix position is kept.
SAMPLE = 16


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order. Stops are distinct, so a comparison ends at the next one.

    Prefix doubling that sorts again only the suffixes that still tie.
    """
    n = len(symbols)
    stops = np.flatnonzero(symbols == 0)
    rank = np.zeros(n + 1, np.int64)  # rank[n] = 0: the end sorts first
    rank[stops] = np.arange(1, len(stops) + 1)
    words = np.flatnonzero(symbols)
    order = words[np.argsort(symbols[words], kind="stable")]
    sa = np.concatenate([stops, order])
    base, key = len(stops) + 1, symbols[order].astype(np.int64)
    start = np.ones(len(order), bool)
    start[1:] = key[1:] != key[:-1]
    group = np.maximum.accumulate(np.where(start, np.arange(len(order)), 0))
    rank[order] = base + group  # rank of a suffix: the place of its group's first
    places, width = _tied(start), 1
    while len(places):
        at = sa[len(stops) + places]
        next_rank = rank[np.minimum(at + width, n)]
        own = rank[at]
        by = np.lexsort((next_rank, own))
        at, own, next_rank = at[by], own[by], next_rank[by]
        sa[len(stops) + places] = at
        start = np.ones(len(at), bool)
        start[1:] = (own[1:] != own[:-1]) | (next_rank[1:] != next_rank[:-1])
        group = np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))
        rank[at] = base + places[group]
        places = places[_tied(start)]
        width *= 2
    return sa


def _tied(start: np.ndarray) -> np.ndarray:
    """Places whose group has more than one member, given where groups start."""
    if not len(start):
        return np.zeros(0, np.int64)
    alone = start.copy()
    alone[:-1] &= start[1:]
    return np.flatnonzero(~alone)


class BitVector:
    """Bits with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    """Ranks of symbols in a sequence; highest bit first, zeros before ones at each level."""

    def __init__(self, sequence: np.ndarray, top: int):
        self.levels, rest = [], sequence
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            ones = (rest >> bit) & 1
            self.levels.append((bit, BitVector(ones), len(rest) - int(ones.sum())))
            rest = np.concatenate([rest[ones == 0], rest[ones == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        low, at = np.zeros_like(at), at.copy()
        for bit, vector, zeros in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)
            low_ones, ones = vector.rank(low), vector.rank(at)
            low = np.where(one, zeros + low_ones, low - low_ones)
            at = np.where(one, zeros + ones, at - ones)
        return at - low

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and how often it occurs before."""
        low, at, symbol = np.zeros_like(at), at.copy(), np.zeros_like(at)
        for bit, vector, zeros in self.levels:
            one = vector.get(at)
            symbol |= one.astype(np.int64) << bit
            low_ones, ones = vector.rank(low), vector.rank(at)
            low = np.where(one, zeros + low_ones, low - low_ones)
            at = np.where(one, zeros + ones, at - ones)
        return symbol, at - low


class FMIndex:
    """Index of one shard. ``symbols`` holds values from 0 (stop) to ``top``."""

    def __init__(self, symbols: np.ndarray, top: int):
        symbols = np.append(symbols, 0)  # the text ends in a stop, and one stands before it
        sa = suffix_array(symbols)
        self.n = len(symbols)
        self.bwt = WaveletMatrix(np.where(sa > 0, symbols[sa - 1], 0).astype(np.int64), top)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=top + 1))])
        # a walk ends at a sampled position, or right behind a stop, whose row in the index isn't its rank
        kept = (sa % SAMPLE == 0) | (sa == 0) | (symbols[sa - 1] == 0)
        self.sampled, self.samples = BitVector(kept), sa[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of each phrase; ``phrases`` is right-aligned, (phrases, longest), without stops."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        width, active = phrases.shape[1], np.arange(len(phrases))
        for k in range(1, width + 1):
            active = active[(lengths[active] >= k) & (high[active] > low[active])]
            if not len(active):
                break
            symbol = phrases[active, width - k]
            low[active] = self.less[symbol] + self.bwt.rank(symbol, low[active])
            high[active] = self.less[symbol] + self.bwt.rank(symbol, high[active])
        high = np.maximum(high, low)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: walk back to a sampled row and add the steps."""
        found, rows = np.zeros(len(rows), np.int64), rows.copy()
        walking, steps = np.arange(len(rows)), 0
        while len(walking):
            at = rows[walking]
            there = self.sampled.get(at)
            found[walking[there]] = self.samples[self.sampled.rank(at[there])] + steps
            walking, at = walking[~there], at[~there]
            if len(walking):
                symbol, rank = self.bwt.symbol_and_rank(at)
                rows[walking] = self.less[symbol] + rank
            steps += 1
        return found
