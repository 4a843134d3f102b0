"""An FM-index over a sequence of integers: suffix order, wavelet-tree ranks, backward search, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray, bits: int) -> np.ndarray:
    """Starts of all suffixes in order, by prefix doubling over those that are still tied.

    `symbols` are below 2**bits. The first round orders by as many symbols as fit into 62 bits.
    """
    n = len(symbols)
    depth = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for k in range(depth):
        key <<= bits
        key[:max(n - k, 0)] |= symbols[k:] + 1
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    first = np.concatenate(([True], ranked[1:] != ranked[:-1])) if n else np.zeros(0, bool)
    slots = np.arange(n)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    begin = np.maximum.accumulate(np.where(first, slots, 0))
    rank[order] = begin
    tied = ~(first & np.append(first[1:], True)) if n else first
    slots = slots[tied]
    while slots.size:
        places = order[slots]
        follow = rank[np.minimum(places + depth, n)] + 1
        key = (rank[places] << 32) | follow
        by = np.argsort(key, kind="stable")
        places, key = places[by], key[by]
        order[slots] = places
        first = np.concatenate(([True], key[1:] != key[:-1]))
        rank[places] = slots[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
        slots = slots[~(first & np.append(first[1:], True))]
        depth *= 2
    return order


class WaveletTree:
    """Ranks of symbols in a sequence: a level per bit, each level stably parted by the bits above it."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.ones, self.zeros, self.bits = [], [], bits
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            count = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=count[1:])
            self.ones.append(count)
            self.zeros.append(len(symbols) - int(count[-1]))
            high = bit.astype(bool)
            symbols = np.concatenate((symbols[~high], symbols[high]))

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        low, high = np.zeros(len(end), np.int64), end.astype(np.int64)
        for k, level in enumerate(range(self.bits - 1, -1, -1)):
            one, left, right = ((symbol >> level) & 1).astype(bool), self.ones[k][low], self.ones[k][high]
            low = np.where(one, self.zeros[k] + left, low - left)
            high = np.where(one, self.zeros[k] + right, high - right)
        return high - low

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and how often it occurs before it."""
        symbol, low, place = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), at.astype(np.int64)
        for k in range(self.bits):
            here, left = self.ones[k][place], self.ones[k][low]
            one = self.ones[k][place + 1] > here
            symbol = (symbol << 1) | one
            low = np.where(one, self.zeros[k] + left, low - left)
            place = np.where(one, self.zeros[k] + here, place - here)
        return symbol, place - low


class FmIndex:
    """Counts and locates patterns in a sequence of symbols from 1 to `largest`."""

    def __init__(self, symbols: np.ndarray, largest: int, every: int = 16):
        closed = np.append(symbols, 0)  # 0 ends the sequence and occurs nowhere else
        bits = max(1, int(largest).bit_length())
        order = suffix_order(closed, bits + 1)
        last = closed[order - 1]
        self.before = np.concatenate(([0], np.cumsum(np.bincount(closed, minlength=largest + 1))))
        self.tree = WaveletTree(last, bits)
        self.size = len(closed)
        self.sampled = order % every == 0
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.samples = order[self.sampled]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per pattern (a row, aligned right) the range of suffixes that begin with it; backward, all patterns in step."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        alive = np.arange(len(patterns))
        for step in range(patterns.shape[1]):
            alive = alive[(high[alive] > low[alive]) & (lengths[alive] > step)]
            if not alive.size:
                break
            symbol = patterns[alive, patterns.shape[1] - 1 - step]
            low[alive] = self.before[symbol] + self.tree.rank(symbol, low[alive])
            high[alive] = self.before[symbol] + self.tree.rank(symbol, high[alive])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of these rows begin: walk left until a sampled one."""
        at, steps, found = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        left = np.arange(len(rows))
        while left.size:
            here = self.sampled[at[left]]
            done = left[here]
            found[done] = self.samples[self.sample_rank[at[done]]] + steps[done]
            left = left[~here]
            if left.size:
                symbol, rank = self.tree.symbol_and_rank(at[left])
                at[left] = self.before[symbol] + rank
                steps[left] += 1
        return found
