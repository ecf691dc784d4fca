"""A compressed FM-index over word sequences: suffix order, a wavelet matrix of bit vectors, backward search.

All steps work on many patterns at once.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector of n bits in n bits plus one number per 64: rank by prefix count and population count."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, "<u8")
        words.view(np.uint8)[:len(packed)] = packed
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]))

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        word, below = i >> 6, (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Symbols by their bits, the highest first; every level sorts stably by its bit."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for bit in range(max(1, int(alphabet - 1).bit_length()) - 1, -1, -1):
            ones = (symbols >> bit & 1).astype(bool)
            self.levels.append((bit, Bits(ones), int(len(ones) - ones.sum())))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))

    def place(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where the first i positions' copies of the symbol end in the lowest level's order."""
        for bit, bits, zeros in self.levels:
            ones = bits.rank1(i)
            i = np.where(symbol >> bit & 1, zeros + ones, i - ones)
        return i


def suffix_order(ranks: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by prefix doubling. No suffix may be a prefix of another one."""
    n, step = len(ranks), 1
    ranks = np.unique(ranks, return_inverse=True)[1].astype(np.int64)
    while True:
        after = np.zeros(n, np.int64)
        after[:-step] = ranks[step:] + 1
        keys = ranks * (n + 1) + after
        order = np.argsort(keys, kind="stable")
        new = np.concatenate(([0], np.cumsum(np.diff(keys[order]) != 0)))
        ranks = np.empty(n, np.int64)
        ranks[order] = new
        if new[-1] == n - 1:
            return order
        step *= 2


class FMIndex:
    """Counts, with weights, how often word sequences start in a collection of sequences."""

    def __init__(self, words: np.ndarray, lengths: np.ndarray, weights: np.ndarray):
        """words: codes from 0, all sequences one after the other; weights: occurrences each sequence stands for."""
        count, ends = len(lengths), np.cumsum(lengths + 1) - 1
        at = np.ones(len(words) + count, bool)
        at[ends] = False
        # Each sequence ends in a mark of its own, below all words, so that all suffixes differ.
        text = np.empty(len(at), np.int64)
        text[at], text[ends] = words + count, np.arange(count)
        order = suffix_order(text)
        symbols = np.maximum(text - (count - 1), 0)  # one code for all marks
        self.alphabet = int(symbols.max(initial=0)) + 1
        self.first = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=self.alphabet))))
        self.tree = WaveletMatrix(symbols[order - 1], self.alphabet)
        self.start = self.tree.place(np.arange(self.alphabet), np.zeros(self.alphabet, np.int64))
        weight = np.repeat(weights, lengths + 1)
        self.weight = np.concatenate(([0], np.cumsum(weight[order])))
        self.size = len(text)

    def extend(self, word: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that start with the word and go on as those in lo..hi: one step backwards."""
        symbol = word + 1
        base = self.first[symbol] - self.start[symbol]
        both = self.tree.place(np.concatenate((symbol, symbol)), np.concatenate((lo, hi)))
        return base + both[:len(word)], base + both[len(word):]

    def count(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return self.weight[hi] - self.weight[lo]


def repeated_windows(index: FMIndex, words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, window: int,
                     least: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals (pattern, a, b) of word offsets whose every window counts at least `least` in the index.

    Matching statistics by backward search: a search extends to the left from an end while the
    count allows. The first one starts at the pattern's end and settles all windows within its match. Every
    further one starts at the end of the leftmost open window; where it fails, all windows
    that hold the failing piece are passed over at once.
    """
    count = len(starts)
    left, goal = np.zeros(count, np.int64), np.zeros(count, np.int64)  # leftmost open window; where a search may stop
    end, at = lengths.copy(), lengths.copy()
    lo, hi = np.zeros(count, np.int64), np.full(count, index.size)
    limit = lengths - window  # last open window
    whole = np.ones(count, bool)  # in the first search
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    live = np.flatnonzero(limit >= 0)
    while len(live):
        new_lo, new_hi = index.extend(words[starts[live] + at[live] - 1], lo[live], hi[live])
        going = index.count(new_lo, new_hi) >= least
        on = live[going]
        lo[on], hi[on] = new_lo[going], new_hi[going]
        at[on] -= 1
        ended = np.ones(len(live), bool)
        ended[going] = at[on] <= goal[on]
        over = live[ended]
        if not len(over):
            continue
        matched = end[over] - at[over] >= window
        hit = over[matched]
        found.append((hit, at[hit], end[hit]))
        first, later = over[whole[over]], over[~whole[over]]
        # All windows from the end of the first match on are settled: found, or not repeated.
        limit[first] = np.minimum(limit[first], at[first]) - 1
        left[later] = np.where(end[later] - at[later] >= window, left[later] + 1, at[later])
        whole[over] = False
        goal[over] = left[over]
        end[over] = at[over] = left[over] + window
        lo[over], hi[over] = 0, index.size
        live = live[left[live] <= limit[live]]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))
