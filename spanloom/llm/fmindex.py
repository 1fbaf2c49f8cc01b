"""An FM-index over sequences of integers, in numpy, for use inside a task.

The text is made of runs of symbols 1, 2, ...; each run ends in a 0, and the
zeros count as different symbols in the order of their runs.  All suffixes
differ then, so the order of the suffixes that follow one symbol is the order
of the suffixes before it, as stepping back through the index needs.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with the number of ones before any place: 64-bit words, and a running count for each."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(n // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)).astype(np.int64) & 1


class WaveletTree:
    """Rank of any symbol, level by level from the highest bit; each level holds the zeros of the one above before its ones."""

    def __init__(self, symbols: np.ndarray, most: int):
        self.levels: list[tuple[int, Bits, int]] = []
        rest = symbols
        for level in reversed(range(max(1, int(most).bit_length()))):
            bits = (rest >> level) & 1 == 1
            self.levels.append((level, Bits(bits), int(len(bits) - bits.sum())))
            rest = np.concatenate((rest[~bits], rest[bits]))
        block = np.flatnonzero(np.diff(rest, prepend=-1))  # equal symbols lie together at last
        self.first = np.zeros(most + 1, np.int64)
        self.first[rest[block]] = block

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before the place beside it."""
        place = at
        for level, bits, zeros in self.levels:
            ones = bits.ones(place)
            place = np.where((symbol >> level) & 1 == 1, zeros + ones, place - ones)
        return place - self.first[symbol]

    def symbol(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it stands before."""
        place, symbol = at, np.zeros(len(at), np.int64)
        for level, bits, zeros in self.levels:
            one, ones = bits.get(place), bits.ones(place)
            symbol |= one << level
            place = np.where(one == 1, zeros + ones, place - ones)
        return symbol, place - self.first[symbol]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by doubling; only suffixes that are not told apart yet are sorted again."""
    n = len(text)
    ends = text == 0
    key = np.where(ends, np.cumsum(ends) - 1, text + ends.sum())
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)  # of each suffix: how many are less as far as compared
    ordered = key[order]
    rank[order] = np.searchsorted(ordered, ordered)
    size = np.bincount(rank, minlength=n)
    open_ = np.flatnonzero(size[rank] > 1)
    reach = 1
    while len(open_):
        # a suffix that is not told apart has no 0 within reach, so there is another suffix behind it
        key = rank[open_] * n + rank[open_ + reach]
        order = np.argsort(key, kind="stable")
        open_, key = open_[order], key[order]
        old = rank[open_]
        new = old + np.searchsorted(key, key) - np.searchsorted(old, old)
        rank[open_] = new
        alone = np.ones(len(open_), bool)
        alone[1:] &= new[1:] != new[:-1]
        alone[:-1] &= new[1:] != new[:-1]
        open_ = open_[~alone]
        reach *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


class FMIndex:
    """Counts and places of sequences in a text of runs (see above), by backward search."""

    def __init__(self, text: np.ndarray, most: int, every: int = 4):
        """``most``: the highest symbol; one suffix position in ``every`` of a run is kept."""
        n = len(text)
        suffixes = suffix_array(text)
        self.size = n
        self.tree = WaveletTree(text[suffixes - 1], most)
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=most + 1))))[: most + 1]
        begins = np.flatnonzero(np.concatenate(([True], text[:-1] == 0)))
        run = np.searchsorted(begins, np.arange(n), "right") - 1
        # the first of each run is kept, so no step back leaves a run
        kept = (np.arange(n) - begins[run]) % every == 0
        self.marked = Bits(kept[suffixes])
        self.samples = suffixes[kept[suffixes]]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows [low, high) of the suffixes that begin with each pattern (one a line, all of one length)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        open_ = np.arange(len(patterns))
        for column in reversed(range(patterns.shape[1])):
            symbol = patterns[open_, column]
            low[open_] = self.less[symbol] + self.tree.rank(symbol, low[open_])
            high[open_] = self.less[symbol] + self.tree.rank(symbol, high[open_])
            open_ = open_[low[open_] < high[open_]]
        found = low < high
        return np.where(found, low, 0), np.where(found, high, 0)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The place in the text of the suffix in each row: steps back to the next kept one."""
        place, row = np.zeros(len(rows), np.int64), rows.copy()
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            kept = self.marked.get(row[open_]) == 1
            done = open_[kept]
            place[done] = self.samples[self.marked.ones(row[done])] + steps
            open_ = open_[~kept]
            symbol, before = self.tree.symbol(row[open_])
            row[open_] = self.less[symbol] + before
            steps += 1
        return place
