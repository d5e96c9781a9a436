"""FM-index over a sequence of small integers, on numpy arrays.

The text is a list of runs of symbols 1..alphabet, each run ended by its own
sentinel (symbol 0; sentinels sort by place, before every symbol).  Suffixes
are sorted by prefix doubling, the BWT is stored as a wavelet matrix, and
backward search, access and locating work on whole arrays of queries.
"""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Rank and access over an integer sequence, one bit plane per level."""

    def __init__(self, sequence: np.ndarray, alphabet: int):
        self.levels = max(1, int(alphabet).bit_length())
        self.ones, self.zeros = [], []
        rest = sequence
        for level in range(self.levels - 1, -1, -1):
            bit = (rest >> level) & 1
            ones = np.zeros(len(rest) + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(rest) - int(ones[-1]))
            rest = np.concatenate((rest[bit == 0], rest[bit == 1]))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        start, end = np.zeros_like(place), place.copy()
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            up = ((symbol >> (self.levels - 1 - k)) & 1).astype(bool)
            s1, e1 = ones[start], ones[end]
            start, end = np.where(up, zeros + s1, start - s1), np.where(up, zeros + e1, end - e1)
        return end - start

    def access(self, place: np.ndarray) -> np.ndarray:
        """The symbol at each place."""
        symbol, at = np.zeros_like(place), place.copy()
        for ones, zeros in zip(self.ones, self.zeros):
            before = ones[at]
            up = ones[at + 1] > before
            symbol = symbol * 2 + up
            at = np.where(up, zeros + before, at - before)
        return symbol


def suffix_array(text: np.ndarray, alphabet: int) -> np.ndarray:
    """Suffixes in order; every 0 in ``text`` is a sentinel of its own."""
    n = len(text)
    sentinel = text == 0
    rank = text.astype(np.int64) + int(sentinel.sum())
    rank[sentinel] = np.arange(int(sentinel.sum()))
    step = 1
    while True:
        # the rank of the suffix `step` further on; past a sentinel nothing is compared, for it is unique
        further = np.zeros(n, dtype=np.int64)
        further[:-step or n] = rank[step:] + 1 if step < n else 0
        key = rank * (n + alphabet + 2) + further
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.zeros(n, dtype=np.int64)
        new[1:] = np.cumsum(sorted_key[1:] != sorted_key[:-1])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        if n == 0 or new[-1] == n - 1:
            return order
        step *= 2


class FMIndex:
    """Count and locate phrases in runs of symbols."""

    def __init__(self, text: np.ndarray, alphabet: int, sample: int = 16):
        """text: symbols with a 0 after each run (so the last symbol is 0); every ``sample``-th place is kept."""
        self.n = len(text)
        order = suffix_array(text, alphabet)
        bwt = text[order - 1]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=alphabet + 1)))).astype(np.int64)
        self.bwt = WaveletMatrix(bwt.astype(np.int64), alphabet)
        # places kept: every sample-th and the first of each run, so that no walk crosses a sentinel
        kept = (order % sample == 0) | (bwt == 0)
        self.kept = kept
        self.kept_rank = np.concatenate(([0], np.cumsum(kept)))
        self.kept_place = order[kept]

    def _back(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.first[symbol] + self.bwt.rank(symbol, row)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix rows [low, high) of each phrase; row i of ``phrases`` holds it in its first lengths[i] cells."""
        low, high = np.zeros(len(phrases), dtype=np.int64), np.full(len(phrases), self.n, dtype=np.int64)
        for step in range(int(lengths.max(initial=0))):
            live = np.flatnonzero((step < lengths) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, lengths[live] - 1 - step].astype(np.int64)
            low[live], high[live] = self._back(symbol, low[live]), self._back(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text place of each suffix row."""
        row, steps = rows.astype(np.int64).copy(), np.zeros(len(rows), dtype=np.int64)
        walk = np.flatnonzero(~self.kept[row])
        while len(walk):
            row[walk] = self._back(self.bwt.access(row[walk]), row[walk])
            steps[walk] += 1
            walk = walk[~self.kept[row[walk]]]
        return self.kept_place[self.kept_rank[row]] + steps
