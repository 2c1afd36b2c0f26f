"""A run-length index: the run-compressed Burrows-Wheeler transform of some strings with
suffix-array samples at run ends, and matching statistics streamed over it.

Follows the r-index (T. Gagie, G. Navarro, N. Prezza, 2018) and PHONI (C. Boucher
et al., 2021): patterns are read from right to left; where the next symbol
differs from that of the current run, the match goes on from the nearest end of
a run of that symbol, whose text position is sampled, and its length is the
longest common extension of the two positions.  All patterns take each step
together, in numpy.
"""

from __future__ import annotations

import numpy as np


def suffix_array(x: np.ndarray) -> np.ndarray:
    """Positions of the suffixes in order, by prefix doubling; all suffixes of ``x`` must differ
    (each string ends with a symbol of its own)."""
    n = len(x)
    names, rank = np.unique(x, return_inverse=True)
    rank, base, step = rank.astype(np.int64) + 1, len(names) + 1, 1
    if base ** 3 < 1 << 62:                 # three symbols at once
        ahead = np.r_[rank, 0, 0]
        rank, step = (ahead[:-2] * base + ahead[1:-1]) * base + ahead[2:], 3
        rank = np.unique(rank, return_inverse=True)[1].astype(np.int64) + 1
    while True:
        key = rank * (n + 2)
        key[:max(n - step, 0)] += rank[step:]
        order = np.argsort(key)
        sorted_key = key[order]
        new = np.r_[1, 1 + np.cumsum(sorted_key[1:] != sorted_key[:-1])]
        if new[-1] == n:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = new
        step *= 2


class RunIndex:
    """``strings``: arrays of symbols of 0 and more."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        """``symbols``: the strings one after another, of these lengths."""
        m = len(lengths)
        ends = np.cumsum(lengths)
        # an end mark of its own after each string: -1, -2, ...
        x = np.insert(symbols.astype(np.int64), ends, -1 - np.arange(m))
        order = suffix_array(x)
        before = x[order - 1]                      # the transform: the symbol before each suffix
        change = np.r_[True, before[1:] != before[:-1]]
        self.start = np.flatnonzero(change)        # of each run
        self.symbol = before[self.start]
        self.n = len(x)
        size = np.diff(np.r_[self.start, self.n])
        last = self.start + size - 1
        self.size = size
        self.head, self.tail = order[self.start], order[last]     # sampled positions
        by_symbol = np.argsort(self.symbol, kind="stable")
        self.to = np.empty(len(size), np.int64)    # where the last-to-first mapping takes a run
        self.to[by_symbol] = np.cumsum(size[by_symbol]) - size[by_symbol]
        self.by_symbol = by_symbol
        self.names, rank = np.unique(self.symbol, return_inverse=True)
        self.places = rank[by_symbol] * (self.n + 1) + self.start[by_symbol]
        self.text = np.r_[x, np.full(1, np.iinfo(np.int64).min)]  # for extensions

    def _extension(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How far the texts from ``a`` and ``b`` agree, up to ``most``."""
        out = np.zeros(len(a), np.int64)
        for i in range(0, len(a), 2048):
            part = slice(i, i + 2048)
            reach = np.arange(int(most[part].max(initial=0)))
            if not len(reach):
                continue
            at = lambda p: self.text[np.minimum(p[part, None] + reach, self.n)]
            same = np.cumprod(at(a) == at(b), axis=1, dtype=np.int8).sum(1, dtype=np.int64)
            out[part] = np.minimum(same, most[part])
        return out

    def statistics(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For each position of the patterns (one after another): the length of the longest
        match of the text from there, up to its pattern's end, with any string of the index."""
        out = np.zeros(len(symbols), np.int64)
        p_end = np.cumsum(lengths)
        by_length = np.argsort(-lengths, kind="stable")
        ends, sizes = p_end[by_length], lengths[by_length]
        rows = np.zeros(len(lengths), np.int64)
        places = np.full(len(lengths), self.head[0])
        match = np.zeros(len(lengths), np.int64)
        for t in range(int(sizes.max(initial=0))):
            k = int(np.searchsorted(-sizes, -t, "left"))       # patterns longer than t
            at = ends[:k] - 1 - t
            c = symbols[at]
            q, p, l_ = rows[:k], places[:k], match[:k]
            run = np.searchsorted(self.start, q, "right") - 1
            other = np.flatnonzero(self.symbol[run] != c)
            p = p - 1                # as if matched; put right below
            l_ = l_ + 1
            q = self.to[run] + q - self.start[run]
            if len(other):
                name = np.minimum(np.searchsorted(self.names, c[other]), len(self.names) - 1)
                known = self.names[name] == c[other]
                place = np.searchsorted(self.places, name * (self.n + 1) + rows[other])
                base = name * (self.n + 1)
                after = np.minimum(place, len(self.places) - 1)
                before = np.maximum(place - 1, 0)
                has_after = known & (place < len(self.places)) & (self.places[after] // (self.n + 1) * (self.n + 1) == base)
                has_before = known & (place > 0) & (self.places[before] // (self.n + 1) * (self.n + 1) == base)
                run_a, run_b = self.by_symbol[after], self.by_symbol[before]
                now, most = places[other], match[other]
                far_a = np.where(has_after, self._extension(now, self.head[run_a], most), -1)
                far_b = np.where(has_before, self._extension(now, self.tail[run_b], most), -1)
                up = far_a >= far_b
                chosen = np.where(up, run_a, run_b)
                q[other] = self.to[chosen] + np.where(up, 0, self.size[chosen] - 1)
                p[other] = np.where(up, self.head[run_a], self.tail[run_b]) - 1
                l_[other] = np.maximum(far_a, far_b) + 1
                lost = other[~(has_after | has_before)]          # the symbol is nowhere in the index
                q[lost], p[lost], l_[lost] = 0, self.head[0], 0
            rows[:k], places[:k], match[:k] = q, p, l_
            out[at] = l_
        return out
