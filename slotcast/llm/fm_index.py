"""FM-index of a shard of word sequences, for matches of up to ``k`` words.

Rows are the suffixes sorted by their first k symbols; the Burrows-Wheeler transform is kept in a
wavelet matrix (one bit per symbol and level, with a count per 64 bits), and the suffix order itself
is dropped. All queries of a shard advance together, one symbol a step.
"""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Bit-packed levels over symbols 0 .. sigma - 1 with constant-time rank per level."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        now = symbols.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            bit = ((now >> level) & 1).astype(bool)
            packed = np.packbits(np.concatenate((bit, np.zeros(128 - len(bit) % 64, dtype=bool))), bitorder="little")
            words = packed.view("<u8")
            self.bits.append(words)
            self.counts.append(np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64))))
            self.zeros.append(int(len(bit) - bit.sum()))
            now = np.concatenate((now[~bit], now[bit]))
        self.start = self._walk(np.arange(sigma), np.zeros(sigma, dtype=np.int64))

    def _walk(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i in range(self.levels):
            word, rest = at >> 6, (at & 63).astype(np.uint64)
            below = self.bits[i][word] & ((np.uint64(1) << rest) - np.uint64(1))
            ones = self.counts[i][word] + np.bitwise_count(below)
            one = (symbols >> (self.levels - 1 - i)) & 1
            at = np.where(one == 1, self.zeros[i] + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        return self._walk(symbols, at) - self.start[symbols]


class FMIndex:
    """Index over ``text`` (symbols 1 .. sigma - 1, 0 separates sequences); ``owner`` gives each
    position's document."""

    def __init__(self, text: np.ndarray, owner: np.ndarray, k: int):
        self.k, n = k, len(text)
        text = np.asarray(text, dtype=np.int64)
        rank, have = text, 1
        while have < k:         # ranks by the first 2, 4, 8, ... k symbols; past the end counts as 0
            step = min(have, k - have)
            nxt = np.concatenate((rank[step:], np.zeros(step, dtype=np.int64)))
            _, rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + nxt, return_inverse=True)
            have += step
        order = np.argsort(rank, kind="stable")
        sigma = int(text.max(initial=0)) + 1
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))
        self.bwt = WaveletMatrix(text[order - 1], sigma)
        # common symbols of neighbouring rows, up to k
        padded = np.concatenate((text, np.zeros(k, dtype=np.int64)))
        same = np.zeros(n, dtype=np.int8)
        alive = np.ones(max(0, n - 1), dtype=bool)
        for i in range(k):
            alive &= padded[order[1:] + i] == padded[order[:-1] + i]
            same[1:] += alive
        self.starts = [None] * (k + 1)
        for length in (k - 1, k):
            self._class(length, same)
        self.same = same
        self.n, self.sigma = n, sigma
        self.least_owner = np.minimum.reduceat(owner[order], self.starts[k][:-1]) if n else owner
        self.class_k, self.class_up = (np.cumsum(same < x) - 1 for x in (k, k - 1))

    def _class(self, length: int, same: np.ndarray) -> np.ndarray:
        """Row bounds of the groups that agree in their first ``length`` symbols."""
        if self.starts[length] is None:
            begin = same < length
            begin[:1] = True
            self.starts[length] = np.append(np.flatnonzero(begin), len(same))
        return self.starts[length]

    def _widen(self, rows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        bounds = self._class(length, self.same)
        at = self.class_up[rows] if length == self.k - 1 else np.searchsorted(bounds, rows, side="right") - 1
        return bounds[at], bounds[at + 1]

    def _extend(self, symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = self.first[symbols]
        return base + self.bwt.rank(symbols, lo), base + self.bwt.rank(symbols, hi)

    def matching_statistics(self, queries: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every position of the concatenated queries (query i is bounds[i]:bounds[i + 1]; symbols
        outside the index are 0 or less): the longest match that starts there, up to k symbols, and for matches of k
        symbols the least owner among its occurrences (else -1)."""
        length = np.zeros(len(queries), dtype=np.int64)
        least = np.full(len(queries), -1, dtype=np.int64)
        sizes = np.diff(bounds)
        by_size = np.argsort(-sizes, kind="stable")
        ends, sizes = bounds[1:][by_size], sizes[by_size]
        lo, hi = np.zeros(len(sizes), dtype=np.int64), np.full(len(sizes), self.n, dtype=np.int64)
        have = np.zeros(len(sizes), dtype=np.int64)
        for step in range(int(sizes.max(initial=0))):
            m = int(np.searchsorted(-sizes, -step, side="left"))    # queries longer than step
            lo, hi, have = lo[:m], hi[:m], have[:m]
            at = ends[:m] - 1 - step
            symbols = queries[at]
            known = (symbols > 0) & (symbols < self.sigma)
            a, b = np.zeros(m, dtype=np.int64), np.zeros(m, dtype=np.int64)
            a[known], b[known] = self._extend(symbols[known], lo[known], hi[known])
            stuck = np.flatnonzero(known & (b <= a) & (have > 0))
            while len(stuck):       # drop the last symbol and try again
                have[stuck] -= 1
                for x in np.unique(have[stuck]):
                    some = stuck[have[stuck] == x]
                    lo[some], hi[some] = self._widen(lo[some], int(x)) if x else (0, self.n)
                a[stuck], b[stuck] = self._extend(symbols[stuck], lo[stuck], hi[stuck])
                stuck = stuck[(b[stuck] <= a[stuck]) & (have[stuck] > 0)]
            good = b > a
            have = np.where(good, have + 1, 0)
            lo, hi = np.where(good, a, 0), np.where(good, b, self.n)
            length[at] = have
            full = np.flatnonzero(have == self.k)
            least[at[full]] = self.least_owner[self.class_k[lo[full]]]
            lo[full], hi[full] = self._widen(lo[full], self.k - 1)
            have[full] = self.k - 1
        return length, least
