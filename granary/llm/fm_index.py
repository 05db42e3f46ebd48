"""A compressed FM-index over integer symbols: Burrows-Wheeler transform, wavelet matrix of packed bits, range minima."""

from __future__ import annotations

import numpy as np


class BitRank:
    """Bits in 64-bit words with a running count for each word."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)].astype(np.int32)

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place i."""
        w = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & low)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, top: int):
        self.depth = max(1, top.bit_length())
        self.levels, self.zeros = [], []
        s = symbols
        for b in range(self.depth - 1, -1, -1):
            bit = (s >> b) & 1
            self.levels.append(BitRank(bit.astype(np.uint8)))
            self.zeros.append(int(len(s) - bit.sum()))
            s = np.concatenate([s[bit == 0], s[bit == 1]])
        # Where each symbol's run begins on the last level.
        self.start = np.searchsorted(self._order(s), self._order(np.arange(1 << self.depth)))

    def _order(self, s: np.ndarray) -> np.ndarray:
        """Symbols by reversed bits, the order of the last level."""
        out = np.zeros_like(s)
        for b in range(self.depth):
            out |= ((s >> b) & 1) << (self.depth - 1 - b)
        return out

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place i."""
        at = i
        for b, (level, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            ones = level.ones(at)
            at = np.where((symbol >> (self.depth - 1 - b)) & 1, zeros + ones, at - ones)
        return at - self.start[symbol]


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Prefix doubling."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    k = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - k)] = rank[k:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, np.int64)
        sorted_ = key[order]
        new[order] = np.r_[0, np.cumsum(sorted_[1:] != sorted_[:-1])]
        rank = new
        if n == 0 or rank[order[-1]] == n - 1:
            return order
        k *= 2


class RangeMin:
    """Sparse table over minima of runs of ``RUN`` values; the ends of a range are looked at directly."""

    RUN = 16

    def __init__(self, v: np.ndarray):
        top = np.iinfo(v.dtype).max
        self.runs = np.concatenate([v, np.full(-len(v) % self.RUN + self.RUN, top, v.dtype)]).reshape(-1, self.RUN)
        self.left, self.right = np.minimum.accumulate(self.runs, axis=1), np.minimum.accumulate(self.runs[:, ::-1], axis=1)[:, ::-1]
        tables, w = [self.left[:, -1].copy()], 1
        while 2 * w <= len(tables[0]):
            t = tables[-1].copy()
            t[: len(t) - w] = np.minimum(tables[-1][:-w], tables[-1][w:])
            tables.append(t)
            w *= 2
        self.table = np.stack(tables)

    def get(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum over [lo, hi), which is not empty."""
        a, b = lo // self.RUN, (hi - 1) // self.RUN
        out = np.minimum(self.right[a, lo % self.RUN], self.left[b, (hi - 1) % self.RUN])
        one = np.flatnonzero(a == b)
        if len(one):
            place = np.arange(self.RUN)
            inside = (place >= (lo[one] % self.RUN)[:, None]) & (place <= ((hi[one] - 1) % self.RUN)[:, None])
            out[one] = np.where(inside, self.runs[a[one]], np.iinfo(out.dtype).max).min(axis=1)
        many = np.flatnonzero(b > a + 1)
        if len(many):
            x, y = a[many] + 1, b[many]
            k = np.frexp((y - x).astype(np.float64))[1] - 1
            out[many] = np.minimum(out[many], np.minimum(self.table[k, x], self.table[k, y - (1 << k)]))
        return out


class FMIndex:
    """Texts (arrays of symbols from 1 to top) with an owner each; a range of suffixes knows its smallest owner."""

    def __init__(self, texts: list[np.ndarray], owners: np.ndarray, top: int):
        n = len(texts)
        body = np.concatenate([x for i, t in enumerate(texts) for x in (t + n, np.array([n - 1 - i]))]) if n else np.zeros(0, np.int64)
        sa = suffix_array(body)
        before = body[sa - 1] if len(sa) else sa
        last = np.where(before < n, 0, before - n)  # separators are never searched for
        self.wavelet = WaveletMatrix(last, top)
        counts = np.bincount(np.where(body < n, 0, body - n), minlength=1 << self.wavelet.depth)
        self.first = np.r_[0, np.cumsum(counts)]
        self.size = len(body)
        #: Owners by rank, in 32 bits.
        self.names = np.unique(owners)
        rank = np.searchsorted(self.names, owners).astype(np.int32)
        self.owner = RangeMin(np.repeat(rank, [len(t) + 1 for t in texts])[sa]) if n else None

    def back(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of symbol + string from ranges of string."""
        r = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        base = self.first[symbol]
        return base + r[: len(lo)], base + r[len(lo) :]

    def repeated(self, texts: list[np.ndarray], owners: np.ndarray, length: int) -> list[list[tuple[int, int]]]:
        """For each streamed text the maximal intervals [a, b) of at least ``length`` symbols that occur in a text of a smaller owner.

        All texts advance together, one backward step a turn. Where a match ends before place s, the longest stretch that
        starts at s and still matches is found by halving, and the search goes on from its end.
        """
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        if not texts or self.owner is None:
            return out
        owners = np.searchsorted(self.names, owners)  # a smaller owner has a smaller rank
        sizes = np.array([len(t) for t in texts])
        base = np.r_[0, np.cumsum(sizes)][:-1]
        flat = np.concatenate(texts)
        lane = np.flatnonzero(sizes >= length)
        end = sizes[lane] - 1
        pos = end.copy()
        lo, hi = np.zeros(len(lane), np.int64), np.full(len(lane), self.size)
        floor = np.full(len(lane), -1)  # of a halving probe; -1: a free search
        good, bad = np.zeros(len(lane), np.int64), np.zeros(len(lane), np.int64)
        while len(lane):
            nlo, nhi = self.back(flat[base[lane] + pos], lo, hi)
            ok = nhi > nlo
            at = np.flatnonzero(ok)
            ok[at] = self.owner.get(nlo[at], nhi[at]) < owners[lane[at]]
            lo, hi = np.where(ok, nlo, lo), np.where(ok, nhi, hi)
            free = floor < 0
            # A free search that fails at s, or that reaches the text's start.
            stop = free & (~ok | (pos == 0))
            left = np.where(ok, pos, pos + 1)
            for i in np.flatnonzero(stop & (end + 1 - left >= length)):
                out[lane[i]].append((int(left[i]), int(end[i]) + 1))
            done = free & ok & (pos == 0)
            fail = free & ~ok
            good, bad = np.where(fail, pos - 1, good), np.where(fail, np.minimum(end, pos + length), bad)
            floor = np.where(fail, pos, floor)
            # A probe from mid = end down to floor.
            probe = ~free & (~ok | (pos == floor))
            good, bad = np.where(probe & ok, end, good), np.where(probe & ~ok, end, bad)
            turn = fail | probe
            settled = turn & (bad - good <= 1)
            end = np.where(settled, good, np.where(turn, (good + bad) >> 1, end))
            floor = np.where(settled, -1, floor)
            pos = np.where(turn, end, np.where(done, pos, pos - 1))
            lo, hi = np.where(turn, 0, lo), np.where(turn, self.size, hi)
            keep = ~done & ((floor >= 0) | (end + 1 >= length))
            if not keep.all():
                lane, end, pos, lo, hi, floor, good, bad = (x[keep] for x in (lane, end, pos, lo, hi, floor, good, bad))
        return out
