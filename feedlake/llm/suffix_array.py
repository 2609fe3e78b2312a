"""Suffix arrays of byte texts by induced sorting, and capped permuted common prefixes (numpy)."""

from __future__ import annotations

import numpy as np

#: Buckets of at least so many suffixes on average are induced a bucket at a time, by numpy; the names of a
#: recursion's deeper level have smaller ones, and are induced suffix by suffix. Both give the same order.
FULL = 32


def _types(s: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than the next one (S), False for larger ones (L); the last one is S."""
    rising = np.append(s[:-1] < s[1:], True)
    settled = np.append(s[:-1] != s[1:], True)
    # an equal next character passes its type on: look up the end of each run
    at = np.where(settled, np.arange(len(s)), len(s))
    return rising[np.minimum.accumulate(at[::-1])[::-1]]


class _Text:
    def __init__(self, s: np.ndarray, size: int):
        self.s, self.small, self.size = s, _types(s), size
        ends = np.cumsum(np.bincount(s, minlength=size))
        self.heads, self.tails = np.r_[0, ends[:-1]], ends
        # character and type in one look-up; what comes before suffix 0 (index -1, the last one) has no type
        self.code = (s.astype(np.int32) << 2) | self.small
        self.code[-1] = 2

    @staticmethod
    def _place(sa: np.ndarray, at: np.ndarray, found: np.ndarray, chars: np.ndarray, step: int) -> None:
        """Append ``found``, in order, to the buckets of their characters; ``at`` moves by ``step`` a suffix."""
        chars = chars.astype(np.int16)
        order = np.argsort(chars, kind="stable")
        chars = chars[order]
        begin = np.flatnonzero(np.r_[True, chars[1:] != chars[:-1]])
        size = np.diff(np.r_[begin, len(chars)])
        own = chars[begin]
        sa[np.repeat(at[own] - step * begin, size) + step * np.arange(len(chars))] = found[order]
        at[own] += step * size

    def induce(self, lms: np.ndarray) -> np.ndarray:
        """The order of all suffixes from that of the leftmost smaller ones (or of their first characters alone)."""
        if len(self.s) < FULL * self.size:
            return self._one_by_one(lms)
        sa = np.full(len(self.s), -1, np.int32)
        last = self.tails - 1
        self._place(sa, last, lms[::-1], self.s[lms[::-1]], -1)
        first = self.heads.copy()
        for c in range(self.size):  # larger suffixes, from the smallest bucket on
            lo, begin = self.heads[c], last[c] + 1
            while lo < first[c]:
                hi = first[c]
                self._before(sa, sa[lo:hi], first, False, 1)
                lo = hi
            self._before(sa, sa[begin:self.tails[c]], first, False, 1)
        last = self.tails - 1
        for c in range(self.size - 1, -1, -1):  # smaller suffixes, from the largest bucket down
            hi = self.tails[c]
            while hi > last[c] + 1:
                lo = last[c] + 1
                self._before(sa, sa[lo:hi][::-1], last, True, -1)
                hi = lo
            self._before(sa, sa[self.heads[c]:first[c]][::-1], last, True, -1)
        return sa

    def _one_by_one(self, lms: np.ndarray) -> np.ndarray:
        """The same in one linear pass up and one down, with a pointer a bucket."""
        s, n = self.s.tolist(), len(self.s)
        # the bucket that a suffix induces into, if the one before it is larger, or smaller; -1: none (also for an empty place)
        up, down = ([-1, *np.where(own, self.s[:-1], -1).tolist(), -1] for own in (~self.small[:-1], self.small[:-1]))
        sa, last = [-1] * n, (self.tails - 1).tolist()
        for i in lms[::-1].tolist():
            c = s[i]
            sa[last[c]] = i
            last[c] -= 1
        first = self.heads.tolist()
        for i in sa:  # places ahead are filled on the way
            c = up[i]
            if c >= 0:
                sa[first[c]] = i - 1
                first[c] += 1
        last = (self.tails - 1).tolist()
        for i in reversed(sa):
            c = down[i]
            if c >= 0:
                sa[last[c]] = i - 1
                last[c] -= 1
        return np.array(sa, np.int32)

    def _before(self, sa: np.ndarray, suffixes: np.ndarray, at: np.ndarray, small: bool, step: int) -> None:
        code = self.code[suffixes - 1]
        keep = np.flatnonzero((code & 3) == small)
        if len(keep):
            self._place(sa, at, suffixes[keep] - 1, code[keep] >> 2, step)


def _names(s: np.ndarray, order: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Names of the substrings s[order : stop] (stop included) in that order: equal substrings share a name."""
    a, b = order[:-1], order[1:]
    length = stop - order
    same = length[:-1] == length[1:]
    open_, step = np.flatnonzero(same), 0
    while len(open_) > 32:
        equal = s[a[open_] + step] == s[b[open_] + step]
        same[open_[~equal]] = False
        open_ = open_[equal & (length[open_] > step)]
        step += 1
    for i in open_:
        same[i] = np.array_equal(s[a[i]:a[i] + length[i] + 1], s[b[i]:b[i] + length[i] + 1])
    return np.cumsum(np.r_[0, ~same])


def suffix_array(s: np.ndarray, size: int) -> np.ndarray:
    """Order of the suffixes of ``s``, whole numbers below ``size`` that end with the only 0."""
    if len(s) == 1:
        return np.zeros(1, np.int32)
    text = _Text(s, size)
    lms = np.flatnonzero(text.small[1:] & ~text.small[:-1]).astype(np.int32) + 1
    sa = text.induce(lms)
    is_lms = np.zeros(len(s), bool)
    is_lms[lms] = True
    order = sa[is_lms[sa]]
    stop = np.empty(len(s), np.int32)  # of a leftmost smaller substring: the next one's begin
    stop[lms] = np.append(lms[1:], len(s) - 1)
    names = _names(s, order, stop[order])
    if names[-1] + 1 < len(lms):
        reduced = np.empty(len(s), np.int64)
        reduced[order] = names
        order = lms[suffix_array(reduced[lms], int(names[-1]) + 1)]
    return text.induce(order)


def permuted_common_prefixes(data: np.ndarray, sa: np.ndarray, cap: int, at: np.ndarray | None = None) -> np.ndarray:
    """For each suffix in text order, the bytes it shares with its predecessor in ``sa``, at most ``cap``.
    With ``at`` only the suffixes that begin there are looked at; the others have 0."""
    padded = np.r_[data, np.zeros(cap + 8, np.uint8)]
    words = np.lib.stride_tricks.as_strided(padded, (len(padded) - 7, 8), (1, 1))
    before = np.full(len(data), -1, np.int32)
    before[sa[1:]] = sa[:-1]
    shared = np.zeros(len(data), np.int32)
    open_ = np.flatnonzero(before >= 0) if at is None else at[before[at] >= 0]
    for step in range(0, cap, 8):
        unlike = words[open_ + step].view(np.uint64).ravel() ^ words[before[open_] + step].view(np.uint64).ravel()
        lowest = unlike & (~unlike + np.uint64(1))
        # the lowest byte that differs comes first in memory; 8 where none does
        shared[open_] = step + np.where(unlike == 0, 8, (np.frexp(lowest.astype(np.float64))[1] - 1) // 8)
        open_ = open_[unlike == 0]
    return np.minimum(np.minimum(shared, cap), len(data) - np.maximum(np.arange(len(data), dtype=np.int32), before))
