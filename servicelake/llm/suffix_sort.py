"""Suffix arrays by induced sorting, over numpy arrays.

Suffixes are classed as smaller (S) or larger (L) than their right neighbour.
The leftmost-smaller (LMS) substrings are put in order by two inductions and
named; if names repeat, the shorter string of names is sorted first,
recursively.  Two inductions from the sorted LMS suffixes then order all.

An induction goes through the buckets of first symbols.  What a bucket holds so
far induces its left neighbours at once, as arrays, and again as long as some
fall into the same bucket; few suffixes (a run of one symbol induces one at a
time) are taken one by one.  A string of names has about as many buckets as
suffixes, so beyond ``MANY_SYMBOLS`` all are taken one by one.  Either way an
induction is linear.
"""

from __future__ import annotations

from array import array

import numpy as np

#: Fewer suffixes than this are induced one by one, as arrays cost some microseconds each.
FEW = 64
#: With more buckets than this, all suffixes are.
MANY_SYMBOLS = 2048


def classify(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one to its right (the last is not: the end is smaller than any symbol)."""
    n = len(s)
    step = np.sign(np.diff(s.astype(np.int64), append=-1))
    known = np.where(step != 0, np.arange(n), n)
    following = np.minimum.accumulate(known[::-1])[::-1]
    return step[following] > 0


class _Buckets:
    """A suffix array under construction: L suffixes grow from a bucket's front, S suffixes from its end."""

    def __init__(self, s: np.ndarray, symbols: int, smaller: np.ndarray):
        self.s, self.smaller = s, smaller
        counts = np.bincount(s, minlength=symbols)
        self.end = np.cumsum(counts)
        self.start = self.end - counts
        self.used = np.flatnonzero(counts).tolist()
        self.sa = np.empty(len(s), np.int32)
        self.kind = np.uint16 if symbols <= 1 << 16 else np.int64

    def _deal(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Suffixes in the order of their first symbols, kept in order otherwise; (suffixes, symbols, rank in bucket, counts)."""
        symbols = self.s[own].astype(self.kind)
        order = np.argsort(symbols, kind="stable")
        symbols = symbols[order].astype(np.int64)
        counts = np.bincount(symbols, minlength=len(self.end))
        rank = np.arange(len(own)) - (np.cumsum(counts) - counts)[symbols]
        return own[order], symbols, rank, counts

    def induce(self, lms: np.ndarray) -> None:
        """From LMS suffixes in some order (stable within a bucket) to all suffixes."""
        if len(self.end) > MANY_SYMBOLS:
            return self._induce_singly(lms)
        few = FEW
        s, smaller, sa = memoryview(self.s), memoryview(self.smaller), memoryview(self.sa)
        starts, counts = (self._deal(lms)[k] for k in (0, 3)) if len(lms) else (lms, np.zeros(len(self.end), np.int64))
        ends = np.cumsum(counts)
        own_starts = memoryview(starts)
        head = self.start.copy()
        at = memoryview(head)

        def put_larger(own: np.ndarray) -> None:
            own = own[own >= 0]
            own = own[~self.smaller[own]]
            if len(own):
                own, symbols, rank, found = self._deal(own)
                self.sa[head[symbols] + rank] = own
                head[:] += found

        put_larger(np.array([len(self.s) - 1], np.int32))
        firsts, lasts = (ends - counts).tolist(), ends.tolist()
        fronts = self.start.tolist()
        for c in self.used:
            done = fronts[c]
            while done < at[c]:
                upto = at[c]
                if upto - done >= few:
                    put_larger(self.sa[done:upto] - 1)
                    done = upto
                    continue
                while done < upto:
                    i = sa[done] - 1
                    done += 1
                    if i >= 0 and not smaller[i]:
                        k = s[i]
                        sa[at[k]] = i
                        at[k] += 1
                    upto = at[c]
            if lasts[c] - firsts[c] >= few:
                put_larger(starts[firsts[c] : lasts[c]] - 1)
                continue
            for j in range(firsts[c], lasts[c]):  # the left neighbour of an LMS suffix is larger
                i = own_starts[j] - 1
                k = s[i]
                sa[at[k]] = i
                at[k] += 1
        tail = self.end.copy()
        to = memoryview(tail)

        def put_smaller(own: np.ndarray) -> None:
            own = own[own >= 0]
            own = own[self.smaller[own]]
            if len(own):
                own, symbols, rank, found = self._deal(own)
                self.sa[tail[symbols] - 1 - rank] = own
                tail[:] -= found

        backs = self.end.tolist()
        for c in reversed(self.used):
            done = backs[c]
            while done > to[c]:
                upto = to[c]
                if done - upto >= few:
                    put_smaller(self.sa[upto:done][::-1] - 1)
                    done = upto
                    continue
                while done > upto:
                    done -= 1
                    i = sa[done] - 1
                    if i >= 0 and smaller[i]:
                        k = s[i]
                        to[k] -= 1
                        sa[to[k]] = i
                    upto = to[c]
            if at[c] - fronts[c] >= few:
                put_smaller(self.sa[fronts[c] : at[c]][::-1] - 1)
                continue
            for j in range(at[c] - 1, fronts[c] - 1, -1):
                i = sa[j] - 1
                if i >= 0 and smaller[i]:
                    k = s[i]
                    to[k] -= 1
                    sa[to[k]] = i


    def _induce_singly(self, lms: np.ndarray) -> None:
        """The same, with one look at each suffix in order, in place of one at each bucket."""
        n = len(self.s)
        before = np.full(n + 1, -1, np.int32)  # the symbol before each suffix, if the suffix there is larger; -1 stands for no suffix
        before[1:n] = np.where(self.smaller[:-1], -1, self.s[:-1])
        self.sa.fill(-1)
        if len(lms):
            own, symbols, rank, counts = self._deal(lms)
            self.sa[(self.end - counts)[symbols] + rank] = own
        head, symbol = array("q", self.start.astype(np.int64).tobytes()), int(self.s[n - 1])
        sa, left = array("i", self.sa.tobytes()), array("i", before.tobytes())
        sa[head[symbol]] = n - 1
        head[symbol] += 1
        for i in sa:
            k = left[i]
            if k >= 0:
                h = head[k]
                sa[h] = i - 1
                head[k] = h + 1
        before[1:n] = np.where(self.smaller[:-1], self.s[:-1], -1)
        left, tail = array("i", before.tobytes()), array("q", self.end.astype(np.int64).tobytes())
        for i in reversed(sa):
            k = left[i]
            if k >= 0:
                h = tail[k] - 1
                tail[k] = h
                sa[h] = i - 1
        self.sa = np.frombuffer(sa, np.int32)


def _name(s: np.ndarray, order: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Names of sorted LMS substrings (``order``: their starts; ``stop``: for each start, the start of the next, that included)."""
    size = stop[order] - order + 1
    same = np.zeros(len(order), bool)
    same[1:] = size[1:] == size[:-1]
    same[1:] &= stop[order[1:]] < len(s)
    same[1:] &= stop[order[:-1]] < len(s)
    left = np.flatnonzero(same)
    at = 0
    while len(left) >= FEW:
        differ = s[order[left] + at] != s[order[left - 1] + at]
        same[left[differ]] = False
        left = left[~differ]
        at += 1
        left = left[size[left] > at]
    for k in left.tolist():  # the few long ones whole
        a, b = order[k], order[k - 1]
        same[k] = np.array_equal(s[a + at : a + size[k]], s[b + at : b + size[k]])
    return np.cumsum(~same) - 1


def suffix_array(s: np.ndarray, symbols: int) -> np.ndarray:
    """Starts of the suffixes of ``s`` (values from 0, under ``symbols``) in order; an end is smaller than any symbol."""
    n = len(s)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    s = np.ascontiguousarray(s)
    smaller = classify(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]).astype(np.int32) + np.int32(1)
    buckets = _Buckets(s, symbols, smaller)
    if len(lms) > 1:
        buckets.induce(lms)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        order = buckets.sa[is_lms[buckets.sa]]
        stop = np.full(n, n, np.int32)
        stop[lms[:-1]] = lms[1:]
        names = _name(s, order, stop)
        where = np.empty(n, np.int32)
        where[lms] = np.arange(len(lms), dtype=np.int32)
        if names[-1] + 1 == len(lms):
            lms = order
        else:
            text = np.empty(len(lms), np.int64)
            text[where[order]] = names
            lms = lms[suffix_array(text, int(names[-1]) + 1)]
    buckets.induce(lms)
    return buckets.sa


def permuted_lcp(text: np.ndarray, sa: np.ndarray, room: np.ndarray) -> np.ndarray:
    """For each place of ``text`` (bytes) the common prefix with the suffix before it in order, no longer than either's ``room``.

    Computed in the order of the text, eight bytes at a time, for all places at once.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    words = np.zeros(n + 8, np.uint64)
    for k in range(8):
        words |= padded[k : k + n + 8].astype(np.uint64) << np.uint64(8 * k)
    most = np.where(before >= 0, np.minimum(room, room[np.maximum(before, 0)]), 0).astype(np.int64)
    out = np.zeros(n, np.int64)
    left = np.flatnonzero(most > 0)
    at = 0
    while len(left):
        differ = words[left + at] ^ words[before[left] + at]
        equal = differ == 0
        if (~equal).any():
            low = differ[~equal] & (~differ[~equal] + np.uint64(1))  # the lowest bit that differs
            out[left[~equal]] = at + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
        left = left[equal]
        at += 8
        done = most[left] <= at
        out[left[done]] = most[left[done]]
        left = left[~done]
    return np.minimum(out, most)
