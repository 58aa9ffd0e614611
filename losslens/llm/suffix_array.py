"""Suffix arrays by induced sorting and permuted common prefixes, in numpy.

Positions are classified as S (smaller than their successor) or L; the
leftmost S positions (LMS) are put into their buckets, and all other suffixes
are induced from them: one pass over the buckets upwards appends L-type
predecessors, one downwards appends S-type predecessors.  Both passes work
on waves: all suffixes of a bucket whose predecessors are due are moved at
once, and predecessors with the same symbol form the next wave, so the
number of array operations depends on the alphabet and on runs of one symbol,
not on the text.  Run with unsorted LMS positions this sorts the
LMS substrings; their names form a text of at most half the length, which is
sorted recursively while its alphabet is small, and by prefix doubling after
that; a last pass induces the whole array.
"""

from __future__ import annotations

import numpy as np

#: the waves visit every symbol; texts with more symbols are doubled
ALPHABET = 2048


def _classify(t: np.ndarray) -> np.ndarray:
    """True for S-type positions; the last symbol is a unique smallest one."""
    n = len(t)
    up = np.empty(n, bool)
    up[-1] = True
    up[:-1] = t[:-1] < t[1:]
    differs = np.empty(n, bool)
    differs[-1] = True
    differs[:-1] = t[:-1] != t[1:]
    # a run of equal symbols has the type of its last position
    at = np.where(differs, np.arange(n), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    return up[at]


class _Buckets:
    def __init__(self, symbols: int):
        self.parts: list[list[np.ndarray]] = [[] for _ in range(symbols)]

    def put(self, t: np.ndarray, at: np.ndarray) -> None:
        """Appends positions to the buckets of their symbols, in order."""
        if not len(at):
            return
        symbol = t[at].astype(np.uint16)  # 16 bits sort by radix
        order = np.argsort(symbol, kind="stable")
        at, symbol = at[order], symbol[order]
        ends = np.flatnonzero(np.diff(symbol)) + 1
        for s, part in zip(symbol[np.concatenate(([0], ends))].tolist(), np.split(at, ends)):
            self.parts[s].append(part)

    def take(self, s: int) -> np.ndarray:
        parts = self.parts[s]
        return np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else np.zeros(0, np.int32)


def _waves(t, wave, symbol, wanted, out: _Buckets) -> np.ndarray:
    """The whole bucket grown from its first wave; other predecessors go to out."""
    waves = []
    while len(wave):
        waves.append(wave)
        before = wave[wave > 0] - 1
        before = before[wanted[before]]
        same = t[before] == symbol
        out.put(t, before[~same])
        wave = before[same]
    return np.concatenate(waves) if waves else np.zeros(0, np.int32)


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes, from the LMS positions in the given order."""
    symbols = int(t.max()) + 1
    starts, large, rising = _Buckets(symbols), _Buckets(symbols), _Buckets(symbols)
    starts.put(t, lms)
    is_large = ~small
    lows = []
    for s in range(symbols):
        lows.append(_waves(t, large.take(s), s, is_large, large))
        first = starts.take(s)
        before = first[first > 0] - 1
        large.put(t, before[is_large[before]])
    highs = [np.zeros(0, np.int32)] * symbols
    for s in range(symbols - 1, -1, -1):
        highs[s] = _waves(t, rising.take(s), s, small, rising)
        down = lows[s][::-1]
        before = down[down > 0] - 1
        rising.put(t, before[small[before]])
    highs[0] = np.array([len(t) - 1], np.int32)
    return np.concatenate([x for s in range(symbols) for x in (lows[s], highs[s][::-1])])


def _names(t: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Rank of the LMS substring at each LMS position, in text order."""
    size = np.empty(len(t), np.int64)
    size[lms] = np.append(np.diff(lms), 1) + 1
    size[lms[-1]] = 1
    a, b = order[:-1], order[1:]
    same = size[a] == size[b]
    todo = np.flatnonzero(same)
    d = 0
    while len(todo):
        todo = todo[size[a[todo]] > d]
        differ = t[a[todo] + d] != t[b[todo] + d]
        same[todo[differ]] = False
        todo = todo[~differ]
        d += 1
    rank = np.empty(len(t), np.int32)
    rank[order] = np.concatenate(([0], np.cumsum(~same)))
    return rank[lms]


def _doubled(t: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; suffixes that are alone in their rank
    are not sorted again."""
    n = len(t)
    order = np.argsort(t, kind="stable")
    key = t[order]
    # the rank of a group is the place of its first member
    head = np.concatenate(([True], key[1:] != key[:-1]))
    rank, k = np.empty(n, np.int64), 1
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    while True:
        alone = head & np.append(head[1:], True)
        place = np.flatnonzero(~alone)
        if not len(place):
            return order.astype(np.int32)
        todo = order[place]
        after = todo + k
        key = rank[todo] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.argsort(key)
        todo, key = todo[by], key[by]
        order[place] = todo
        differs = np.concatenate(([True], key[1:] != key[:-1]))
        head[place] = differs
        rank[todo] = np.maximum.accumulate(np.where(differs, place, 0))
        k *= 2


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffix array of symbols whose last one is 0 and occurs only there."""
    if len(t) <= 2:
        return np.arange(len(t), dtype=np.int32)[::-1].copy()
    small = _classify(t)
    first = np.zeros(len(t), bool)
    first[1:] = small[1:] & ~small[:-1]
    lms = np.flatnonzero(first).astype(np.int32)
    rough = _induce(t, small, lms)
    names = _names(t, lms, rough[first[rough]])
    top = int(names.max())
    if top == len(lms) - 1:
        order = np.empty(len(lms), np.int32)
        order[names] = np.arange(len(lms), dtype=np.int32)
    else:
        order = suffix_array(names) if top < ALPHABET else _doubled(names)
    return _induce(t, small, lms[order])


def permuted_lcp(t: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(previous, common): for each position, the position before it in the
    suffix array (-1 for the first) and their common prefix.

    Where a position and its predecessor in the array both follow such a pair
    with the same symbol, the common prefix is one less than that pair's;
    only the other positions are compared, in lockstep.
    """
    n, width = len(t), 16
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    fresh = np.ones(n, bool)
    fresh[1:] = (before[1:] != before[:-1] + 1) | (t[:-1] != t[before[:-1]])
    heads = np.flatnonzero(fresh)
    common = np.zeros(len(heads), np.int64)
    padded = np.concatenate([t, np.full(width, -1, t.dtype)])
    span = np.arange(width)
    todo = np.flatnonzero(before[heads] >= 0)
    while len(todo):
        nxt = []
        for k in range(0, len(todo), 1 << 16):
            part = todo[k:k + (1 << 16)]
            a, b = heads[part] + common[part], before[heads[part]] + common[part]
            differ = padded[a[:, None] + span] != padded[b[:, None] + span]
            some = differ.any(1)
            common[part] += np.where(some, differ.argmax(1), width)
            nxt.append(part[~some])
        todo = np.concatenate(nxt)
    run = np.cumsum(fresh) - 1
    return before, common[run] - (np.arange(n) - heads[run])
