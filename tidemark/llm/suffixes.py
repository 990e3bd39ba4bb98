"""Suffix arrays by induced sorting, in numpy.

Suffixes are classified by whether they are smaller or larger than their right neighbour.
Leftmost-smaller (LMS) substrings are sorted by one round of induction, named, and the
string of names is sorted recursively; a second round induces all suffixes from the sorted
LMS ones. Induction walks the first symbols in order and moves whole buckets at a time: the
suffixes one to the left of a bucket's go, in the same order, to the buckets of their own
first symbols. Strings of names with too many different symbols for that are sorted by
doubling prefixes instead.

Common prefixes are computed in text order (permuted): where the symbols to the left agree,
a suffix shares one symbol less with its predecessor than its left neighbour did, so only
the other positions are compared.
"""

from __future__ import annotations

import numpy as np

# More symbols than this and walking the buckets costs more than doubling.
MOST_SYMBOLS = 2_048


def _smaller(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its right neighbour; the last one counts as so."""
    n = len(s)
    differs = np.append(s[:-1] != s[1:], True)
    place = np.where(differs, np.arange(n), n)
    after = np.minimum.accumulate(place[::-1])[::-1]
    out = np.empty(n, bool)
    out[-1] = True
    at = after[:-1]
    inner = at < n - 1
    out[:-1] = True
    out[:-1][inner] = s[at[inner]] < s[at[inner] + 1]
    return out


def _place(queue: np.ndarray, fill: np.ndarray, moved: np.ndarray, symbol: np.ndarray) -> None:
    """Appends positions to the queues of their symbols, in order."""
    order = np.argsort(symbol, kind="stable")
    symbol = symbol[order]
    first = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1]))
    sizes = np.diff(np.append(first, len(symbol)))
    which = symbol[first]
    base = fill[which] - first
    queue[np.arange(len(symbol)) + np.repeat(base, sizes)] = moved[order]
    fill[which] += sizes


def _induce(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The suffix array induced from LMS positions in the order given."""
    n, symbols = len(s), int(s.max()) + 1
    large = np.bincount(s[~smaller], minlength=symbols)
    small = np.bincount(s[smaller], minlength=symbols)
    large_at, small_at = np.cumsum(large) - large, np.cumsum(small) - small
    larges, smalls = np.empty(large.sum(), np.int64), np.empty(small.sum(), np.int64)
    present = np.flatnonzero(large + small)

    by_symbol = lms[np.argsort(s[lms], kind="stable")]
    lms_count = np.bincount(s[lms], minlength=symbols)
    lms_at = np.cumsum(lms_count) - lms_count

    fill = large_at.copy()

    def send_large(x: np.ndarray) -> None:
        x = x[x > 0] - 1
        x = x[~smaller[x]]
        if len(x):
            _place(larges, fill, x, s[x])

    for c in present:
        read = large_at[c]
        while read < fill[c]:
            upto = fill[c]
            send_large(larges[read:upto])
            read = upto
        if lms_count[c]:
            send_large(by_symbol[lms_at[c]:lms_at[c] + lms_count[c]])

    fill = small_at.copy()  # each queue runs from the largest suffix down

    def send_small(x: np.ndarray) -> None:
        x = x[x > 0] - 1
        x = x[smaller[x]]
        if len(x):
            _place(smalls, fill, x, s[x])

    for c in present[::-1]:
        if c == 0:
            smalls[small_at[0]] = n - 1  # the end mark is the only 0
            fill[0] += 1
        read = small_at[c]
        while read < fill[c]:
            upto = fill[c]
            send_small(smalls[read:upto])
            read = upto
        if large[c]:
            send_small(larges[large_at[c]:large_at[c] + large[c]][::-1])

    out = np.empty(n, np.int64)
    ends = np.cumsum(large + small)
    starts = ends - large - small
    out[np.arange(len(larges)) + np.repeat(starts - large_at, large)] = larges
    # small ones follow the large ones of their symbol, smallest first
    back = np.repeat(ends - 1 + small_at, small) - np.arange(len(smalls))
    out[back] = smalls
    return out


def _doubled(s: np.ndarray) -> np.ndarray:
    """Suffix array by doubling prefixes."""
    n = len(s)
    _, rank = np.unique(s, return_inverse=True)
    step = 1
    while True:
        second = np.zeros(n, np.int64)
        second[:-step or None] = rank[step:] + 1 if step < n else 0
        key = rank.astype(np.int64) * (n + 1) + second
        order = np.argsort(key, kind="stable")
        changed = np.append(0, np.cumsum(key[order][1:] != key[order][:-1]))
        rank = np.empty(n, np.int64)
        rank[order] = changed
        if changed[-1] == n - 1:
            return order
        step *= 2


def _names(s: np.ndarray, smaller: np.ndarray, ordered: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Names of LMS substrings in sorted order; ``ends[i]`` is the last place of the one at
    ``ordered[i]``."""
    sizes = ends - ordered + 1
    new = np.ones(len(ordered), bool)
    check = np.flatnonzero(sizes[1:] == sizes[:-1]) + 1
    if len(check):
        size = sizes[check]
        first = np.cumsum(size) - size
        inside = np.arange(int(size.sum())) - np.repeat(first, size)
        x = np.repeat(ordered[check], size) + inside
        y = np.repeat(ordered[check - 1], size) + inside
        same = (s[x] == s[y]) & (smaller[x] == smaller[y])
        new[check] = ~np.logical_and.reduceat(same, first)
    return np.cumsum(new) - 1


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``s``, whose last symbol is its only 0."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    if int(s.max()) >= MOST_SYMBOLS:
        return _doubled(s)
    smaller = _smaller(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if not len(lms):
        return _induce(s, smaller, np.array([n - 1]))
    rough = _induce(s, smaller, lms)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = rough[is_lms[rough]]
    end_of = np.full(n, n - 1)
    end_of[lms[:-1]] = lms[1:]
    name = _names(s, smaller, ordered, end_of[ordered])
    if name[-1] + 1 < len(lms):
        named = np.empty(n, np.int64)
        named[ordered] = name
        ordered = lms[suffix_array(named[lms])]
    return _induce(s, smaller, ordered)


def common_prefixes(s: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every suffix, in text order: how many symbols it shares with its predecessor in
    ``order``, and the suffix that follows it there (itself if none does)."""
    n = len(s)
    before, after = np.full(n, -1), np.arange(n)
    before[order[1:]] = order[:-1]
    after[order[:-1]] = order[1:]
    shared = np.zeros(n, np.int64)
    place = np.arange(n)
    chained = np.zeros(n, bool)
    inner = (place > 0) & (before > 0)
    chained[inner] = s[place[inner] - 1] == s[before[inner] - 1]
    todo = np.flatnonzero(~chained & (before >= 0))
    length = np.zeros(len(todo), np.int64)
    live = np.arange(len(todo))
    while len(live):
        x, y = todo[live] + length[live], before[todo[live]] + length[live]
        same = s[x] == s[y]  # the end mark differs from all else and stops every run
        live = live[same]
        length[live] += 1
    shared[todo] = length
    # a chained place has one symbol less than its left neighbour
    anchor = np.maximum.accumulate(np.where(chained, 0, place))
    shared = np.where(chained, np.maximum(shared[anchor] - (place - anchor), 0), shared)
    return shared, after


def repeated(segments: list[bytes], width: int) -> list[np.ndarray]:
    """For every segment, a flag per place where a string of ``width`` bytes begins: does
    that string begin anywhere else, in this or another segment?"""
    sizes = np.array([len(x) for x in segments])
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    line = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8).astype(np.int64) + 2
    line[ends - 1] = 1  # between segments
    line = np.append(line, 0)
    shared, after = common_prefixes(line, suffix_array(line))
    # the string at a place ends inside its segment, so what equals it does too
    again = (shared >= width) | (np.where(after != np.arange(len(line)), shared[after], 0) >= width)
    return [again[a:a + max(0, size - width + 1)] for a, size in zip(starts, sizes)]
