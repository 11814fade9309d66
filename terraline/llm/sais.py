"""Suffix arrays by induced sorting and permuted common prefixes, in numpy.

Suffixes are classified (S: smaller than the next, L: larger), the leftmost S of every run starts a substring, those
substrings are sorted by one round of induction and named, and the string of names is sorted recursively. From the order of
the leftmost-S suffixes all others are induced: a scan over the buckets in ascending order places the L suffixes, one in
descending order the S suffixes. A bucket is scanned in waves, each a handful of array operations, so the work is linear.
The names of a level are a string over a wide alphabet, where most buckets hold a few suffixes. There every suffix is ranked
by its symbols and types up to the next leftmost S, in rounds that double what is covered, and all that are still equal
follow the order of those leftmost-S suffixes, which the recursion gives.
"""

from __future__ import annotations

import numpy as np

#: Widest alphabet that is scanned bucket by bucket.
_BUCKETS = 256
#: Strings so short are sorted by doubling, the base case of the recursion.
_SHORT = 64


def classify(t: np.ndarray) -> np.ndarray:
    """True where the suffix is of type S; the end of the string is smaller than any symbol."""
    n = len(t)
    ends = np.flatnonzero(np.r_[t[1:] != t[:-1], True])
    rising = np.zeros(len(ends), bool)
    rising[:-1] = t[ends[:-1]] < t[ends[1:]]
    return np.repeat(rising, np.diff(ends, prepend=-1)) if n else np.zeros(0, bool)


def common_prefix(t: np.ndarray, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at i and j, at most `most` symbols (which must not pass the end)."""
    out = np.zeros(len(i), np.int64)
    live = np.flatnonzero(most > 0)
    wide = None
    if t.dtype == np.uint8 and len(t) >= 8:
        wide = np.ndarray((len(t) - 7,), "<u8", t.tobytes(), strides=(1,))
    while wide is not None and len(live):
        a, b = i[live] + out[live], j[live] + out[live]
        far = (np.maximum(a, b) < len(wide)) & (most[live] - out[live] >= 8)
        live, a, b = live[far], a[far], b[far]
        x = wide[a] ^ wide[b]
        out[live] += np.where(x == 0, 8, np.bitwise_count(~x & (x - np.uint64(1))).astype(np.int64) >> 3)
        live = live[x == 0]
    live = np.flatnonzero(out < most)
    live = live[t[i[live] + out[live]] == t[j[live] + out[live]]]
    while len(live):
        out[live] += 1
        live = live[out[live] < most[live]]
        live = live[t[i[live] + out[live]] == t[j[live] + out[live]]]
    return out


def doubling(t: np.ndarray) -> np.ndarray:
    """Suffix array by doubling ranks; only suffixes whose rank is still shared are sorted again."""
    n = len(t)
    order = np.argsort(t, kind="stable")
    symbols = t[order]
    at = np.arange(n)
    first = np.maximum.accumulate(np.where(np.r_[True, symbols[1:] != symbols[:-1]], at, 0)) if n else at
    rank = np.empty(n, np.int64)
    rank[order] = first
    live, step = order, 1
    shared = np.r_[first[1:] == first[:-1], False] | np.r_[False, first[1:] == first[:-1]] if n else np.zeros(0, bool)
    live = order[shared]
    while len(live):
        old = rank[live]
        ahead = live + step
        key = old * (n + 1)
        inside = ahead < n
        key[inside] += rank[ahead[inside]] + 1
        sort = np.argsort(key)
        live, key, old = live[sort], key[sort], old[sort]
        at = np.arange(len(live))
        group = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], at, 0))
        fine = np.r_[True, key[1:] != key[:-1]]
        new = old + np.maximum.accumulate(np.where(fine, at, 0)) - group
        order[old + at - group] = live
        rank[live] = new
        live = live[~(fine & np.r_[fine[1:], True])]
        step *= 2
    return order


def _spread(sa: np.ndarray, at: np.ndarray, chars: np.ndarray, values: np.ndarray, sigma: int, step: int) -> None:
    """Put values, in order, at the next free places of their symbols' buckets."""
    order = np.argsort(chars, kind="stable")
    chars, values = chars[order], values[order]
    counts = np.bincount(chars, minlength=sigma)
    nth = np.arange(len(chars)) - np.repeat(np.cumsum(counts) - counts, counts)
    sa[(at[chars] + nth) if step > 0 else (at[chars] - 1 - nth)] = values
    at += step * counts


def _induce(t: np.ndarray, small: np.ndarray, seeds: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All suffixes from the leftmost-S ones in the order given."""
    n, sigma = len(t), len(ends)
    starts = np.r_[0, ends[:-1]]
    sa = np.full(n, -1, np.int64)
    at = ends.copy()
    _spread(sa, at, t[seeds[::-1]], seeds[::-1], sigma, -1)
    first = at.copy()  # of the seeds in each bucket

    def push(block: np.ndarray, free: np.ndarray, want: bool, step: int) -> None:
        p = block[block > 0] - 1
        p = p[small[p] == want]
        if len(p):
            _spread(sa, free, t[p], p, sigma, step)

    head = starts.copy()
    sa[head[t[n - 1]]] = n - 1
    head[t[n - 1]] += 1
    for c in range(sigma):
        pos = starts[c]
        while pos < head[c]:
            block = sa[pos : head[c]]
            pos = head[c]
            push(block, head, False, 1)
        if first[c] < ends[c]:
            push(sa[first[c] : ends[c]], head, False, 1)
    tail = ends.copy()
    for c in range(sigma - 1, -1, -1):
        pos = ends[c]
        while pos > tail[c]:
            block = sa[tail[c] : pos][::-1]
            pos = tail[c]
            push(block, tail, True, -1)
        if starts[c] < head[c]:
            push(sa[starts[c] : head[c]][::-1], tail, True, -1)
    return sa


def _groups(key: np.ndarray) -> np.ndarray:
    """For sorted keys the place of the first equal one."""
    at = np.arange(len(key))
    return np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], at, 0)) if len(key) else at


def _shared(rank: np.ndarray) -> np.ndarray:
    """Where sorted ranks have an equal neighbour."""
    same = rank[1:] == rank[:-1]
    return np.r_[same, False] | np.r_[False, same] if len(rank) else same


def _wide(t: np.ndarray) -> np.ndarray:
    """Suffix array over a wide alphabet."""
    n = len(t)
    small = classify(t)
    left = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    stop = np.repeat(np.r_[left, n], np.diff(np.r_[0, left, n]))  # the next leftmost S behind each position
    key = t.astype(np.int64) * 2 + small
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = _groups(key[order])
    first = np.r_[rank, -1]  # by symbol and type alone; the end is the smallest
    jump, done = np.minimum(np.arange(1, n + 1), stop), n + 1
    live = order[_shared(rank[order])]
    while len(live):
        old, ahead = rank[live], jump[live]
        inside = ahead < stop[live]
        second = first[ahead]
        second[inside] = rank[ahead[inside]]
        further = np.full(len(live), done)
        further[inside] = jump[ahead[inside]]
        key = old * (n + 2) + second + 1
        sort = np.argsort(key, kind="stable")
        new = _groups(key[sort])
        start = _groups(old[sort])
        rank[live[sort]] = old[sort] + new - start
        order[old[sort] + np.arange(len(live)) - start] = live[sort]
        jump[live] = further
        live = live[sort][_shared(new)]
        live = live[jump[live] != done]
    by_rank = left[np.argsort(rank[left], kind="stable")]
    names = np.empty(n + 1, np.int64)
    names[by_rank] = np.cumsum(np.r_[0, rank[by_rank[1:]] != rank[by_rank[:-1]]]) if len(left) else 0
    if len(left) and names[by_rank[-1]] + 1 < len(left):
        names[left[suffix_array(names[left])]] = np.arange(len(left))
    names[n] = -1
    equal = order[_shared(rank[order])]
    if len(equal):
        place = np.flatnonzero(_shared(rank[order]))
        order[place] = equal[np.lexsort((names[stop[equal]], rank[equal]))]
    return order


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffix array of an array of symbols from 0; the end counts as smaller than every symbol."""
    n = len(t)
    if n < _SHORT:
        return doubling(t)
    sigma = int(t.max()) + 1
    if sigma > _BUCKETS:
        return _wide(t)
    t = t.astype(np.uint8, copy=False)
    ends = np.cumsum(np.bincount(t, minlength=sigma))
    small = classify(t)
    left = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if not len(left):
        return _induce(t, small, left, ends)
    sa = _induce(t, small, left, ends)
    mark = np.zeros(n, bool)
    mark[left] = True
    order = sa[mark[sa]]
    number = np.empty(n, np.int64)
    number[left] = np.arange(len(left))
    which = number[order]
    size = np.diff(left, append=n)[which] + 1  # up to and with the next one; the last runs into the end
    a, b = order[:-1], order[1:]
    size_a, size_b = size[:-1], size[1:]
    inside = (a + size_a <= n) & (b + size_b <= n)
    same = (size_a == size_b) & inside
    k = np.flatnonzero(same)
    same[k] = common_prefix(t, a[k], b[k], size_a[k]) >= size_a[k]
    names = np.empty(len(left), np.int64)
    names[which] = np.cumsum(np.r_[0, ~same])
    if names.max() + 1 < len(left):
        order = left[suffix_array(names)]
    return _induce(t, small, order, ends)


def permuted_lcp(t: np.ndarray, sa: np.ndarray, most: np.ndarray) -> np.ndarray:
    """For every text position the common prefix with its predecessor in the suffix array, at most `most` there and at the
    predecessor. Only irreducible positions (whose preceding symbols differ) are compared; from one to the next the value
    falls by one with each step. `most` must fall by one at a step at most, as the distance to a boundary does."""
    n = len(t)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    has = phi >= 0
    reducible = np.zeros(n, bool)
    i = np.flatnonzero((phi[:-1] == phi[1:] - 1) & (phi[1:] > 0)) + 1
    reducible[i] = t[i - 1] == t[phi[i] - 1]
    k = np.flatnonzero(has & ~reducible)
    limit = np.minimum(n - k, n - phi[k])
    raw = np.zeros(n, np.int64)
    cap = np.minimum(limit, most[k] + n)  # reducible runs need the whole value; callers bound it by `most` afterwards
    cap = np.minimum(cap, int(most.max()) + _run_lengths(reducible)[k])
    raw[k] = common_prefix(t, k, phi[k], cap)
    base = np.maximum.accumulate(np.where(reducible, -1, np.arange(n)))
    out = np.maximum(raw[base] - (np.arange(n) - base), 0)
    out[~has] = 0
    out = np.minimum(out, most)
    out[has] = np.minimum(out[has], most[phi[has]])
    return out


def _run_lengths(reducible: np.ndarray) -> np.ndarray:
    """How many reducible positions follow each position without a break."""
    n = len(reducible)
    stops = np.flatnonzero(~reducible)
    after = np.r_[stops[1:], n]
    out = np.zeros(n, np.int64)
    out[stops] = after - stops
    return out
