"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Suffixes are classified as S (smaller than the next) or L; leftmost S ones (LMS)
are sorted by induction, named, sorted as a shorter string recursively, and the
whole array is induced from them in linear time. Over a byte alphabet induction
goes bucket by bucket: all members of a bucket put their predecessors in one
array operation. The shorter strings of the recursion have an alphabet as long
as themselves, so there the plain linear loop runs.
"""

from __future__ import annotations

import numpy as np

SMALL = 1024
_BASE = np.uint64(0xD6E8FEB86659FD93)


def _s_types(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; ties look on to the next change."""
    n = len(t)
    change = np.flatnonzero(t[:-1] != t[1:])
    out = np.ones(n, bool)
    at = np.searchsorted(change, np.arange(n - 1))
    inside = at < len(change)
    nxt = change[np.minimum(at, len(change) - 1)] if len(change) else np.zeros(n - 1, np.int64)
    out[:-1] = np.where(inside, t[nxt] < t[np.minimum(nxt + 1, n - 1)], False)
    return out


def _put(t, sa, p, fill, step):
    """Place suffixes ``p`` in turn at the free ends ``fill`` of their buckets."""
    ch = t[p]
    order = np.argsort(ch, kind="stable")
    p, ch = p[order], ch[order]
    first = np.flatnonzero(np.concatenate([[True], ch[1:] != ch[:-1]]))
    count = np.diff(np.append(first, len(ch)))
    rank = np.arange(len(ch)) - np.repeat(first, count)
    if step > 0:
        sa[fill[ch] + rank] = p
        fill[ch[first]] += count
    else:
        sa[fill[ch] - 1 - rank] = p
        fill[ch[first]] -= count


def _induce(t, s, k, lms):
    """Suffix array induced from ``lms`` in their given order; buckets one after the other."""
    n = len(t)
    sizes = np.bincount(t, minlength=k)
    ends = np.cumsum(sizes)
    heads = ends - sizes
    larger = np.bincount(t[~s], minlength=k)
    sa = np.full(n, -1, np.int64)
    order = np.argsort(t[lms], kind="stable")
    seeds, seed_count = lms[order], np.bincount(t[lms], minlength=k)
    seed_at = np.concatenate([[0], np.cumsum(seed_count)])
    used = np.flatnonzero(sizes)
    fill = heads.copy()
    for c in used.tolist():
        done = heads[c]
        while done < fill[c]:
            p = sa[done:fill[c]] - 1
            done = fill[c]
            p = p[p >= 0]
            p = p[~s[p]]
            if len(p):
                _put(t, sa, p, fill, 1)
        p = seeds[seed_at[c]:seed_at[c + 1]] - 1
        p = p[p >= 0]
        if len(p):
            _put(t, sa, p, fill, 1)
    fill = ends.copy()
    for c in used[::-1].tolist():
        done = ends[c]
        while done > fill[c]:
            p = sa[fill[c]:done][::-1] - 1
            done = fill[c]
            p = p[p >= 0]
            p = p[s[p]]
            if len(p):
                _put(t, sa, p, fill, -1)
        p = sa[heads[c]:heads[c] + larger[c]][::-1] - 1
        p = p[p >= 0]
        p = p[s[p]]
        if len(p):
            _put(t, sa, p, fill, -1)
    sa[0] = n - 1
    return sa


def _induce_plain(t, s, k, lms):
    """The same for a wide alphabet: one pass each way over the array."""
    sizes = np.bincount(t, minlength=k)
    ends = np.cumsum(sizes)
    heads, tails = (ends - sizes).tolist(), ends.tolist()
    t, s, sa = t.tolist(), s.tolist(), [-1] * len(t)
    for j in reversed(lms.tolist()):
        tails[t[j]] -= 1
        sa[tails[t[j]]] = j
    for j in sa:  # (sees what the loop itself writes ahead)
        if j > 0 and not s[j - 1]:
            c = t[j - 1]
            sa[heads[c]] = j - 1
            heads[c] += 1
    tails = ends.tolist()
    for i in range(len(sa) - 1, -1, -1):
        j = sa[i]
        if j > 0 and s[j - 1]:
            c = t[j - 1]
            tails[c] -= 1
            sa[tails[c]] = j - 1
    out = np.array(sa, np.int64)
    out[0] = len(t) - 1
    return out


def _sort(t: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of ``t``, whose last item is its only 0."""
    n = len(t)
    if n < 3:
        return np.arange(n)[::-1].copy()
    s = _s_types(t)
    lms_at = np.zeros(n, bool)
    lms_at[1:] = s[1:] & ~s[:-1]
    lms = np.flatnonzero(lms_at)
    induce = _induce if k <= SMALL else _induce_plain
    sa = induce(t, s, k, lms)
    ordered = sa[lms_at[sa]]
    # Name the sorted LMS substrings (each up to and with the next LMS place) by length and hash.
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE, np.uint64)]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((t.astype(np.uint64) + np.uint64(1)) * power[:n])])
    end = np.full(n, n, np.int64)
    end[lms[:-1]] = lms[1:] + 1
    a, z = ordered[:-1], ordered[1:]
    # equal where (sum a) * base^(z - a) == (sum z), with no inverse needed
    ha, hz = sums[end[a]] - sums[a], sums[end[z]] - sums[z]
    low, high = np.minimum(a, z), np.maximum(a, z)
    shift = power[high - low]
    same = (end[a] - a == end[z] - z) & np.where(a < z, ha * shift == hz, hz * shift == ha)
    names = np.concatenate([[0], np.cumsum(~same)])
    if names[-1] + 1 < len(lms):
        of = np.empty(n, np.int64)
        of[ordered] = names
        ordered = lms[_sort(of[lms], int(names[-1]) + 1)]
    return induce(t, s, k, ordered)


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Suffix array of bytes."""
    t = np.concatenate([data.astype(np.int64) + 1, [0]])
    return _sort(t, 257)[1:]


def permuted_prefixes(data: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(PLCP, predecessor): for every position, the suffix just before it in order and their common prefix.

    Only where the bytes before the two differ is the prefix compared, eight bytes
    at a time; everywhere else it is that of the position before, less one.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    i = np.arange(n)
    anew = (before < 0) | (i == 0) | (before == 0)
    inner = ~anew
    anew[inner] = data[i[inner] - 1] != data[before[inner] - 1]
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (n + 8, 8), (1, 1))
    length = np.zeros(n, np.int64)
    live = np.flatnonzero(anew & (before >= 0))
    while len(live):
        x, y = live + length[live], before[live] + length[live]
        room = n - np.maximum(x, y)
        differ = words[np.minimum(x, n)] != words[np.minimum(y, n)]
        run = np.where(differ.any(1), differ.argmax(1), 8)
        length[live] += np.minimum(run, np.maximum(room, 0))
        live = live[(run == 8) & (room > 8)]
    last = np.maximum.accumulate(np.where(anew, i, 0))
    plcp = length[last] - (i - last)
    return np.maximum(plcp, 0), before


def repeated(data: np.ndarray, size: int) -> np.ndarray:
    """Whether the ``size`` bytes from each position also start elsewhere."""
    out = np.zeros(len(data), bool)
    if len(data):
        plcp, before = permuted_prefixes(data, suffix_array(data))
        hit = plcp >= size
        out[hit] = True
        out[before[hit]] = True
    return out
