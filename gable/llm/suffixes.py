"""Suffix arrays of byte records by induced sorting, and their permuted common prefixes, with numpy.

Suffixes are classified into those smaller (S) and larger (L) than the next one. The substrings between leftmost S
suffixes are sorted by inducing, named, and, while names repeat, ordered by recursion on the string of names; the whole
array is then induced from the order of the leftmost S suffixes in one pass of each kind. An inducing pass goes through
the buckets of first bytes; what stands in a bucket is handled as one numpy step, what it adds to the same bucket as the
next step, so a pass takes about as many steps as there are buckets and as repeats of one byte in a row. Strings of names
with more than LARGE_ALPHABET names are ordered by doubling ranks instead, as they would have a bucket per name.
"""

from __future__ import annotations

import numpy as np

LARGE_ALPHABET = 2048


def _types(t: np.ndarray) -> np.ndarray:
    """True for S suffixes. The last one, the sentinel, is S."""
    n = len(t)
    differs = np.append(t[:-1] != t[1:], True)
    at = np.where(differs, np.arange(n, dtype=np.int32), np.int32(n))
    del differs
    following = np.minimum.accumulate(at[::-1])[::-1]
    s = np.ones(n, bool)
    s[:-1] = t[following[:-1]] < t[np.minimum(following[:-1] + 1, n - 1)]
    s[following == n - 1] = True
    return s


def _put(sa: np.ndarray, at: np.ndarray, edge: np.ndarray, chars: np.ndarray, step: int) -> None:
    """Append suffixes to the buckets of their first characters, in order; edges move by step (1 up, -1 down)."""
    order = np.argsort(chars, kind="stable")
    c = chars[order]
    first = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
    counts = np.diff(np.append(first, len(c)))
    rank = np.arange(len(c)) - np.repeat(first, counts)
    sa[edge[c] + step * rank] = at[order]
    edge[c[first]] += step * counts


def _induce(t: np.ndarray, s: np.ndarray, sizes: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The suffix array that follows from leftmost S suffixes in the given order."""
    n = len(t)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    # Positions take 32 bits: shards are far below 2**31 bytes.
    sa = np.full(n, -1, np.int32)
    order = np.argsort(t[lms], kind="stable")
    sorted_lms = lms[order]
    bounds = np.concatenate(([0], np.cumsum(np.bincount(t[lms], minlength=len(sizes)))))
    used = np.flatnonzero(sizes)
    head = starts.copy()
    for c in used:
        done = starts[c]
        while done < head[c]:
            part, done = sa[done : head[c]], head[c]
            before = part[part > 0] - 1
            before = before[~s[before]]
            if len(before):
                _put(sa, before, head, t[before], 1)
        part = sorted_lms[bounds[c] : bounds[c + 1]]
        if len(part):
            before = part[part > 0] - 1
            before = before[~s[before]]
            if len(before):
                _put(sa, before, head, t[before], 1)
    tail = ends - 1
    sa[0] = n - 1
    for c in used[::-1]:
        if c == 0 and sizes[0] == 1:
            break
        low, done = head[c], ends[c] - 1
        while done > tail[c] and done >= low:
            part, done = sa[tail[c] + 1 : done + 1][::-1], tail[c]
            _before(sa, part, s, t, tail)
        _before(sa, sa[starts[c] : head[c]][::-1], s, t, tail)
    return sa


def _before(sa: np.ndarray, part: np.ndarray, s: np.ndarray, t: np.ndarray, tail: np.ndarray) -> None:
    before = part[part > 0] - 1
    before = before[s[before]]
    if len(before):
        _put(sa, before, tail, t[before], -1)


def _doubled(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names by doubling ranks."""
    n, rank, k = len(names), np.unique(names, return_inverse=True)[1].astype(np.int64), 1
    while True:
        second = np.zeros(n, np.int64)
        second[: max(0, n - k)] = rank[k:] + 1
        keys = rank * (n + 2) + second
        order = np.argsort(keys, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.concatenate(([0], keys[order][1:] != keys[order][:-1])))
        rank, k = new, 2 * k
        if rank.max(initial=0) == n - 1 or k > 2 * n:
            return order


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Positions of all suffixes of t in ascending order. t ends with its only 0."""
    n = len(t)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    t = t.astype(np.int32, copy=False)
    s = _types(t)
    sizes = np.bincount(t)
    lms = (np.flatnonzero(s[1:] & ~s[:-1]) + 1).astype(np.int32)
    sa = _induce(t, s, sizes, lms)
    if len(lms) < 2:
        return sa
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = sa[is_lms[sa]]
    after = np.full(n, n - 1, np.int32)
    after[lms[:-1]] = lms[1:]
    length = after[order] - order + 1
    same = length[1:] == length[:-1]
    left, k = np.flatnonzero(same), 0
    while len(left):
        a, b = order[left] + k, order[left + 1] + k
        differ = t[a] != t[b]
        same[left[differ]] = False
        k += 1
        left = left[~differ & (length[left] > k)]
    names = np.concatenate(([0], np.cumsum(~same)))
    if names[-1] + 1 < len(lms):
        place = np.empty(n, np.int32)
        place[order] = names
        reduced = place[lms]
        del place, same, length, is_lms
        # The sentinel is the last and the smallest name.
        again = suffix_array(reduced) if names[-1] < LARGE_ALPHABET else _doubled(reduced)
        order = lms[again]
    return _induce(t, s, sizes, order)


def common_prefixes(t: np.ndarray, sa: np.ndarray, begins: np.ndarray, longest: int) -> np.ndarray:
    """Permuted common prefixes: for each position, with the suffix before it in the array, cut at longest.

    A position whose predecessor has the same byte before it follows from the position to its left; all others, and the
    starts of records, are compared byte by byte, in steps over all of them at once.
    """
    n = len(t)
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    starts = np.zeros(n, bool)
    starts[begins] = True
    at = np.arange(n, dtype=np.int32)
    own = starts | (before <= 0) | (at == 0) | (t[at - 1] != t[before - 1])
    out = np.zeros(n, np.int32)
    left = np.flatnonzero(own & (before >= 0))
    k = 0
    while len(left) and k < longest:
        good = (left + k < n) & (before[left] + k < n)
        left = left[good]
        left = left[t[left + k] == t[before[left] + k]]
        k += 1
        out[left] = k
    anchor = np.maximum.accumulate(np.where(own, at, np.int32(0)))
    return np.where(own, out, np.maximum(out[anchor] - (at - anchor), 0))


def repeated_windows(records: list[bytes], width: int) -> list[np.ndarray]:
    """For each record, which of its windows of width bytes occur more than once among all records."""
    joined = np.frombuffer(b"".join(r + b"\x00" for r in records), np.uint8)
    lengths = np.fromiter(map(len, records), np.int64, len(records))
    ends = np.cumsum(lengths + 1) - 1
    begins = ends - lengths
    # Bytes from 2, ends of records 1, the sentinel 0; equal windows never reach an end.
    t = joined.astype(np.int32) + 2
    t[ends] = 1
    t = np.append(t, np.int32(0))
    sa = suffix_array(t)
    prefixes = common_prefixes(t, sa, begins, 2 * width + int(lengths.max(initial=0)))
    hit = prefixes >= width
    before = np.full(len(t), -1, np.int32)
    before[sa[1:]] = sa[:-1]
    again = np.zeros(len(t), bool)
    again[hit] = True
    again[before[hit]] = True
    return [again[b : max(b, e - width + 1)] for b, e in zip(begins, ends)]
