"""Suffix arrays by induced sorting, with bucket-wise numpy steps, and permuted
longest common prefixes.  Works on one shard of text inside a task."""

from __future__ import annotations

import numpy as np

#: Above this alphabet a step per bucket costs more than it sorts.
_SMALL_ALPHABET = 2048


def _smaller_than_next(t: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one that starts a place later (S); the last one is."""
    runs = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
    rises = np.r_[t[runs[1:]] > t[runs[:-1]], True]
    return np.repeat(rises, np.diff(np.r_[runs, len(t)]))


def _induce(t: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, alphabet: int) -> np.ndarray:
    """All suffixes in order, from the leftmost-smaller ones in order.

    Left to right, bucket by bucket, each placed suffix places its larger
    predecessor at the head of that one's bucket; then right to left each
    places its smaller predecessor at the tail.  The members of a bucket that are
    known go in one step; what they add to the same bucket goes in the next.
    """
    counts = np.bincount(t, minlength=alphabet)
    ends = np.cumsum(counts)
    starts = ends - counts
    sa = np.full(len(t), -1, np.int64)
    used = np.flatnonzero(counts)

    head = starts.copy()
    larger = ~smaller

    def to_heads(known: np.ndarray) -> None:
        before = known[known > 0] - 1
        before = before[larger[before]]
        if len(before):
            symbol = t[before]
            order = np.argsort(symbol, kind="stable")
            symbol = symbol[order]
            added = np.bincount(symbol, minlength=alphabet)
            place = head[symbol] + np.arange(len(symbol)) - (np.cumsum(added) - added)[symbol]
            sa[place] = before[order]
            np.add(head, added, out=head)

    seeds_until = np.searchsorted(t[seeds], np.arange(alphabet + 1))
    for c in used:
        done = starts[c]
        while done < head[c]:
            known, done = sa[done : head[c]].copy(), head[c]
            to_heads(known)
        to_heads(seeds[seeds_until[c] : seeds_until[c + 1]])

    tail = ends.copy()
    last = len(t) - 1
    tail[t[last]] -= 1
    sa[tail[t[last]]] = last

    def to_tails(known: np.ndarray) -> None:
        before = known[known > 0] - 1
        before = before[smaller[before]]
        if len(before):
            symbol = t[before]
            order = np.argsort(symbol, kind="stable")
            symbol = symbol[order]
            added = np.bincount(symbol, minlength=alphabet)
            place = tail[symbol] - 1 - (np.arange(len(symbol)) - (np.cumsum(added) - added)[symbol])
            sa[place] = before[order]
            np.subtract(tail, added, out=tail)

    for c in used[::-1]:
        done = ends[c]
        while tail[c] < done:
            known, done = sa[tail[c] : done][::-1].copy(), tail[c]
            to_tails(known)
        to_tails(sa[starts[c] : head[c]][::-1])
    return sa


def _names(t: np.ndarray, lms: np.ndarray, in_order: np.ndarray) -> np.ndarray:
    """Ranks of the leftmost-smaller substrings ``in_order``, equal ones alike."""
    next_of = np.zeros(len(t), np.int64)
    next_of[lms[:-1]] = lms[1:]
    next_of[lms[-1]] = lms[-1]
    x, y = in_order[:-1], in_order[1:]
    size = next_of[x] - x
    same = size == next_of[y] - y
    left = np.flatnonzero(same)
    k = 0
    while len(left):
        differ = t[x[left] + k] != t[y[left] + k]
        same[left[differ]] = False
        left = left[~differ & (size[left] > k)]
        k += 1
    return np.r_[0, np.cumsum(~same)]


def _by_doubling(t: np.ndarray) -> np.ndarray:
    """Suffix array of a short string over a large alphabet, by doubling compared lengths."""
    n = len(t)
    rank, k = t.astype(np.int64), 1
    while True:
        follow = np.zeros(n, np.int64)
        follow[: n - k] = rank[k:] + 1
        key = rank * (n + 2) + follow
        order = np.argsort(key, kind="stable")
        rising = np.r_[0, np.cumsum(key[order][1:] != key[order][:-1])]
        rank = np.empty(n, np.int64)
        rank[order] = rising
        if rising[-1] == n - 1:
            return order
        k *= 2


def suffix_array(t: np.ndarray, alphabet: int) -> np.ndarray:
    """The starts of the suffixes of ``t`` in order.  ``t`` holds values below ``alphabet``
    and ends with the only 0.

    Suffixes are classified; the leftmost-smaller substrings are sorted by one
    induction, named, and the string of their names is sorted recursively (over
    a small alphabet by this function, else by doubling: a numpy step for each of
    many thousand buckets would cost more than the sort); a second induction
    gives the array.
    """
    smaller = _smaller_than_next(t)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if not len(lms):
        return _induce(t, smaller, np.array([len(t) - 1]), alphabet)
    seeds = lms[np.argsort(t[lms], kind="stable")]
    first = _induce(t, smaller, seeds, alphabet)
    is_lms = np.zeros(len(t), bool)
    is_lms[lms] = True
    in_order = first[is_lms[first]]
    names = _names(t, lms, in_order)
    if names[-1] < len(lms) - 1:
        name_at = np.zeros(len(t), np.int64)
        name_at[in_order] = names
        reduced = name_at[lms]
        small = names[-1] + 1 <= _SMALL_ALPHABET
        order = suffix_array(reduced.astype(np.uint16), int(names[-1]) + 1) if small else _by_doubling(reduced)
        in_order = lms[order]
    return _induce(t, smaller, in_order, alphabet)


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(prefix, neighbour) by place in ``t``: the neighbour is the suffix before it in the
    array (-1 for the first), the prefix the length that both share.

    A place whose preceding symbol equals its neighbour's has one symbol less than
    the place before, so only the others are compared, four symbols at a time.
    """
    n = len(t)
    neighbour = np.full(n, -1, np.int64)
    neighbour[sa[1:]] = sa[:-1]
    places = np.arange(n)
    follows = np.zeros(n, bool)
    some = np.flatnonzero((neighbour > 0) & (places > 0))
    follows[some] = t[some - 1] == t[neighbour[some] - 1]
    padded = np.r_[t.astype(np.uint64), np.full(8, 0xFFFF, np.uint64)]
    four = padded[:-3] | padded[1:-2] << np.uint64(16) | padded[2:-1] << np.uint64(32) | padded[3:] << np.uint64(48)
    shared = np.zeros(n, np.int64)
    left = np.flatnonzero(~follows & (neighbour >= 0))
    other = neighbour[left]
    length = 0
    while len(left):
        a, b = four[left + length], four[other + length]
        equal = a == b
        at = left[~equal]
        differ = a[~equal] ^ b[~equal]
        shared[at] = length + (differ & np.uint64(0xFFFF) == 0) * (1 + (differ & np.uint64(0xFFFFFFFF) == 0).astype(int) + (differ & np.uint64(0xFFFFFFFFFFFF) == 0))
        left, other = left[equal], other[equal]
        length += 4
    source = np.maximum.accumulate(np.where(follows, 0, places))
    return shared[source] - (places - source), neighbour
