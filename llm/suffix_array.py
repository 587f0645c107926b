"""Suffix arrays by recursive induced sorting, and permuted common prefixes, vectorised with numpy.

The text is an array of small numbers whose last is 0 and occurs nowhere else. Suffixes are
classified as smaller (S) or larger (L) than their right neighbour; an S suffix after an L one is
leftmost-smaller (LMS). Sorting the LMS substrings induces names; the string of names is sorted
by the same function, and from the sorted LMS suffixes all others are induced in two linear
passes, one bucket (first symbol) after another.

Numpy handles a bucket at once, so alphabets must stay small. Where there are over ``NAMES`` names,
each is written as two digits before the string of names is sorted: the order of suffixes that
start at a first digit is that of the names. Two digits a name make the string no longer than two
thirds of the text on texts whose classes are random; where it would not shrink, names are kept.
Strings of up to ``FEW`` names end the recursion: passes over hundreds of buckets cost more there
than sorting by ranks of doubled length.
"""

from __future__ import annotations

import numpy as np

#: From how many names on a name is written as two digits.
NAMES = 256
#: Up to how many names are sorted by doubling ranks.
FEW = 1 << 17


def classify(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each suffix is S, the LMS positions in order)."""
    n = len(text)
    if n == 1:
        return np.ones(1, dtype=bool), np.zeros(1, dtype=np.int32)
    left, right = text[:-1], text[1:]
    smaller = np.ones(n, dtype=bool)
    smaller[:-1] = left < right
    same = np.flatnonzero(left == right)
    if len(same):  # a run of equal symbols has the class of its last one
        ends = np.append(np.flatnonzero(left != right), n - 1)
        smaller[same] = smaller[ends[np.searchsorted(ends, same)]]
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    return smaller, lms.astype(np.int32)


def induce(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The suffix array that the LMS suffixes, in the order of ``seeds``, induce."""
    n, k = len(text), int(text.max()) + 1
    counts = np.bincount(text, minlength=k)
    end = np.cumsum(counts)
    start = end - counts
    array = np.full(n, -1, dtype=np.int32)
    heads = start.copy()
    symbols = text[seeds]
    by_symbol = seeds[np.argsort(symbols, kind="stable")]
    seed_end = np.cumsum(np.bincount(symbols, minlength=k))

    def put(batch: np.ndarray, want_smaller: bool, at: np.ndarray, step: int) -> None:
        before = batch - 1
        before = before[before >= 0]
        before = before[smaller[before] == want_smaller]
        if not len(before):
            return
        symbol = text[before]
        order = np.argsort(symbol, kind="stable")
        symbol = symbol[order]
        own = np.bincount(symbol, minlength=k)
        rank = np.arange(len(order)) - np.repeat(np.cumsum(own) - own, own)
        array[at[symbol] + step * rank] = before[order]
        at += step * own

    present = np.flatnonzero(counts)
    for c in present:
        done = start[c]
        while done < heads[c]:
            batch = array[done : heads[c]]
            done = heads[c]
            put(batch, False, heads, 1)
        seeds_here = by_symbol[(seed_end[c - 1] if c else 0) : seed_end[c]]
        if len(seeds_here):
            put(seeds_here, False, heads, 1)
    tails = end - 1
    array[0] = n - 1
    tails[0] -= 1  # the closing 0
    for c in present[::-1]:
        done = end[c] - 1
        if c == 0:
            put(array[:1], True, tails, -1)
            continue
        while done > tails[c]:
            batch = array[tails[c] + 1 : done + 1][::-1]
            done = tails[c]
            put(batch, True, tails, -1)
        put(array[start[c] : heads[c]][::-1], True, tails, -1)
    return array


def names_of(text: np.ndarray, lms: np.ndarray, found: np.ndarray) -> np.ndarray:
    """The rank of each LMS substring, in the order of ``lms``; ``found`` has their places, sorted."""
    length = np.empty(len(text), dtype=np.int64)
    length[lms] = np.append(np.diff(lms) + 1, 1)  # the next LMS symbol counts
    size = length[found]
    fresh = np.ones(len(found), dtype=np.int64)
    alike = np.flatnonzero(size[1:] == size[:-1]) + 1
    if len(alike):
        size = size[alike]
        first = np.cumsum(size) - size
        step = np.arange(size.sum()) - np.repeat(first, size)
        same = text[np.repeat(found[alike], size) + step] == text[np.repeat(found[alike - 1], size) + step]
        fresh[alike] = ~np.logical_and.reduceat(same, first)
    names = np.empty(len(text), dtype=np.int64)
    names[found] = np.cumsum(fresh) - 1
    return names[lms]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The places of all suffixes in their order."""
    text = text.astype(np.uint16 if int(text.max(initial=0)) < 1 << 16 else np.int64)
    smaller, lms = classify(text)
    if len(text) == 1 or not len(lms):
        return np.arange(len(text), dtype=np.int32)[::-1].copy()
    sorted_substrings = induce(text, smaller, lms)
    is_lms = np.zeros(len(text), dtype=bool)
    is_lms[lms] = True
    names = names_of(text, lms, sorted_substrings[is_lms[sorted_substrings]])
    del sorted_substrings, is_lms
    return induce(text, smaller, lms[name_order(names, len(text))])


def name_order(names: np.ndarray, room: int) -> np.ndarray:
    """The order of the suffixes of ``names``, whose last is 0; ``room`` is the length of the text they name."""
    most = int(names.max())
    if most + 1 == len(names):
        return np.argsort(names)
    if len(names) <= FEW:
        return double_ranks(names)
    if most < NAMES or 2 * len(names) > 0.9 * room:
        return suffix_array(names)
    base = int(np.ceil(np.sqrt(most)))
    digits = np.zeros(2 * len(names) - 1, dtype=np.int64)
    digits[:-1:2], digits[1::2] = np.divmod(names[:-1] - 1, base)
    digits[:-1] += 1
    order = suffix_array(digits)
    return order[order % 2 == 0] // 2


def double_ranks(names: np.ndarray) -> np.ndarray:
    """The order of the suffixes of ``names``, whose last is the least."""
    rank, have, n = names, 1, len(names)
    while True:
        key = rank * (n + 1)
        key[: n - have] += rank[have:] + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        fresh = np.zeros(n, dtype=np.int64)
        fresh[1:] = key[1:] != key[:-1]
        fresh = np.cumsum(fresh)
        if fresh[-1] == n - 1:
            return order
        rank = np.empty(n, dtype=np.int64)
        rank[order] = fresh
        have *= 2


def permuted_prefixes(text: np.ndarray, array: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(common prefix of each suffix with the one before it in the array, 0 for the first; that suffix, -1 for the first).

    A value is its left neighbour's less one where the symbols before both suffixes are equal. The
    others add up to n log n at most and are found by comparing symbols, four at a time.
    """
    n = len(text)
    before = np.full(n, -1, dtype=np.int64)
    before[array[1:]] = array[:-1]
    own = np.ones(n, dtype=bool)
    follows = np.flatnonzero(before[1:] > 0) + 1
    own[follows] = text[follows - 1] != text[before[follows] - 1]
    words = np.zeros(n, dtype=np.uint64)
    for d in range(4):
        words[: max(n - d, 0)] |= text[d:].astype(np.uint64) << np.uint64(16 * d)
    shared = np.zeros(n, dtype=np.int64)
    alive = np.flatnonzero(own & (before >= 0))
    a, b = alive, before[alive]
    while len(alive):
        differ = words[a] ^ words[b]
        for bits in (16, 32, 48):
            shared[alive] += (differ << np.uint64(64 - bits)) == 0
        go = differ == 0
        alive, a, b = alive[go], a[go] + 4, b[go] + 4
        shared[alive] += 1
    last = np.maximum.accumulate(np.where(own, np.arange(n), 0))
    return shared[last] - (np.arange(n) - last), before
