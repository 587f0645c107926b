"""Vectorised hashing of text held in Arrow arrays.

Everything works on flat byte buffers cut into slices of half a megabyte, so that a task's
memory is bounded by one slice, or by the longest single document where that is longer.
Hashes of ranges are polynomials modulo 2**64 with an odd base; a prefix sum gives the hash of any
range in constant time, because an odd base has an inverse. They are used for ranges of under 512 values, too
short for two periodic strings to have one hash by construction; words, of any length, are hashed otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
SLICE_BYTES = 1 << 19

#: ASCII white space that separates words: \x20 and \x09-\x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i in 0..n, kept between calls and never far larger than needed."""
    global _powers
    if len(_powers[0]) <= n:
        size = max(n + 1, SLICE_BYTES + 4096)
        out = []
        for base in (BASE, INVERSE):
            a = np.full(size, base, dtype=np.uint64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        if size > 8 * SLICE_BYTES:
            return out[0], out[1]
        _powers = out[0], out[1]
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def prefix(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums: entry i covers the first i values."""
    pw, _ = powers(len(values))
    out = np.empty(len(values) + 1, dtype=np.uint64)
    out[0] = 0
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * pw[: len(values)], out=out[1:])
    return out


def ranges(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of each range [start, stop) of the values behind ``sums``, wherever it lies."""
    _, inv = powers(len(sums))
    return (sums[stop] - sums[start]) * inv[start]


def windows(sums: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive values."""
    if len(sums) <= width:
        return np.empty(0, dtype=np.uint64)
    _, inv = powers(len(sums))
    return (sums[width:] - sums[:-width]) * inv[: len(sums) - width]


def flat(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; a null is empty."""
    if array.null_count:
        array = pc.fill_null(array, b"" if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else "")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    n = len(array)
    if n == 0 or data is None:
        return np.empty(0, dtype=np.uint8), np.zeros(n + 1, dtype=np.int64)
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[array.offset : array.offset + n + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def slices(array: pa.Array, limit: int = SLICE_BYTES, rows: int = 1 << 30) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) pieces of at most ``rows`` rows and ``limit`` bytes, or of one row."""
    data, at = flat(array)
    first, n = 0, len(array)
    while first < n:
        last = min(first + rows, max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1))
        yield first, last, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, stops, word offsets by row) of the words, which the bytes of ``space`` separate; a word never crosses rows."""
    n = len(data)
    if n == 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.zeros(len(offsets), dtype=np.int64)
    solid = ~space[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    cut = offsets[(offsets > 0) & (offsets < n)]
    first[cut] |= solid[cut]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[cut - 1] |= solid[cut - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, word offsets by row).

    Each byte counts with its place in the word, mixed; a polynomial would not do, since words of a
    thousand bytes can be built that have one hash modulo 2**64 whatever its base is.
    """
    starts, stops, rows = word_spans(data, offsets)
    lengths = stops - starts
    at = np.concatenate([[0], np.cumsum(lengths)])
    place = np.arange(at[-1], dtype=np.uint64) - np.repeat(at[:-1], lengths).astype(np.uint64)
    sums = np.zeros(at[-1] + 1, dtype=np.uint64)
    np.cumsum(mix((place << np.uint64(8) | data[~SPACE[data]]) + np.uint64(BASE)), out=sums[1:])
    return mix(sums[at[1:]] - sums[at[:-1]]), rows


def assigned(hashes: np.ndarray, width: int, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window): each window of ``width`` hashes is assigned to its smallest.

    ``ok`` marks the first positions of the windows that count; of equal hashes the leftmost is
    taken. The choice depends on a window's content alone, so equal windows have equal anchors at
    equal distances wherever they lie; the windows of an anchor are consecutive.
    """
    n = len(hashes)
    none = np.empty(0, dtype=np.int64)
    if n < width:
        return none, none, none
    bits = np.uint64(max(23, int(n).bit_length()))
    low = (hashes >> bits << bits) | np.arange(n, dtype=np.uint64)
    have = 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: n - width + 1], low[width - have : width - have + n - width + 1])
    start = np.flatnonzero(ok[: len(low)])
    if not len(start):
        return none, none, none
    best = low[start] & ((np.uint64(1) << bits) - np.uint64(1))
    turn = np.flatnonzero(best[1:] != best[:-1]) + 1
    begin = np.concatenate([[0], turn])
    stop = np.append(turn, len(best))
    return best[begin].astype(np.int64), start[begin], start[stop - 1]


def merged(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of the intervals [start, stop) as maximal disjoint ones; touching ones become one."""
    if not len(start):
        return start, stop
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    first = np.ones(len(start), dtype=bool)
    first[1:] = start[1:] > reach[:-1]
    begin = np.flatnonzero(first)
    return start[begin], reach[np.append(begin[1:], len(start)) - 1]
