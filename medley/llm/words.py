"""Words and their 64-bit hashes for whole Arrow text columns, without a Python loop over words.

A word is a run of bytes other than space and 0x09 to 0x0D. Its hash is a polynomial over its bytes modulo 2^64 with an odd
base, mixed with its length; equal words have equal hashes and different ones differ but for one chance in about 2^64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15)


def _inverse(x: int) -> int:
    return pow(x, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes, one row at least."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield low, min(high, n)
        low = high


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of each word; offsets begin at 0."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = (data != 32) & ((data < 9) | (data > 13))
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    first[heads] |= inside[heads]
    last[tails] |= inside[tails]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return np.searchsorted(offsets, start, "right") - 1, start, end


_TABLES: list[np.ndarray] = []


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, limit: int = SLICE) -> np.ndarray:
    """The hash of each word, worked out over pieces of about ``limit`` bytes."""
    out = np.empty(len(start), np.uint64)
    low = 0
    while low < len(start):
        high = max(low + 1, int(np.searchsorted(end, start[low] + limit, "right")))
        a, b = int(start[low]), int(end[high - 1])
        if not _TABLES or len(_TABLES[0]) < b - a + 1:
            size = max(limit, b - a) + 1
            _TABLES[:] = [_powers(int(BASE), size), _powers(_inverse(int(BASE)), size)]
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * _TABLES[0][: b - a], out=sums[1:])
        s, e = start[low:high] - a, end[low:high] - a
        out[low:high] = (sums[e] - sums[s]) * _TABLES[1][s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        low = high
    return mix(out)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case, every other byte as it is."""
    return np.where((data >= 65) & (data <= 90), data | np.uint8(32), data)
