"""Hashed words of whole texts, many documents at a time.

Words are runs of bytes other than 0x20 and 0x09-0x0D, which in UTF-8 are the words ``[^\\x20\\x09-\\x0D]+``. A word's
hash is a polynomial over its bytes, taken from running sums over the whole batch and then mixed to 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_WS = np.zeros(256, bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, U)
    out[0] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * U(pow(base, done, 1 << 64))
        done += step
    return out


_cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for at least ``n`` places."""
    size = 1 << max(18, (n - 1).bit_length())
    if size not in _cache:
        _cache.clear()
        _cache[size] = (_powers(_BASE, size), _powers(_INVERSE, size))
    return _cache[size]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def text_chunks(column: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of at most ``limit`` bytes, or one longer row; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    n = len(column)
    if not n:
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        end = min(end, n)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def hash_words(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end byte of each word, and the place of each row's first word (one entry more than rows)."""
    n = len(data)
    if not n:
        return np.empty(0, U), np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    data = _LOWER[data] if lower else data
    inside = ~_WS[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = offsets[1:][offsets[1:] > offsets[:-1]]
    after[ends - 1] = False
    starts = np.flatnonzero(inside & ~before)
    stops = np.flatnonzero(inside & ~after) + 1
    up, down = powers(n)
    sums = np.empty(n + 1, U)
    sums[0] = 0
    np.cumsum((data.astype(U) + U(1)) * up[:n], out=sums[1:])
    h = mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(U))
    return h, starts, stops, np.searchsorted(starts, offsets)


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` consecutive hashes, regardless of rows; shorter input gives none."""
    n = len(h)
    if n < size:
        return np.empty(0, U)
    up, down = powers(n)
    sums = np.empty(n + 1, U)
    sums[0] = 0
    np.cumsum(h * up[:n], out=sums[1:])
    return mix((sums[size:] - sums[: n - size + 1]) * down[: n - size + 1] + U(size))


def within(offsets: np.ndarray, size: int) -> np.ndarray:
    """Places at which ``size`` consecutive words lie inside one row."""
    counts = np.maximum(np.diff(offsets) - size + 1, 0)
    total = int(counts.sum())
    rows = np.repeat(np.arange(len(counts)), counts)
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) + offsets[rows]
