"""Word and shingle hashes of many texts at once, as numpy arrays over the UTF-8 bytes.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z lower-cased.
Hashes are 64-bit polynomial prefix sums with a final mix: equal words have
equal hashes, and different ones differ but for a chance of about 2**-64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_LOWER += 1
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n at least."""
    global _powers
    if len(_powers[0]) < n:
        made = []
        for b in (BASE, pow(BASE, -1, 1 << 64)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _powers = made[0], made[1]
    return _powers


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """h with h[j] - h[i] = sum of values[k] * BASE**k for i <= k < j."""
    h = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values) + 1)[0][: len(values)], out=h[1:])
    return h


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a binary or text column; nulls are empty."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, off - off[0]


_libc = ctypes.CDLL(None)


def release() -> None:
    """Give freed memory back to the system: Python workers live on and serve later stages."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of each come to about ``most`` bytes; a longer text stands alone."""
    for batch in batches:
        lengths = np.diff(raw(batch.column(column))[1])
        ends = np.cumsum(lengths)
        i = 0
        while i < len(lengths):
            before = ends[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(i, j - i)
            i = j
        del batch
        release()


def words(column: pa.Array, gap: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte (in the column's bytes) of each word, and where each row's words begin.

    ``gap`` tells for each byte whether it separates words.
    """
    buf, off = raw(column)
    n = len(buf)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    ink = ~gap[buf]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    starts = ink.copy()
    starts[1:] &= ~ink[:-1] | edge[1:n]
    ends = ink.copy()
    ends[:-1] &= ~ink[1:] | edge[1:n]
    ws, we = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    h = prefix_sums(_LOWER[buf])
    return mix((h[we] - h[ws]) * powers(n + 1)[1][ws]), ws, we, np.searchsorted(ws, off)


def shingles(hashes: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the rows' word shingles, and where each row's begin.

    A row with fewer than ``size`` words has its whole sequence as one shingle; a row without words has none.
    """
    n = np.diff(first)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    begin = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(begin[-1]) - np.repeat(begin[:-1] - first[:-1], count)
    length = np.repeat(np.minimum(n, size), count)
    out = mix(length.astype(np.uint64))
    for j in range(size):
        more = length > j
        out[more] = mix(out[more] * np.uint64(BASE) + hashes[at[more] + j])
    return out, begin
