"""Vectorised tokenisation over UTF-8 buffers.

The Python operators of this subpackage read Arrow string columns as bytes and work on whole
slices of a batch with numpy, so no Python object exists per word. Slices are bounded in bytes;
only a single text longer than a slice makes a larger one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_PIECE = 1 << 20
_P = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_P, _PIECE + 1)
_INV = _powers(pow(_P, -1, 1 << 64), _PIECE + 1)


def lower_table() -> np.ndarray:
    """Byte table that lower-cases A-Z and leaves every other byte as it is."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def class_table(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean byte table, true within the inclusive ranges."""
    t = np.zeros(256, dtype=bool)
    for a, b in ranges:
        t[a : b + 1] = True
    return t


LOWER = lower_table()


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n+1 offsets of its rows; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=n + 1, offset=8 * column.offset)
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about `limit` bytes; every row is in exactly one."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def word_spans(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of consecutive rows, and each row's first word (n+1 entries)."""
    if len(buf) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = is_word[buf]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    rows = offsets[:-1][offsets[:-1] < len(buf)]
    before[rows] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, alike wherever the word stands."""
    out = np.empty(len(starts), dtype=np.uint64)
    a = 0
    while a < len(starts):
        base = starts[a]
        b = int(np.searchsorted(ends, base + _PIECE, side="right"))
        b = max(b, a + 1)
        size = int(ends[b - 1] - base)
        power, inverse = (_POW, _INV) if size <= _PIECE else (_powers(_P, size), _powers(pow(_P, -1, 1 << 64), size))
        total = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODES[buf[base : base + size]] * power[:size], out=total[1:])
        s, e = starts[a:b] - base, ends[a:b] - base
        out[a:b] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64))
        a = b
    return out
