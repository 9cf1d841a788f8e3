"""Vectorised hashing of whole texts inside Arrow tasks (numpy only, bounded working memory).

A batch of texts is one run of UTF-8 bytes plus row offsets, as Arrow stores it.
Hashes of any byte range come from one prefix sum modulo 2**64:
``P[i] = sum(T[b_j] * B**j for j < i)`` gives ``hash(s, e) = mix((P[e] - P[s]) * B**-s)``,
with a table ``T`` of 64-bit values per byte and an odd base ``B``.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text handled at once; temporaries take about sixty times that.
CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising bijection of 64-bit values (xor-shift and multiply)."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x = x * U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


_BYTES = np.arange(256, dtype=np.uint8)
_TABLE = mix((np.arange(1, 257, dtype=U64)) * U64(0xD1342543DE82EF95))
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: White space of the word rule ``[^\x20\x09-\x0D]+``.
_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (kept between calls, grown when needed)."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK_BYTES + 4096), base, dtype=U64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps, dtype=U64)
    return have[:n]


def give_back() -> None:
    """Free what earlier operators' tasks left in a reused Python worker: tables of powers, Arrow's pool, the C heap's free pages."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without the call
        ctypes.CDLL(None).malloc_trim(0)


def prefix(data: np.ndarray) -> np.ndarray:
    """P of the module's docstring, one longer than ``data``."""
    out = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(_TABLE[data] * powers(_BASE, len(data)), dtype=U64, out=out[1:])
    return out


def range_hash(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges [start, end) below the prefix sums ``p``."""
    return mix((p[end] - p[start]) * powers(_INVERSE, len(p))[start] + (end - start).astype(U64))


def texts_of(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow text column without nulls."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], pa.string())
    array = array.cast(pa.large_binary()) if not pa.types.is_large_binary(array.type) else array
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    return np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES, rows: int = 1 << 15) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``most`` bytes and at most ``rows`` rows (a longer text is a range of its own)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1
        hi = min(max(hi, lo + 1), lo + rows, n)
        yield lo, hi
        lo = hi


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) bytes of every word ``[^\\x20\\x09-\\x0D]+``, never across rows."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~_SPACE[data]
    first = np.zeros(n + 1, dtype=bool)  # a text begins here
    first[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | first[1:n]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | first[1:n]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every word, its start byte, words before each row)."""
    if lower:
        data = _LOWER[data]
    start, end = spans(data, offsets)
    if not len(start):
        return np.zeros(0, U64), start, np.zeros(len(offsets), np.int64)
    return range_hash(prefix(data), start, end), start, np.searchsorted(start, offsets)


def shingles(word: np.ndarray, bounds: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of ``size`` words of every row, in row order; a shorter row is one run of all its words."""
    counts = np.diff(bounds)
    row = np.repeat(np.arange(len(counts)), counts)
    c = powers(0xA0761D6478BD642F | 1, size + 1)
    n = len(word)
    if n >= size:
        whole = np.flatnonzero(row[: n - size + 1] == row[size - 1 :])
        h = np.zeros(len(whole), dtype=U64)
        for k in range(size):
            h += word[whole + k] * c[k + 1]
        h = mix(h + U64(size))
        rows = row[whole]
    else:
        h, rows = np.zeros(0, U64), np.zeros(0, np.int64)
    for k in range(1, size):
        short = np.flatnonzero(counts == k)
        if len(short):
            s = np.zeros(len(short), dtype=U64)
            for j in range(k):
                s += word[bounds[short] + j] * c[j + 1]
            h, rows = np.concatenate([h, mix(s + U64(k))]), np.concatenate([rows, short])
    if len(rows) and (np.diff(rows) < 0).any():
        order = np.argsort(rows, kind="stable")
        h, rows = h[order], rows[order]
    return h, rows
