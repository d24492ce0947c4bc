"""Numpy kernels on Arrow batches: word hashes, shingles and ragged helpers.

Texts are worked on as one run of UTF-8 bytes with document offsets.  Blanks
are ASCII and never occur inside a multi-byte character, so words are found on
the bytes.  A word's hash is a polynomial of its bytes modulo 2**64, taken
from prefix sums, mixed with its length.
"""

from __future__ import annotations

import ctypes
from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64
CHUNK = 1 << 20          # bytes hashed at once
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

SEP = np.zeros(256, bool)
SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE_KEYS = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
LOWER_KEYS = BYTE_KEYS[LOWER]
_MULT = np.random.default_rng(977).integers(1, 1 << 63, 4096, dtype=np.uint64) * U(2) + U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> U(31))) * U(0x7FB5D329728EA185)
    x = (x ^ (x >> U(27))) * U(0x81DADEF4BC2DD44D)
    return x ^ (x >> U(33))


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, U)
    p[0] = 1
    return np.cumprod(p, dtype=U)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = CHUNK + 1 if n <= CHUNK + 1 else n
    return _powers(_BASE, size)[:n], _powers(_BASE_INV, size)[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def groups(off: np.ndarray, most: int = CHUNK):
    """Runs (first, end) of documents with about ``most`` bytes together; a
    longer document makes a run of its own.  Behind the last one, what the worker
    no longer uses goes back to the system: it lives on for tasks of other kinds."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield i, j
        i = j
    release()


def release() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):      # another C library
        pass


def word_hashes(buf: np.ndarray, off: np.ndarray, lower: bool = False, seed: int = 0
                ) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of words of each document."""
    keys = LOWER_KEYS if lower else BYTE_KEYS
    hashes, counts = [], np.zeros(len(off) - 1, np.int64)
    a, end = 0, len(buf)
    while a < end:
        b = _safe_cut(buf, off, a, end)
        x = buf[a:b]
        sep = SEP[x]
        fresh = np.zeros(len(x) + 1, bool)
        inside = off[np.searchsorted(off, a):np.searchsorted(off, b)] - a
        fresh[inside] = True
        start, stop = ~sep, ~sep
        start[1:] &= sep[:-1] | fresh[1:-1]
        stop[:-1] &= sep[1:] | fresh[1:-1]
        s, e = np.flatnonzero(start), np.flatnonzero(stop) + 1
        up, down = powers(len(x) + 1)
        c = np.zeros(len(x) + 1, U)
        np.cumsum(keys[x] * up[:-1], out=c[1:])
        hashes.append(mix((c[e] - c[s]) * down[s] + (e - s).astype(U) * U(0xA24BAED4963EE407) + U(seed)))
        counts += np.bincount(np.searchsorted(off, a + s, "right") - 1, minlength=len(counts))
        a = b
    return (np.concatenate(hashes) if hashes else np.zeros(0, U)), counts


def _safe_cut(buf: np.ndarray, off: np.ndarray, a: int, end: int) -> int:
    """End of the next piece: no word goes over it."""
    b = min(a + CHUNK, end)
    if b == end:
        return b
    at_doc = off[np.searchsorted(off, b, "right") - 1]
    blanks = np.flatnonzero(SEP[buf[a:b]])
    cut = max(int(at_doc), a + int(blanks[-1]) + 1 if len(blanks) else a)
    if cut > a:
        return cut
    while b < end:                       # one word longer than the piece
        nxt = np.flatnonzero(SEP[buf[b:b + CHUNK]])
        stop = b + int(nxt[0]) + 1 if len(nxt) else min(b + CHUNK, end)
        doc = int(off[min(np.searchsorted(off, b, "left"), len(off) - 1)])
        if b <= doc <= stop:
            return doc if doc > a else stop
        b = stop
        if len(nxt):
            break
    return b


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` neighbours of ``h`` (over document ends too)."""
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, U)
    for j in range(k):
        out += h[j:j + n] * _MULT[j]
    return mix(out + U(k))


def starts_of(counts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def ragged_index(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... (count[0] of them), first[1], ..."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(first - starts_of(count)[:-1], count)
    return np.arange(total, dtype=np.int64) + shift


def list_array(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(starts_of(counts).astype(np.int32)), pa.array(flat, kind))
