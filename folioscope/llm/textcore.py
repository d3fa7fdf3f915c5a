"""Vectorised text kernels shared by the corpus operators.

A batch of texts is handled as one UTF-8 byte buffer with row offsets, never as Python strings. Words,
lines and shingles become 64-bit hashes: a polynomial prefix hash modulo 2**64 over a fixed random byte
table, finished with an avalanche mix. Working memory is bounded by ``CHUNK`` bytes of text, or by one text
where a single text is longer.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
CHUNK = 1 << 20
_BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_INV_BASE = pow(_BASE, -1, 1 << 64)

#: Byte classes: white space of the word rule [^\x20\x09-\x0D]+.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_rng = np.random.Generator(np.random.PCG64(20240611))
TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)
LOWER_TABLE = TABLE.copy()
LOWER_TABLE[65:91] = TABLE[97:123]
SHINGLE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | U64(1)

_powers: dict[int, np.ndarray] = {}


def _power_table(base: int) -> np.ndarray:
    if base not in _powers:
        t = np.full(_BLOCK + 1, base, np.uint64)
        t[0] = 1
        _powers[base] = np.cumprod(t, dtype=np.uint64)
    return _powers[base]


def _release() -> None:
    """Give freed memory back to the system: workers stay for later tasks, and several idle ones add up."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche 64-bit values (in a new array)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    offs = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def chunks(batches, column: str, limit: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) with at most ``limit`` bytes of text, or one longer text."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        data, offs = text_buffers(batch.column(at))
        n, i = len(offs) - 1, 0
        while i < n:
            j = int(np.searchsorted(offs, offs[i] + limit, "right")) - 1
            j = min(max(j, i + 1), n, i + 20_000)
            yield batch.slice(i, j - i), data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
            i = j
    _release()


def spans(data: np.ndarray, offs: np.ndarray, sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the maximal runs of bytes outside ``sep``; a run ends with its row."""
    n = len(data)
    if not n:
        z = np.empty(0, np.int64)
        return z, z, z
    inside = ~sep[data]
    cut = offs[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[cut] = inside[cut]
    starts = np.flatnonzero(first)
    last = inside
    was = inside[cut - 1]
    last[:-1] &= ~(last[1:].copy())
    last[cut - 1] = was
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = TABLE) -> np.ndarray:
    """64-bit hashes of the non-empty, ascending, disjoint byte spans."""
    lo, hi = np.empty(len(starts), np.uint64), np.empty(len(starts), np.uint64)
    power, inverse = _power_table(_BASE), _power_table(_INV_BASE)
    carry, scale, back = U64(0), 1, []
    for b in range(0, len(data), _BLOCK):
        block = data[b : b + _BLOCK]
        v = table[block]
        v *= power[: len(block)]
        if scale != 1:
            v *= U64(scale)
        p = np.empty(len(block) + 1, np.uint64)
        p[0] = 0
        np.cumsum(v, out=p[1:])
        p += carry
        i, j = np.searchsorted(starts, [b, b + len(block)])
        lo[i:j] = p[starts[i:j] - b]
        i, j = np.searchsorted(ends, [b, b + len(block)], "right")
        hi[i:j] = p[ends[i:j] - b]
        carry = p[-1]
        back.append(pow(_INV_BASE, b, 1 << 64))
        scale = pow(_BASE, b + _BLOCK, 1 << 64)
    h = (hi - lo) * inverse[starts % _BLOCK]
    if len(back) > 1:
        h *= np.array(back, np.uint64)[starts // _BLOCK]
    h += (ends - starts).astype(np.uint64) * U64(0xD6E8FEB86659FD93)
    return mix(h)


def shingles(hashes: np.ndarray, row: np.ndarray, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and rows of the k-word windows; with ``short`` a row of fewer than k words gives one of all its words."""
    n = len(hashes)
    if n >= k:
        ok = row[: n - k + 1] == row[k - 1 :]
        s = hashes[: n - k + 1] * SHINGLE[0]
        for j in range(1, k):
            s += hashes[j : n - k + 1 + j] * SHINGLE[j]
        s, r = mix(s[ok]), row[: n - k + 1][ok]
    else:
        s, r = np.empty(0, np.uint64), np.empty(0, np.int64)
    if short and n:
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        size = np.diff(np.r_[first, n])
        few = size < k
        if few.any():
            f, m = first[few], size[few]
            t = np.zeros(len(f), np.uint64)
            for j in range(k - 1):
                has = m > j
                t[has] += hashes[f[has] + j] * SHINGLE[j]
            t = mix(t + m.astype(np.uint64))
            s, r = np.r_[s, t], np.r_[r, row[f]]
            order = np.argsort(r, kind="stable")
            s, r = s[order], r[order]
    return s, r
