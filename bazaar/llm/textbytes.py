"""Vectorised helpers over the UTF-8 bytes of Arrow string columns.

All word definitions used here are complements of ASCII sets, so working on bytes gives the same
words as working on code points. Arrays are processed in slices of a few MB: memory is bounded by
the slice size (and by the longest single text, which is never cut).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 1 << 20

#: `[^\x20\x09-\x0D]+`
SPACE_WORD = np.ones(256, bool)
SPACE_WORD[[0x20, *range(0x09, 0x0E)]] = False
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: A-Z to a-z, all other bytes unchanged
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
BASE = U64(0x9E3779B97F4A7C15 | 3)
BASE_INV = U64(pow(int(BASE), -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (murmur3)."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def powers(base: U64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


class Powers:
    """Growing tables of base**i and base**-i modulo 2**64."""

    def __init__(self):
        self.p = self.q = np.ones(1, U64)

    def upto(self, n: int):
        if len(self.p) <= n:
            self.p, self.q = powers(BASE, n), powers(BASE_INV, n)
        return self.p, self.q


def slices(arr: pa.Array, max_bytes: int = SLICE_BYTES):
    """Yield (first row, bytes, offsets) over a string array; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    n = len(arr)
    if not n:
        return
    large = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, ob, db = arr.buffers()
    offs = np.frombuffer(ob, np.int64 if large else np.int32)[arr.offset:arr.offset + n + 1].astype(np.int64)
    data = np.frombuffer(db, np.uint8) if db is not None and db.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + max_bytes, "right")) - 1)
        yield lo, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def words(buf: np.ndarray, offs: np.ndarray, table: np.ndarray):
    """Starts, ends and per-document offsets of the maximal runs of bytes for which ``table`` holds."""
    n = len(buf)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    m = table[buf]
    first = np.zeros(n + 1, bool)
    first[offs] = True
    st = m.copy()
    st[1:] &= ~m[:-1] | first[1:n]
    en = m.copy()
    en[:-1] &= ~m[1:] | first[1:n]
    starts, ends = np.flatnonzero(st), np.flatnonzero(en) + 1
    return starts, ends, np.searchsorted(starts, offs)


def prefix_hash(buf: np.ndarray, pw: Powers) -> np.ndarray:
    """H with H[i] = sum of value(b[j]) * BASE**j for j < i, modulo 2**64."""
    p, _ = pw.upto(len(buf) + 1)
    h = np.empty(len(buf) + 1, U64)
    h[0] = 0
    np.cumsum(BYTE_VALUE[buf] * p[:len(buf)], out=h[1:])
    return h


def span_hash(h: np.ndarray, starts: np.ndarray, ends: np.ndarray, pw: Powers) -> np.ndarray:
    """64-bit hash of each byte span, from ``prefix_hash``; equal bytes give equal hashes."""
    _, q = pw.upto(len(h))
    return mix((h[ends] - h[starts]) * q[starts] + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def combine(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive hashes (length len(h) - k + 1)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    for i in range(k):
        out = out * U64(0x2545F4914F6CDD1D) + h[i:i + n]
    return mix(out)


def segment_sum(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sums of values[offs[i]:offs[i+1]]."""
    c = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=c[1:])
    return c[offs[1:]] - c[offs[:-1]]


class SortedHashes:
    """A map from 64-bit hashes to positions: sorted array plus a directory on the top bits.

    Hashes are uniform, so a directory entry spans under one key on average and a lookup is a
    handful of vectorised probes."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.ascontiguousarray(keys, U64)  # ascending, unique
        bits = max(1, int(np.ceil(np.log2(len(keys) + 1))) + 1)
        self.shift = U64(64 - bits)
        edges = np.arange(1 << bits, dtype=U64) << self.shift
        self.dir = np.append(np.searchsorted(self.keys, edges), len(keys)).astype(np.int32)

    def find(self, q: np.ndarray) -> np.ndarray:
        """Position of each hash, or -1."""
        if not len(self.keys) or not len(q):
            return np.full(len(q), -1, np.int32)
        b = (q >> self.shift).astype(np.int64)
        pos, end = self.dir[b], self.dir[b + 1]
        last = np.int32(len(self.keys) - 1)
        hit = self.keys[np.minimum(pos, last)]
        out = np.where((hit == q) & (pos < end), pos, np.int32(-1))
        todo = np.flatnonzero((hit < q) & (pos + 1 < end))
        pos, end, rest = pos[todo] + 1, end[todo], q[todo]
        while len(todo):
            hit = self.keys[pos]
            good = hit == rest
            out[todo[good]] = pos[good]
            more = (hit < rest) & (pos + 1 < end)
            todo, pos, end, rest = todo[more], pos[more] + 1, end[more], rest[more]
        return out
