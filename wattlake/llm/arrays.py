"""Whole-batch text primitives on numpy arrays (no Spark, no per-row loops).

A batch of texts is one UTF-8 byte buffer plus offsets. Words are maximal
runs of bytes outside ``\\x20\\x09-\\x0D``; every word, window and n-gram gets a
64-bit content name, so equal sequences get equal names in every task
without any exchange of dictionaries.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U = np.uint64
LONG_WORD = 1024
SLICE_BYTES = 4 << 20          # texts are handled in slices of about this size (a longer text is a slice of its own)
_M1, _M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)   # finaliser constants of splitmix64 (fixed values)
_BASE, _SEQ = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95      # odd multipliers (fixed values)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: a bijection that spreads every bit."""
    x = x ^ (x >> U(30))
    x = x * _M1
    x ^= x >> U(27)
    x *= _M2
    x ^= x >> U(31)
    return x


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inv = base, pow(base, -1, 1 << 64)
        self.fwd = self.back = np.ones(1, np.uint64)

    def upto(self, n: int):
        if len(self.fwd) < n:
            size = max(n, 1 << 16)
            self.fwd, self.back = (np.cumprod(np.r_[U(1), np.full(size - 1, U(b), np.uint64)]) for b in (self.base, self.inv))
        return self.fwd, self.back


_WORDS = _Powers(_SEQ)


def text_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow text column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.string())
    col = col.cast(pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, "")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def slices(off: np.ndarray, limit: int = SLICE_BYTES):
    """(i, j) ranges of texts of about ``limit`` bytes each, at least one text."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def cut(buf, off, i, j):
    return buf[off[i]:off[j]], off[i:j + 1] - off[i]


def tokens(buf: np.ndarray, off: np.ndarray, breaks: np.ndarray = IS_SPACE):
    """(starts, ends, word_off): words of all texts; text d has words word_off[d]:word_off[d+1]."""
    n = len(buf)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    space = breaks[buf]
    edge = np.zeros(n + 1, bool)          # a text starts at this byte
    edge[off] = True
    before = np.empty(n, bool)
    before[0], before[1:] = True, space[:-1]
    starts = np.flatnonzero(~space & (before | edge[:n]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, space[1:]
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_names(buf, starts, ends) -> np.ndarray:
    """64-bit content name of each word: its length and its blocks of eight bytes, mixed one after the other.

    Each block goes through a bijection of the state before it, so no regular pair of words collides for certain.
    Words over ``LONG_WORD`` bytes are named by xxh3.
    """
    size = ends - starts
    out = mix(size.astype(np.uint64) * U(_BASE) + U(_SEQ))
    if not len(starts):
        return out
    padded = np.concatenate([np.ascontiguousarray(buf), np.zeros(8, np.uint8)])
    block = np.ndarray((len(buf) + 1,), "<u8", padded, strides=(1,))        # eight bytes from every place on
    live, done = np.flatnonzero((size > 0) & (size <= LONG_WORD)), 0
    while len(live):
        left = size[live] - done
        short = np.minimum(left, 8).astype(np.uint64) * U(8)
        keep = (U(0xFFFFFFFFFFFFFFFF) >> (U(64) - short))
        out[live] = mix(out[live] ^ (block[starts[live] + done] & keep))
        done += 8
        live = live[left > 8]
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(buf[starts[i]:ends[i]].tobytes())
    return out


def window_names(names: np.ndarray, k: int) -> np.ndarray:
    """Name of names[i:i+k] for every i with i + k <= len(names)."""
    n = len(names) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    fwd, back = _WORDS.upto(len(names) + 1)
    c = np.empty(len(names) + 1, np.uint64)
    c[0] = 0
    np.cumsum(names * fwd[:len(names)], out=c[1:])
    return mix((c[k:] - c[:n]) * back[:n] + U(k))


def starts_inside(word_off: np.ndarray, k: int) -> np.ndarray:
    """Boolean per word: a window of k words starting here ends inside its text."""
    total = int(word_off[-1])
    end = np.repeat(word_off[1:], np.diff(word_off))
    return np.arange(total) + k <= end


def owner(word_off: np.ndarray) -> np.ndarray:
    """Text index of each word."""
    return np.repeat(np.arange(len(word_off) - 1), np.diff(word_off))


def split_by(key: np.ndarray, parts: int):
    """(part, positions) for every part in use, in order of part; positions keep their order."""
    if not len(key):
        return
    order = np.argsort(key, kind="stable")
    edges = np.searchsorted(key[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(edges)):
        yield int(p), order[edges[p]:edges[p + 1]]


def part_of(names: np.ndarray, parts: int) -> np.ndarray:
    """Hash partition of a name, from bits that orderings by name do not use first."""
    return ((names & U(0xFFFFFFFF)) % U(parts)).astype(np.int32)


def blob(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def pack(a: np.ndarray) -> bytes:
    """Non-negative integers in the fewest bytes each (1, 2, 4 or 8); the first byte tells the width."""
    top = int(a.max()) if len(a) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([width]) + np.ascontiguousarray(a, f"<u{width}").tobytes()


def unpack(b: bytes) -> np.ndarray:
    return np.frombuffer(b, f"<u{b[0]}", offset=1).astype(np.int64)


def heads(*columns: np.ndarray) -> np.ndarray:
    """Boolean per row of sorted columns: the row differs from the one before in any column."""
    out = np.ones(len(columns[0]), bool)
    if len(out) > 1:
        out[1:] = False
        for c in columns:
            out[1:] |= c[1:] != c[:-1]
    return out


def runs(head: np.ndarray) -> np.ndarray:
    """Length of each run that a head starts."""
    at = np.flatnonzero(head)
    return np.diff(np.r_[at, len(head)])


def span(name: np.ndarray, parts: int) -> np.ndarray:
    """Range partition of names: monotone in the name, so sorted names are grouped by part."""
    return ((name >> U(32)) * U(parts) >> U(32)).astype(np.int64)


def gaps(ascending: np.ndarray) -> list[bytes]:
    """Ascending 64-bit values as gaps: the low halves, and the high halves in the fewest bytes."""
    g = np.diff(ascending, prepend=U(0))
    return [blob(g.astype(np.uint32)), pack(g >> U(32))]


def from_gaps(low: bytes, high: bytes) -> np.ndarray:
    return np.cumsum((unpack(high).view(np.uint64) << U(32)) | np.frombuffer(low, np.uint32), dtype=np.uint64)


def frame(fields: list[bytes]) -> bytes:
    return struct.pack(f"<I{len(fields)}Q", len(fields), *map(len, fields)) + b"".join(fields)


def unframe(data: bytes) -> list[bytes]:
    n = struct.unpack_from("<I", data)[0]
    sizes = struct.unpack_from(f"<{n}Q", data, 4)
    at, out = 4 + 8 * n, []
    for s in sizes:
        out.append(data[at:at + s])
        at += s
    return out
