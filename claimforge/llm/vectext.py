"""Whole columns of text as flat byte arrays: words, hashes and ragged gathers, vectorised with numpy.

A text column becomes one ``uint8`` buffer with document offsets, so an operation costs a few numpy
calls per block of documents instead of Python work per word. Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: White space of the word rule ``[^\x20\x09-\x0D]+``.
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_TABLE = LOWER.tobytes()
MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=U)
K1, K2, K3 = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0xD6E8FEB86659FD93)
BLOCK_BYTES = 4 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words whose output bits all depend on all input bits."""
    h = h ^ (h >> U(32))
    h *= K3
    h ^= h >> U(32)
    h *= K3
    h ^= h >> U(32)
    return h


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each (one more than texts). Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``limit`` bytes together; a longer document stands alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


class Text:
    """A block of documents: ``buf`` (padded by 8 bytes beyond ``n``) and ``offsets``."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.n = len(buf)
        self.buf = np.zeros(self.n + 8, np.uint8)
        self.buf[: self.n] = LOWER[buf] if lower else buf
        self.offsets = offsets
        self.lanes = np.ndarray((self.n + 1,), "<u8", self.buf, strides=(1,))

    @property
    def docs(self) -> int:
        return len(self.offsets) - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each word, and the index of each document's first word (one more than documents)."""
        on = ~WHITE[self.buf[: self.n]]
        return self.runs(on)

    def runs(self, on: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of true within documents, as words()."""
        first, last = on.copy(), on.copy()
        first[1:] &= ~on[:-1]
        last[:-1] &= ~on[1:]
        filled = np.diff(self.offsets) > 0
        begin, end = self.offsets[:-1][filled], self.offsets[1:][filled] - 1
        first[begin], last[end] = on[begin], on[end]
        starts = np.flatnonzero(first)
        return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, self.offsets)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each slice; slices of one length of up to 8 bytes never collide."""
        rest = ends - starts
        h = rest.astype(U) * K1
        if len(starts):
            h = (h ^ (self.lanes[starts] & MASK[np.minimum(rest, 8)]) * K2) * K1
            h ^= h >> U(29)
        more, at = np.flatnonzero(rest > 8), 8
        while len(more):
            v = self.lanes[starts[more] + at] & MASK[np.minimum(rest[more] - at, 8)]
            g = (h[more] ^ v * K2) * K1
            h[more] = g ^ (g >> U(29))
            at += 8
            more = more[rest[more] > at]
        return mix(h)


def same(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the slices of ``size`` bytes at ``at`` of lanes ``a`` and at ``bt`` of lanes ``b`` hold equal bytes."""
    if not len(at):
        return np.zeros(0, bool)
    out = ((a[at] ^ b[bt]) & MASK[np.minimum(size, 8)]) == 0
    more, k = np.flatnonzero(out & (size > 8)), 8
    while len(more):
        equal = ((a[at[more] + k] ^ b[bt[more] + k]) & MASK[np.minimum(size[more] - k, 8)]) == 0
        out[more] = equal
        k += 8
        more = more[equal]
        more = more[size[more] > k]
    return out


def within(bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices at which ``k`` items in a row lie in one group of ``bounds``, and the new bounds over them."""
    n = np.maximum(np.diff(bounds) - (k - 1), 0)
    new = np.concatenate([[0], np.cumsum(n)])
    return ragged(bounds[:-1], n), new


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... start + length - 1 of each, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def shingles(h: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``k`` words in a row from word hashes, and the bounds by document.

    A document of fewer words (but one at least) has its whole sequence as its only shingle.
    """
    at, new = within(bounds, k)
    s = np.zeros(len(at), U)
    for j in range(k):
        s = (s + h[at + j]) * K1
        s ^= s >> U(31)
    short = np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < k))
    if len(short):
        own = np.array([short_shingle(h[bounds[d] : bounds[d + 1]]) for d in short], U)
        s = np.insert(s, new[short], own)
        n = np.diff(new)
        n[short] = 1
        new = np.concatenate([[0], np.cumsum(n)])
    return mix(s), new


def short_shingle(h: np.ndarray) -> np.uint64:
    s = np.zeros(1, U) + U(len(h))
    for x in h:
        s = (s + x) * K1
        s ^= s >> U(31)
    return s[0]


def group_of(bounds: np.ndarray) -> np.ndarray:
    """The group index of each item."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of each group; 0 for an empty one."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]
