"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Pre-tokenisation runs no regex. Every code point maps to a class; a finite automaton over classes says where
a token begins. Its transition functions form a small monoid, so the state before every character follows
from an associative scan over monoid elements: blocks of characters are folded side by side, the block
results are scanned, and every block is replayed from its known start.

The slices between boundaries are hashed; a slice seen before, byte for byte, takes its ids from a cache, new ones are merged
pair by pair, lowest rank first and leftmost among equals, all new slices of a block together. Ids keep the
byte offset at which each token begins, and decoding is a table gather that needs no text.

Null and empty texts have no ids. Every row gives one row, also repeated ones; extra columns are ignored by
encode(). No shuffle.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from .common import arrow, id_text
from .vectext import U, Text, blocks, ragged, same, text_bytes

# Classes of characters.
LETTER, NUMBER, OTHER, SHORT, LONG, SPACES, LEAD, LONE, RESET = range(9)
# States after a character: between tokens, in a run of letters, numbers, others or white space, after a
# space that the next run takes in, inside a contraction with one or two characters to come.
END, IN_L, IN_N, IN_O, IN_S, JOIN, ONE, TWO = range(8)

@lru_cache(1)
def classes() -> np.ndarray:
    """LETTER, NUMBER, SPACES or OTHER of each code point, by the Unicode tables of the tiktoken library, whose version differs from Python's."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    out = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACES)):
        of_bytes = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        member = of_bytes.decode_bytes(of_bytes.encode_ordinary(every)).decode()
        out[np.frombuffer(member.encode("utf-32-le"), "<u4")] = kind
    return out


def step(state: int, kind: int) -> tuple[int, bool]:
    """The next state, and whether a token begins at the character."""
    if kind == RESET:
        return END, False
    if state == TWO:
        return ONE, False
    if state == ONE:
        return END, False
    run = {LETTER: IN_L, NUMBER: IN_N, OTHER: IN_O, SHORT: IN_O, LONG: IN_O, SPACES: IN_S}.get(kind)
    if state == JOIN:
        return run, False
    if kind == LEAD:
        return JOIN, True
    if kind == LONE:
        return END, True
    if run == state:
        return run, False
    return {SHORT: ONE, LONG: TWO}.get(kind, run), True


@lru_cache(1)
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The element of each class, the product table, the state each element leads to, and where tokens begin (state, class)."""
    begins = np.array([[step(s, k)[1] for k in range(9)] for s in range(8)])
    generators = [tuple(step(s, k)[0] or 0 for s in range(8)) for k in range(9)]
    elements = {tuple(range(8)): 0}
    for g in generators:
        elements.setdefault(g, len(elements))
    grown = True
    while grown:
        grown = False
        for f in list(elements):
            for g in generators:
                h = tuple(g[x] for x in f)
                if h not in elements:
                    elements[h] = len(elements)
                    grown = True
    listed = list(elements)
    product = np.array([[elements[tuple(g[x] for x in f)] for g in listed] for f in listed], np.uint16)
    return np.array([elements[g] for g in generators], np.uint16), product, np.array(listed, np.uint8), begins


def states_before(kinds: np.ndarray, width: int = 2048) -> np.ndarray:
    """The state before each character, by an associative scan from END."""
    of_class, product, leads, _ = monoid()
    n = len(kinds)
    count = -(-n // width) or 1
    padded = np.full(count * width, RESET, np.uint8)
    padded[:n] = kinds
    folded = np.ascontiguousarray(padded.reshape(count, width).T)
    m = of_class[folded]
    before = np.empty_like(m)
    acc = np.zeros(count, np.uint16)
    flat, size = product.reshape(-1), product.shape[1]
    for i in range(width):
        before[i] = acc
        acc = flat[acc.astype(np.int64) * size + m[i]]
    start, carry = np.zeros(count, np.int64), 0
    for b, a in enumerate(acc.tolist()):
        start[b] = carry
        carry = int(product[carry, a])
    state = leads[product[start[None, :], before], END]
    return state.T.reshape(-1)[:n]


def slices(text: Text) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets at which tokens begin in a block, and the index of each document's first one (one more than documents)."""
    buf = text.buf[: text.n]
    if not text.n:
        return np.zeros(0, np.int64), np.zeros(text.docs + 1, np.int64)
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    code = code_points(text.buf, lead)
    kind = classes()[code]
    # the characters of a document end where the next begins: look-ahead stops there
    bounds = np.searchsorted(lead, text.offsets)
    filled = np.diff(bounds) > 0
    last = np.zeros(len(lead), bool)
    last[bounds[1:][filled] - 1] = True
    ahead = np.full(len(lead), SPACES, np.uint8)
    ahead[:-1] = kind[1:]
    ahead[last] = SPACES
    space = kind == SPACES
    ends_run = space & (ahead != SPACES)
    out = kind.copy()
    out[ends_run] = np.where(code[ends_run] == 32, LEAD, LONE)
    quote = np.flatnonzero((code == 39) & ~last)
    one = code[quote + 1]
    out[quote[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
    quote = quote[~last[quote + 1]]
    pair = code[quote + 1] * 256 + code[quote + 2]
    out[quote[np.isin(pair, [ord(a) * 256 + ord(b) for a, b in ("re", "ve", "ll")])]] = LONG
    # a reset between documents: each document's characters follow one of its own
    docs = np.flatnonzero(filled)
    kinds = np.insert(out, bounds[docs], RESET)
    here = np.ones(len(kinds), bool)
    here[bounds[docs] + np.arange(len(docs))] = False
    begins = monoid()[3][states_before(kinds), kinds][here]
    starts = lead[begins]
    return starts, np.searchsorted(starts, text.offsets)


def code_points(buf: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """The code point of the UTF-8 sequence at each lead byte; ``buf`` is padded."""
    b = buf[lead].astype(np.int32)
    code = b.copy()
    for least, most, mask, more in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0x100, 0x07, 3)):
        at = np.flatnonzero((b >= least) & (b < most))
        if len(at):
            c = b[at] & mask
            for k in range(1, more + 1):
                c = c << 6 | (buf[lead[at] + k] & 0x3F)
            code[at] = c
    return code


class Ranks:
    """A rank file: bytes of each id, and the id that each mergeable pair of ids makes."""

    NONE = np.int32(1 << 30)

    def __init__(self, path: str):
        rows = [line.split() for line in open(path, "rb").read().splitlines() if line]
        self.bytes = {int(rank): base64.b64decode(token) for token, rank in rows}
        ids = {token: rank for rank, token in self.bytes.items()}
        self.single = np.array([ids[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ids.items():
            for k in range(1, len(token)):
                a, b = ids.get(token[:k]), ids.get(token[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.pairs = pairs
        self.bits = 22
        self.keys, self.made, self.probes = self.table(pairs)
        top = max(self.bytes) + 1
        self.sizes = np.zeros(top, np.int64)
        self.sizes[list(self.bytes)] = [len(x) for x in self.bytes.values()]
        self.at = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(self.bytes[i] for i in sorted(self.bytes)), np.uint8)

    def table(self, pairs: dict[int, int]) -> tuple[np.ndarray, np.ndarray, int]:
        """An open-addressed table; ``probes`` is its longest search."""
        size = 1 << self.bits
        keys, made, most = np.full(size + 64, -1, np.int64), np.full(size + 64, self.NONE, np.int32), 1
        for key, home in zip(pairs, self.home(np.array(list(pairs), np.int64)).tolist(), strict=True):
            at = home
            while keys[at] >= 0:
                at += 1
            keys[at], made[at] = key, pairs[key]
            most = max(most, at - home + 1)
        return keys, made, most

    def home(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(U) * U(0x9E3779B97F4A7C15)) >> U(64 - self.bits)).astype(np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The id that each pair makes, or NONE."""
        key = a.astype(np.int64) << 32 | b.astype(np.int64)
        at = self.home(key)
        out = np.where(self.keys[at] == key, self.made[at], self.NONE)
        for _ in range(1, self.probes):
            at = at + 1
            out = np.where(self.keys[at] == key, self.made[at], out)
        return out

    def merge_together(self, pieces: np.ndarray) -> np.ndarray:
        """Merges each row of ids (-1 beyond its end) to the end; one pair a round, lowest first, leftmost among equals."""
        done = pieces.copy()
        live = np.arange(len(pieces))
        ids = pieces
        while len(live) and ids.shape[1] > 1:
            pair = np.where(ids[:, 1:] >= 0, self.merged(np.maximum(ids[:, :-1], 0), np.maximum(ids[:, 1:], 0)), self.NONE)
            at = pair.argmin(axis=1)
            rank = pair[np.arange(len(ids)), at]
            ready = rank == self.NONE
            if ready.any():
                done[live[ready], : ids.shape[1]] = ids[ready]
                done[live[ready], ids.shape[1] :] = -1
                live, ids, at, rank = live[~ready], ids[~ready], at[~ready], rank[~ready]
                if not len(live):
                    break
            column = np.arange(ids.shape[1] - 1)[None, :]
            moved = np.take_along_axis(ids, column + (column > at[:, None]), axis=1)
            moved[np.arange(len(ids)), at] = rank
            ids = moved
        if len(live):
            done[live, : ids.shape[1]] = ids
            done[live, ids.shape[1] :] = -1
        return done

    def merge_one(self, piece: bytes) -> list[int]:
        """The same for one long slice, with a heap of its pairs."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        after, before, get = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1)), self.pairs.get
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if (r := get(a << 32 | b)) is not None]
        heapify(heap)
        while heap:
            rank, i, a, b = heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
                if (r := get(rank << 32 | ids[after[i]])) is not None:
                    heappush(heap, (r, i, rank, ids[after[i]]))
            if before[i] >= 0 and (r := get(ids[before[i]] << 32 | rank)) is not None:
                heappush(heap, (r, before[i], ids[before[i]], rank))
        return [x for x in ids if x >= 0]


class Shelf:
    """Slices by hash: the bytes and the ids of each, in flat arrays."""

    def __init__(self):
        self.at: dict[int, int] = {}
        self.start, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.ids, self.used = np.zeros(1 << 18, np.int32), 0
        self.begin, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.filled = 0
        self.hold(np.zeros(1 << 20, np.uint8))

    def hold(self, raw: np.ndarray) -> None:
        self.raw = raw
        self.lanes = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))

    def find(self, keys: list[int]) -> np.ndarray:
        """The place of each key, or -1."""
        get = self.at.get
        return np.fromiter((get(k, -1) for k in keys), np.int64, len(keys))

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.size[places].astype(np.int64)
        return sizes, self.ids[ragged(self.start[places], sizes)]

    def bytes(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.length[places].astype(np.int64)
        return lengths, self.raw[ragged(self.begin[places], lengths)]

    def holds(self, places: np.ndarray, text: Text, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether each place holds the very bytes of its slice of the text."""
        lengths = ends - starts
        out = self.length[places] == lengths
        at = np.flatnonzero(out)
        out[at] = same(text.lanes, starts[at], self.lanes, self.begin[places[at]], lengths[at])
        return out

    def add(self, keys: list[int], lengths: np.ndarray, raw: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The places of new keys."""
        n, m = len(self.at), len(keys)
        while n + m > len(self.start):
            self.start, self.size, self.begin, self.length = (np.resize(x, 2 * len(x)) for x in (self.start, self.size, self.begin, self.length))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        while self.filled + len(raw) + 8 > len(self.raw):
            self.hold(np.resize(self.raw, 2 * len(self.raw)))
        self.start[n : n + m] = self.used + np.cumsum(sizes) - sizes
        self.size[n : n + m] = sizes
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.begin[n : n + m] = self.filled + np.cumsum(lengths) - lengths
        self.length[n : n + m] = lengths
        self.raw[self.filled : self.filled + len(raw)] = raw
        self.filled += len(raw)
        self.at.update(zip(keys, range(n, n + m), strict=True))
        return np.arange(n, n + m)


class Cache:
    """Ids of slices in two generations of ``limit`` slices each: what is used again moves to the new one, so common slices stay.

    The hash of a slice only says where to look: what is held there counts if its bytes are those of the slice.
    Other slices, and those of more than LONGEST bytes, get their own ids.
    """

    LONGEST = 64

    def __init__(self, limit: int = 250_000):
        self.limit, self.new, self.old = limit, Shelf(), Shelf()

    def look(self, text: Text, starts: np.ndarray, ends: np.ndarray, make) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of all slices, in order. make(positions of slices) gives the sizes and ids of those that are not held."""
        short = np.flatnonzero(ends - starts <= self.LONGEST)
        place, held = np.zeros(len(starts), np.int64), np.zeros(len(starts), bool)
        if len(short):
            place[short] = self.places(text, starts[short], ends[short], lambda at: make(short[at]))
            held[short] = self.new.holds(place[short], text, starts[short], ends[short])
        if held.all():
            return self.new.take(place)
        odd, sizes = np.flatnonzero(~held), np.zeros(len(starts), np.int64)
        raw, first = memoryview(text.buf), {}
        of = np.array([first.setdefault(bytes(raw[a:b]), k) for k, (a, b) in enumerate(zip(starts[odd].tolist(), ends[odd].tolist(), strict=True))])
        own = np.unique(of)
        own_sizes, own_ids = make(odd[own])
        at = np.cumsum(own_sizes) - own_sizes
        which = np.searchsorted(own, of)
        known, known_ids = self.new.take(place[held])
        sizes[held], sizes[odd] = known, own_sizes[which]
        out, where = np.zeros(int(sizes.sum()), np.int32), np.cumsum(sizes) - sizes
        out[ragged(where[held], known)] = known_ids
        out[ragged(where[odd], sizes[odd])] = own_ids[ragged(at[which], sizes[odd])]
        return sizes, out

    def places(self, text: Text, starts: np.ndarray, ends: np.ndarray, make) -> np.ndarray:
        """The place of the hash of each slice, made for hashes not seen before."""
        keys, first, inverse = np.unique(text.hashes(starts, ends), return_index=True, return_inverse=True)
        if len(self.new.at) + len(keys) > self.limit:
            self.old, self.new = self.new, Shelf()
        listed = keys.tolist()
        place = self.new.find(listed)
        away = np.flatnonzero(place < 0)
        if len(away) and self.old.at:
            there = self.old.find(keys[away].tolist())
            again, old = away[there >= 0], there[there >= 0]
            place[again] = self.new.add(keys[again].tolist(), *self.old.bytes(old), *self.old.take(old))
            away = away[there < 0]
        if len(away):
            at = first[away]
            lengths = ends[at] - starts[at]
            place[away] = self.new.add(keys[away].tolist(), lengths, text.buf[ragged(starts[at], lengths)], *make(at))
        return place[inverse.reshape(-1)]


class Encoder:
    #: Slices of more bytes are merged one by one.
    LONGEST = 48

    def __init__(self, path: str):
        self.ranks, self.cache = Ranks(path), Cache()

    def merge(self, text: Text, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of slices, in order."""
        n = ends - starts
        sizes, parts = np.zeros(len(n), np.int64), []
        where = []
        for lo, hi in ((0, 4), (4, 8), (8, 12), (12, 20), (20, self.LONGEST)):
            own = np.flatnonzero((n > lo) & (n <= hi))
            if len(own):
                column = np.arange(hi)[None, :]
                at = np.minimum(starts[own][:, None] + column, text.n)
                ids = np.where(column < n[own][:, None], self.ranks.single[text.buf[at]], -1)
                ids = self.ranks.merge_together(ids)
                sizes[own] = (ids >= 0).sum(axis=1)
                parts.append(ids[ids >= 0])
                where.append(own)
        for i in np.flatnonzero(n > self.LONGEST).tolist():
            ids = self.ranks.merge_one(text.buf[starts[i] : ends[i]].tobytes())
            sizes[i] = len(ids)
            parts.append(np.array(ids, np.int32))
            where.append(np.array([i]))
        out = np.zeros(int(sizes.sum()), np.int32)
        at = np.cumsum(sizes) - sizes
        for own, ids in zip(where, parts, strict=True):
            out[ragged(at[own], sizes[own])] = ids
        return sizes, out

    def encode(self, text: Text) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a block, and the index of each document's first one (one more than documents)."""
        starts, bounds = slices(text)
        ends = np.append(starts[1:], text.n)
        sizes, ids = self.cache.look(text, starts, ends, lambda at: self.merge(text, starts[at], ends[at]))
        return ids, np.concatenate([[0], np.cumsum(sizes)])[bounds]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids."""
        return self.ranks.flat[ragged(self.ranks.at[ids], self.ranks.sizes[ids])]

    def offsets(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The byte offset in its document at which each id's bytes begin."""
        sizes = self.ranks.sizes[ids]
        at = np.cumsum(sizes) - sizes
        first = np.concatenate([at, [0]])[np.minimum(bounds[:-1], len(ids))]
        return at - np.repeat(first, np.diff(bounds))


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One encoder and cache for each worker process."""
    return Encoder(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ids, offsets (byte offset of each id's bytes in the text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for lo, hi in blocks(offsets):
                ids, bounds = own.encode(Text(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]))
                place = pa.array(bounds.astype(np.int32))
                columns = [batch.column(0)[lo:hi], pa.ListArray.from_arrays(place, pa.array(ids)), pa.ListArray.from_arrays(place, pa.array(own.offsets(ids, bounds).astype(np.int32)))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "offsets"])

    return arrow(id_text(docs, id_col, text_col), run, "doc_id long, ids array<int>, offsets array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """One row per row of ``encoded``: doc_id and the text of its ids; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            lists = batch.column(1).fill_null([]) if batch.column(1).null_count else batch.column(1)
            at = lists.offsets.to_numpy()
            ids = lists.values.to_numpy(zero_copy_only=False)
            texts = [own.decode(ids[a:b]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "text"])

    return arrow(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, and SHA-256 of its ids (little-endian unsigned 32-bit) and of the bytes they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for lo, hi in blocks(offsets):
                ids, bounds = own.encode(Text(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]))
                raw, decoded = ids.astype("<u4"), own.decode(ids)
                size = np.concatenate([[0], np.cumsum(own.ranks.sizes[ids])])[bounds]
                hashed = [[hashlib.sha256(x[a:b].data).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)] for x, at in ((raw, bounds), (decoded, size))]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(np.diff(bounds)), *map(pa.array, hashed)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return arrow(id_text(docs, id_col, text_col), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
