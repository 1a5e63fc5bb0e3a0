"""Benchmark decontamination by size-partitioned MinHash containment search.

Short test items are searched inside long documents. A document's shingles are cut into windows, so that no
indexed set is larger than ``window`` shingles however long the document is; items are partitioned by size.
An item of q shingles of which t*q occur in a document meets its windows of at most u shingles in Jaccard
similarities that sum to t*q / (u + q) or more, even where the shared shingles are spread over windows. The
number of hash functions of each size class follows from that and ``miss``, the bound on the chance to
overlook a pair under independent functions (ours are multiply-shift functions of a 64-bit hash). Every
candidate is then verified on the exact five-word shingle strings of the whole document, so false ones don't matter.

Memory and scans: the sizes of the whole benchmark are counted by Spark and give one plan of windows and hash
functions. The benchmark itself is held in blocks of at most ``block_bytes`` of text and ENTRIES minima; the driver
builds and sends one block after the other, and a worker holds one block at a time (a single one stays). All
blocks are searched in one scan of the documents, whose minima are computed once. Documents are never shuffled.

Words are ``[^\x20\x09-\x0D]+`` with A-Z in lower case. A text of fewer than five words has its whole sequence
as its only shingle; null, empty and blank texts have none, match nothing and are matched by nothing. Every
document row and every item row gives its own pairs, also repeated ones. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, id_text
from .vectext import LOWER_TABLE, Text, U, blocks, ragged, shingles, text_bytes

WORDS, THRESHOLD, MISS, BLOCK_BYTES = 5, 0.8, 1e-7, 16 << 20
#: Minima in a block of the benchmark (12 bytes each), and items whose shingle strings a worker remembers.
ENTRIES, REMEMBERED = 4_000_000, 10_000


def exact(text: str) -> set[bytes]:
    """The shingle strings of a text."""
    w = text.encode().translate(LOWER_TABLE).split()
    return {b" ".join(w[i : i + WORDS]) for i in range(max(1, len(w) - WORDS + 1))} if w else set()


def needed(q: int, window: int, threshold: float, miss: float) -> int:
    """Hash functions that find an item of q shingles in windows of that many, but for a chance of ``miss``."""
    return math.ceil(-math.log(miss) * (window + q) / math.ceil(threshold * q))


@dataclass
class Plan:
    """Windows of documents, hash functions of each size class, and how many blocks the benchmark makes."""

    window: int
    rows: dict[int, int]
    factors: np.ndarray
    n_blocks: int

    @staticmethod
    def of(classes: list[tuple[int, int, int, int]], threshold: float, miss: float, block_bytes: int) -> Plan:
        """``classes``: (bits of the size, smallest size, items, bytes of text) of each size class."""
        window = max(8, 1 << min((c for c, *_ in classes), default=3))
        rows = {c: needed(q, window, threshold, miss) for c, q, _, _ in classes}
        entries, size = sum(rows[c] * n for c, _, n, _ in classes), sum(x for *_, x in classes)
        factors = np.random.default_rng(20).integers(0, 1 << 63, max(rows.values(), default=1), dtype=np.uint64) * U(2) + U(1)
        return Plan(window, rows, factors, max(1, -(-size // block_bytes), -(-entries // ENTRIES)))

    def minima(self, h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The minimum of each window under each function, and the windows' documents."""
        n = -(-np.diff(bounds) // self.window)
        starts = np.repeat(bounds[:-1], n) + (ragged(np.zeros(len(n), np.int64), n) * self.window)
        least = np.empty((len(self.factors), len(starts)), np.uint64)
        for j, a in enumerate(self.factors if len(starts) else ()):
            least[j] = np.minimum.reduceat(h * a, starts)
        return least, np.repeat(np.arange(len(n)), n)


@dataclass
class Index:
    """A block of items: sorted minima under each function, a filter of their bits, the item of each; texts for the verification."""

    values: list[np.ndarray]
    filters: list[np.ndarray]
    items: list[np.ndarray]
    texts: list[str]
    ids: list[int | None]
    remembered: dict[int, list[tuple[int, bytes]]] = field(default_factory=dict)

    @staticmethod
    def build(plan: Plan, ids: list[int | None], texts: list[str]) -> Index:
        data, offsets = text_bytes(pa.array(texts, pa.large_string()))
        h, bounds, *_ = of_words(Text(data, offsets, lower=True))
        filled = np.flatnonzero(np.diff(bounds))
        starts = bounds[:-1][filled]
        sizes = np.array([len(exact(texts[i])).bit_length() for i in filled.tolist()], np.int64)
        rows = np.array([plan.rows[c] for c in sizes.tolist()], np.int64)
        values, filters, items = [], [], []
        for j, a in enumerate(plan.factors):
            own = np.flatnonzero(rows > j)
            least = np.minimum.reduceat(h * a, starts)[own] if len(own) else np.zeros(0, np.uint64)
            order = np.argsort(least, kind="stable")
            seen = np.zeros(1 << 16, bool)
            seen[least >> U(48)] = True
            values.append(least[order]), filters.append(np.packbits(seen)), items.append(filled[own][order].astype(np.int32))
        return Index(values, filters, items, texts, ids)

    def candidates(self, least: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, item) that share a minimum, by document."""
        found = [np.zeros((2, 0), np.int64)]
        for low, values, seen, items in zip(least, self.values, self.filters, self.items, strict=True):
            maybe = np.flatnonzero(np.unpackbits(seen).view(bool)[low >> U(48)])
            a, b = np.searchsorted(values, low[maybe], "left"), np.searchsorted(values, low[maybe], "right")
            hit = np.flatnonzero(b > a)
            if len(hit):
                n = (b - a)[hit]
                found.append(np.unique(np.stack([np.repeat(doc[maybe[hit]], n), items[ragged(a[hit], n)].astype(np.int64)]), axis=1))
        return tuple(np.unique(np.concatenate(found, axis=1), axis=1))

    def shingles(self, item: int) -> list[tuple[int, bytes]]:
        """Hash and string of each distinct shingle of an item."""
        if item not in self.remembered:
            if len(self.remembered) >= REMEMBERED:
                self.remembered.clear()
            own = Words(self.texts[item].encode())
            self.remembered[item] = list({own.string(k): (int(x), own.string(k)) for k, x in enumerate(own.h)}.values())
        return self.remembered[item]


def of_words(text: Text) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the five-word shingles and their bounds by document; start and end of the words and their bounds."""
    starts, ends, bounds = text.words()
    return *shingles(text.hashes(starts, ends), bounds, WORDS), starts, ends, bounds


class Words:
    """The shingles of one text."""

    def __init__(self, raw: bytes):
        self.text = Text(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), lower=True)
        self.h, _, self.starts, self.ends, _ = of_words(self.text)
        self.order = np.argsort(self.h, kind="stable")
        self.sorted = self.h[self.order]

    def string(self, k: int) -> bytes:
        last = min(k + WORDS, len(self.starts)) - 1
        return b" ".join(self.text.buf[self.starts[k] : self.ends[last]].tobytes().split())

    def holds(self, h: int, string: bytes) -> bool:
        """Whether a shingle is this string; its hash says where to look."""
        at = int(np.searchsorted(self.sorted, U(h)))
        while at < len(self.sorted) and int(self.sorted[at]) == h:
            if self.string(int(self.order[at])) == string:
                return True
            at += 1
        return False


def plan_of(items: DataFrame, threshold: float, miss: float, block_bytes: int) -> Plan:
    """The plan of the whole benchmark, from one row for each size class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            rows = [(len(exact(x)), len(x.encode())) for x in texts]
            yield pa.RecordBatch.from_arrays([pa.array([q.bit_length() for q, _ in rows], pa.int32()), *(pa.array(list(x), pa.int64()) for x in zip(*rows, strict=True))] if rows else [pa.array([], t) for t in (pa.int32(), pa.int64(), pa.int64())], ["c", "q", "size"])

    found = arrow(items.select("text"), run, "c int, q long, size long").filter("q > 0").groupBy("c").agg(F.min("q"), F.count("*"), F.sum("size"))
    return Plan.of([tuple(r) for r in found.collect()], threshold, miss, block_bytes)


def sent(items: DataFrame, plan: Plan) -> Iterator[Broadcast]:
    """The blocks of the benchmark, each built on the driver and sent to the executors before the next."""
    for k in range(plan.n_blocks):
        rows = items.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(plan.n_blocks)) == k).toArrow()
        if rows.num_rows:
            yield items.sparkSession.sparkContext.broadcast(Index.build(plan, rows.column(0).to_pylist(), rows.column(1).to_pylist()))


def verified(plan: Plan, held: list, data: np.ndarray, offsets: np.ndarray, threshold: float, every: bool = True) -> Iterator[tuple[int, int | None, int, int]]:
    """Document position, item id, shared shingles and shingles of the item, for every pair that reaches the threshold (else: for one pair of a document at least).

    ``held``: broadcast blocks. Where there are several, a worker lets each go before it reads the next.
    """
    for lo, hi in blocks(offsets):
        part, inner = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        h, bounds, *_ = of_words(Text(part, inner, lower=True))
        least, owner = plan.minima(h, bounds)
        done: set[int] = set()
        for block in held:
            index, last, own = block.value, -1, None
            for d, i in zip(*(x.tolist() for x in index.candidates(least, owner)), strict=True):
                if d in done:
                    continue
                if d != last:
                    last, own = d, Words(part[inner[d] : inner[d + 1]].tobytes())
                wanted = index.shingles(i)
                shared = sum(own.holds(x, s) for x, s in wanted)
                if shared >= threshold * len(wanted) - 1e-9:
                    yield lo + d, index.ids[i], shared, len(wanted)
                    if not every:
                        done.add(d)
            if len(held) > 1:
                del index, block._value  # read again from the executor's copy


def prepared(benchmark: DataFrame, threshold: float, miss: float, block_bytes: int, item_col: str, text_col: str) -> tuple[Plan, list[Broadcast]]:
    items = id_text(benchmark, item_col, text_col).dropna(subset=["text"])
    plan = plan_of(items, threshold, miss, block_bytes)
    return plan, list(sent(items, plan))


def search(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, miss: float = MISS, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Every pair (doc_id, item_id) with containment of the item in the document of at least ``threshold``.

    An item whose id is null is searched like any other; its pairs have a null item_id.
    """
    plan, held = prepared(benchmark, threshold, miss, block_bytes, item_col, item_text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(verified(plan, held, *text_bytes(batch.column(1)), threshold))
            if found:
                d, ids, shared, n = (list(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(d)), *(pa.array(x, pa.int64()) for x in (ids, shared, n))], ["doc_id", "item_id", "n_shared", "n_item"])

    return arrow(id_text(docs, id_col, text_col), run, "doc_id long, item_id long, n_shared long, n_item long")


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, miss: float = MISS, block_bytes: int = BLOCK_BYTES, text_col: str = "text") -> DataFrame:
    """The documents, all their columns, that contain no item. Rows and items with null ids are judged like any other."""
    plan, held = prepared(benchmark, threshold, miss, block_bytes, "item_id", "text")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for d, *_ in verified(plan, held, *text_bytes(batch.column(at)), threshold, every=False):
                keep[d] = False
            yield batch.filter(pa.array(keep))

    return arrow(docs, run, docs.schema)
