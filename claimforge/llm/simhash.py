"""Near-duplicates by SimHash and a byte-position inverted index with count filtering.

Fingerprints: A-Z in lower case, words ``[^\x20\x09-\x0D]+``, three-word shingles with repeats, XXH64 with
seed 42 of each, and a bit is 1 if it is set in over half the hashes. Fewer than three words make one
shingle of the whole sequence; no words, null included, make fingerprint zero, linked like any other.

Linking: fingerprints that differ in at most 2 of 64 bits differ in at most 2 of their 8 bytes, so they share at
least 6 positional bytes, the guaranteed minimum. Two such bytes leave two of the four byte pairs untouched, so the
inverted index has a posting for each two byte pairs of a fingerprint (four positional bytes, six postings). In
each list the positional bytes that a pair shares are tallied, pairs that reach the minimum are retained, and
the Hamming distance verifies them. Single positional bytes would make lists of 1/256 of the corpus.

Lists of over HEAVY fingerprints, counted beforehand, are never gathered: their members are indexed again by
two more positional bytes each. Six bytes leave 16 bits free, so such a list holds at most 65,536 fingerprints;
all pairs in it have the minimum, and links are found by the 137 values within two bits of each member, not by
pairs. A list yields a spanning forest of its links, at most one edge per member.

Components over distinct fingerprints follow by alternating stars, each round checkpointed; a node carries the
smallest id of its fingerprint and nodes are ordered by it, so the smallest node of a component names it. Joins
have plain exchanges on both sides, so Spark can split the rows of a common fingerprint or of a hub; nothing but
counts reaches the driver. Rows that repeat an id or a text are rows like any other; a null id takes part but
is the smallest id of no component (a component of null ids only has a null component_id). Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, cut, id_text
from .vectext import LOWER_TABLE, ragged, text_bytes

SEED, WORDS, DISTANCE = 42, 3, 2
#: Hashes unpacked to bits at a time, and pairs tallied at a time (a list at least).
HASHES, PAIRS = 1 << 16, 1 << 20
#: Longer lists are indexed again. Keys of such lists (16 bytes each) that are sent to all executors; more are joined.
HEAVY, SENT = 512, 1_000_000


def fingerprint(text: bytes) -> int:
    words = text.translate(LOWER_TABLE).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - WORDS + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(size)
    starts = (ends - size)[:n].tolist()
    ends = (ends - 1)[WORDS - 1 :].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for lo in range(0, n, HASHES):
        hi = min(n, lo + HASHES)
        h = np.fromiter([digest(joined[a:b], SEED) for a, b in zip(starts[lo:hi], ends[lo:hi], strict=True)], np.uint64, hi - lo)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keyed: bool = False) -> DataFrame:
    """doc_id and the fingerprint as a (signed) long; ``keyed``: also text_key, a hash of the text."""
    rows = id_text(docs, id_col, text_col)
    rows = rows.withColumn("text_key", F.xxhash64("text")) if keyed else rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            view = memoryview(data)
            out = np.array([fingerprint(bytes(view[a:b])) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64)), *batch.columns[2:]], ["doc_id", "fp", "text_key"][: batch.num_columns])

    return arrow(rows, run, "doc_id long, fp long" + ", text_key long" * keyed)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def masks(kept: list[tuple[int, ...]]) -> list[int]:
    """Bits of sets of byte positions."""
    return [signed(sum(255 << 8 * p for p in positions)) for positions in kept]


BYTE_PAIRS = [(0, 1), (2, 3), (4, 5), (6, 7)]
#: The four byte positions of each posting, and the six of each posting of a heavy list, which hold those four.
FOUR = [x + y for x, y in combinations(BYTE_PAIRS, 2)]
SIX = [[four + more for more in combinations([p for p in range(8) if p not in four], 2)] for four in FOUR]


def postings(fps: DataFrame) -> DataFrame:
    """The inverted index, a row for each posting: key (which byte positions, the bytes there), fp, least."""
    keys = [F.struct(F.lit(k).cast("byte").alias("which"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes")) for k, m in enumerate(masks(FOUR))]
    # a small table here becomes six times as large: dealt out first, by a key of its own, or the next exchange would undo it
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return fps.repartition(parts, F.xxhash64("fp")).select("fp", "least", F.explode(F.array(*keys)).alias("key"))


def near_masks() -> np.ndarray:
    """The 16-bit differences of one or two bits."""
    one = [1 << i for i in range(16)]
    return np.array(one + [a | b for a, b in combinations(one, 2)], np.int64)


def settled(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest position that each position reaches over the pairs (left, right)."""
    while True:
        new = label.copy()
        np.minimum.at(new, left, label[right])
        np.minimum.at(new, right, label[left])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def tallied(fps: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each member of some lists, a member that it is connected to: shared positional bytes of pairs are tallied, those that reach the minimum verified."""
    label, at = np.arange(len(fps)), fps.view(np.uint8).reshape(-1, 8)
    n = np.diff(offsets)
    done, lo = np.concatenate([[0], np.cumsum(n * (n - 1) // 2)]), 0
    while lo < len(n):
        hi = max(lo + 1, int(np.searchsorted(done, done[lo] + PAIRS, "right")) - 1)
        own = np.arange(offsets[lo], offsets[hi])
        after = np.repeat(offsets[lo + 1 : hi + 1], n[lo:hi]) - 1 - own
        left, right = np.repeat(own, after), ragged(own + 1, after)
        shared = np.zeros(len(left), np.uint8)
        for p in range(8):
            shared += at[left, p] == at[right, p]
        enough = shared >= 8 - DISTANCE
        left, right = left[enough], right[enough]
        near = np.bitwise_count(fps[left] ^ fps[right]) <= DISTANCE
        label = settled(label, left[near], right[near])
        lo = hi
    return label


def flipped(fps: np.ndarray, near: np.ndarray) -> np.ndarray:
    """tallied() of one list whose members share six positional bytes, by flipping the bits that are left."""
    spread = int(np.bitwise_or.reduce(fps ^ fps[0]))
    free = [p for p in range(8) if spread >> 8 * p & 255]
    rest = sum((((fps >> np.uint64(8 * p)) & np.uint64(255)).astype(np.int64) << 8 * j for j, p in enumerate(free)), np.zeros(len(fps), np.int64))
    place = np.full(1 << 16, -1, np.int64)
    place[rest] = np.arange(len(fps))
    label = np.arange(len(fps))
    while True:
        new = label.copy()
        for m in near:
            at = place[rest ^ m]
            ok = at >= 0
            new[ok] = np.minimum(new[ok], label[at[ok]])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def linked(lists: DataFrame, six: bool) -> DataFrame:
    """Edges that connect what is linked within each list of (fp, least)."""
    near = near_masks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            members, offsets = column.flatten(), column.offsets.to_numpy() - column.offsets[0].as_py()
            fps = members.field("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            offsets = offsets.astype(np.int64)
            label = np.concatenate([a + flipped(fps[a:b], near) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]) if six else tallied(fps, offsets)
            moved = np.flatnonzero(label != np.arange(len(fps)))
            if len(moved):
                a, b = members.take(pa.array(moved)), members.take(pa.array(label[moved]))
                yield pa.RecordBatch.from_arrays([a.field("fp"), a.field("least"), b.field("fp"), b.field("least")], ["fp", "least", "fp2", "least2"])

    found = arrow(lists, run, "fp long, least long, fp2 long, least2 long")
    node = lambda fp, least: F.struct(F.col(least).isNull().alias("none"), F.coalesce(least, F.lit(0)).alias("id"), F.col(fp).alias("fp"))
    a, b = node("fp", "least"), node("fp2", "least2")
    return found.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) of nodes (none, id, fp) whose components are those of all links. ``fps``: distinct fp, and least, the smallest id of each or null."""
    index = postings(fps)
    heavy = cut(index.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > HEAVY).select("key"))
    n = heavy.count()
    member = lambda: F.struct("fp", "least")
    if not n:
        return linked(index.groupBy("key").agg(F.collect_list(member()).alias("m")).filter(F.size("m") > 1).select("m"), False).distinct()
    heavy = F.broadcast(heavy) if n <= SENT else heavy
    light = index.join(heavy, "key", "left_anti").groupBy("key").agg(F.collect_list(member()).alias("m")).filter(F.size("m") > 1).select("m")
    more = F.array(*(F.array(*map(F.lit, masks(six))) for six in SIX))
    keys = F.transform(F.get(more, F.col("key.which").cast("int")), lambda m: F.struct(m.alias("mask"), F.col("fp").bitwiseAND(m).alias("bytes")))
    again = index.join(heavy, "key", "left_semi").select("fp", "least", F.explode(keys).alias("key"))
    full = again.groupBy("key").agg(F.collect_set(member()).alias("m")).filter(F.size("m") > 1).select("m")
    return linked(light, False).union(linked(full, True)).distinct()


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, root) of every node with an edge but the roots; root is the smallest node of its component.

    ``edges`` holds distinct (a, b) with a > b. Alternating large and small stars, until a round changes
    nothing; the number of rounds grows with the logarithm of the number of nodes, and ``rounds`` is an alarm.
    """
    edges = cut(edges)
    state = None
    for _ in range(rounds):
        both = edges.union(edges.select("b", "a"))
        least = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = cut(both.join(least, "a").filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = cut(large.groupBy("a").agg(F.min("b").alias("m")))
        near = large.join(least, "a")
        small = near.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        edges = cut(small.filter("a <> b").distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def grouped(own: DataFrame) -> DataFrame:
    """The rows of fingerprints() with component_id and root, the fingerprint that names the component (also one without ids)."""
    own = cut(own)
    least = cut(own.groupBy("fp").agg(F.min("doc_id").alias("least")))
    stars = components(links(least)).select(F.col("node.fp").alias("linked_fp"), "root")
    named = F.when(F.col("root").isNull(), F.col("least")).when(~F.col("root.none"), F.col("root.id"))
    # cut, so that both sides of the last join are plain exchanges, and Spark can split a common fingerprint's rows
    ids = cut(least.join(stars, least.fp == stars.linked_fp, "left").select("fp", named.alias("component_id"), F.coalesce("root.fp", "fp").alias("root")))
    return own.join(ids, "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fp (long), component_id (smallest doc_id reachable over links, itself included)."""
    return grouped(fingerprints(docs, id_col, text_col)).select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame) -> DataFrame:
    """One document of each group, all its columns: the smallest id, a null one last, then the smallest hash of the text.

    Rows that repeat an id and a text count as one; which one's other columns stay is open.
    """
    none, number = F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0))
    rows = grouped(fingerprints(docs, keyed=True)).select("root", F.struct(none.alias("kept_none"), number.alias("kept_id"), F.col("text_key").alias("kept_key")).alias("row"))
    kept = rows.groupBy("root").agg(F.min("row").alias("row")).select("row.*")
    long = docs["doc_id"].cast("long")
    # plain keys, so that the join's exchange also serves what drops repeats
    marked = docs.select("*", long.isNull().alias("__none"), F.coalesce(long, F.lit(0)).alias("__id"), F.xxhash64(docs["text"].cast("string")).alias("__key"))
    there = marked.join(kept, (marked["__none"] == kept.kept_none) & (marked["__id"] == kept.kept_id) & (marked["__key"] == kept.kept_key), "left_semi")
    return there.dropDuplicates(["__none", "__id", "__key"]).drop("__none", "__id", "__key")
