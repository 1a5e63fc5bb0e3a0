"""Token ids in a binary store: frequency-ranked, variable-length, with separate control bytes.

Texts are tokenized once and written as a table in the shared folder. Ids are ranked by their count over the
whole corpus, so the commonest 256 take one byte each. The store is a folder of Parquet files whose rows are
blocks: a stream of control bytes (two bits a value, its byte length less one) and a stream of value bytes,
little-endian, beside the document ids and the coded token counts. Parquet is the container only (no further
compression): it gives the blocks Spark's commit protocol, so a lost executor leaves no half-written shard,
and any file system that Spark reaches. Documents stand in ascending id order over shards, blocks and rows.
Decoding expands control bytes by a table of 256 entries and gathers all values of a block at once.

Null and empty texts have the end id alone. Null ids come first; rows that repeat an id stand side by side,
ordered by their tokens. Extra columns are ignored. An empty table gives an empty store.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .byte_bpe import Cache
from .common import arrow, discard, id_text, scratch, written
from .vectext import MASK, WHITE, Text, blocks, text_bytes

END_ID = 1
#: Tokens of a block, and bytes of a shard's tokens (two each), at least one document.
BLOCK_TOKENS, SHARD_BYTES = 1 << 20, 64 << 20
#: Rows of the table of shards (12 bytes each) that are sent to all executors; more are joined.
SHARDS_SENT = 1_000_000

FINAL, PLAIN = np.zeros(256, bool), np.zeros(256, bool)
FINAL[list(b".,;:!?)")] = True
PLAIN[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True

#: Byte lengths of the four values of each control byte.
LENGTHS = np.array([[1 + (c >> 2 * k & 3) for k in range(4)] for c in range(256)], np.uint8)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and value bytes of unsigned 32-bit values."""
    v = values.astype("<u4")
    code = (v >= 1 << 8).astype(np.uint8) + (v >= 1 << 16) + (v >= 1 << 24)
    padded = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    padded[: len(v)] = code
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    return control.tobytes(), v.view(np.uint8).reshape(-1, 4)[np.arange(4)[None, :] <= code[:, None]].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of pack()."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n].astype(np.int64)
    padded = np.frombuffer(data + b"\0" * 8, np.uint8)
    lanes = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    return (lanes[np.cumsum(size) - size] & MASK[size]).astype(np.uint32)


def cut_at(text: Text, at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """words(), cut where one of the given slices begins or ends; the slices lie apart, within documents."""
    on = ~WHITE[text.buf[: text.n]]
    first, last = on.copy(), on.copy()
    first[1:] &= ~on[:-1]
    last[:-1] &= ~on[1:]
    edges = np.concatenate([text.offsets[:-1], at, ends])
    edges = edges[edges < text.n]
    first[edges] = on[edges]
    edges = np.concatenate([text.offsets[1:], at, ends]) - 1
    edges = edges[edges >= 0]
    last[edges] = on[edges]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, text.offsets)


def pieces(text: Text, special: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, with a final mark after an ASCII letter or digit as a piece of its own: no token spans the two.

    ``special``: start and end of slices that are pieces as they are; words end there.
    """
    starts, ends, bounds = text.words() if special is None else cut_at(text, *special)
    marked = (ends - starts > 1) & FINAL[text.buf[ends - 1]] & PLAIN[text.buf[ends - 2]]
    if special is not None:
        marked &= ~np.isin(starts, special[0])
    k = np.flatnonzero(marked)
    cut = ends.copy()
    cut[k] -= 1
    return np.insert(starts, k + 1, ends[k] - 1), np.insert(cut, k + 1, ends[k]), bounds + np.searchsorted(k, bounds)


class Tokenizer:
    """Ids by the tokenizers library, for each distinct piece once.

    The vocabulary's pre-tokenizer never joins pieces, and its normalizer lower-cases, so pieces are looked up with
    A-Z in lower case. Strings of the vocabulary's special tokens are found in the text as it is, case and all, and
    get their own ids, as by the library's plain call; what lower-casing makes equal to them is ordinary text.
    """

    #: Pieces that a worker remembers, in each of two generations.
    REMEMBERED = 700_000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        self.inner = tokenizers.Tokenizer.from_file(path)
        self.inner.encode_special_tokens = True  # the pieces hold none
        self.lower = self.inner.normalizer is not None and self.inner.normalizer.normalize_str("AZ") == "az"
        self.special = {t.content.encode(): i for i, t in self.inner.get_added_tokens_decoder().items() if t.special}
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip or not t.special for t in self.inner.get_added_tokens_decoder().values()):
            raise ValueError("added tokens that depend on what stands around them are not read")
        self.any = re.compile(b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.cache = Cache(self.REMEMBERED)

    def find_special(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Start, end and id of the special tokens' strings, leftmost first, within documents; None where there are none."""
        raw = data.tobytes()
        if self.any is None or not self.any.search(raw):
            return None
        found = [(m.start(), m.end(), self.special[m[0]]) for m in self.any.finditer(raw)]
        at, ends, ids = (np.array(x, np.int64) for x in zip(*found, strict=True))
        apart = np.searchsorted(offsets, at, "right") == np.searchsorted(offsets, ends, "left")
        return at[apart], ends[apart], ids[apart]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a block of texts, and the index of each document's first one (one more than documents)."""
        text, special = Text(data, offsets, lower=self.lower), self.find_special(data, offsets)
        starts, ends, bounds = pieces(text) if special is None else pieces(text, special[:2])

        def make(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            raw = memoryview(text.buf)
            words = [str(raw[a:b], "utf-8") for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
            found = [x.ids for x in self.inner.encode_batch_fast(words, add_special_tokens=False)]
            return np.fromiter(map(len, found), np.int64, len(found)), np.array([i for x in found for i in x], np.int32)

        sizes, ids = self.cache.look(text, starts, ends, make)
        if special is not None:
            at = np.searchsorted(starts, special[0])
            keep = np.ones(len(starts), bool)
            keep[at] = False
            ids = np.insert(ids[np.repeat(keep, sizes)], (np.cumsum(sizes * keep) - sizes * keep)[at], special[2])
            sizes = np.where(keep, sizes, 1)
        return ids, np.concatenate([[0], np.cumsum(sizes)])[bounds]


@lru_cache(2)
def tokenizer(path: str) -> Tokenizer:
    """One for each worker process."""
    return Tokenizer(path)


def tokenize(docs: DataFrame, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the ids as little-endian unsigned 32-bit integers, or 16-bit ones where the vocabulary allows, end id included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        kind = width(own.inner.get_vocab_size(), end_id)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for lo, hi in blocks(offsets):
                ids, bounds = own.encode(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                ids = np.insert(ids, bounds[1:], end_id).astype(kind)
                bounds = bounds + np.arange(len(bounds))
                raw = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer((bounds * ids.itemsize).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], raw], ["doc_id", "ids"])

    return arrow(id_text(docs, id_col, text_col), run, "doc_id long, ids binary")


def width(vocabulary: int, end_id: int) -> str:
    return "<u2" if max(vocabulary - 1, end_id) < 1 << 16 else "<u4"


def ranks(tokens: DataFrame, vocabulary: int, kind: str) -> np.ndarray:
    """The id of each rank: commonest first, then by id. Counts cover all tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(vocabulary, np.int64)
        for batch in batches:
            n += np.bincount(text_bytes(batch.column(0))[0].view(kind), minlength=vocabulary)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], ["id", "n"])

    rows = arrow(tokens.select("ids"), run, "id long, n long").groupBy("id").agg(F.sum("n")).toArrow()
    n = np.zeros(vocabulary, np.int64)
    n[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return np.lexsort((np.arange(vocabulary), -n))


BLOCK_SCHEMA = "shard int, block int, tokens_before long, n_tokens long, doc_ids array<long>, size_control binary, size_data binary, control binary, data binary"


def write(docs: DataFrame, tokenizer_path: str, store: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the store: ``store``/blocks, ``store``/ranks and ``store``/shards (the index of each shard's first token)."""
    import tokenizers

    spark = docs.sparkSession
    size = max(tokenizers.Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1)
    kind = width(size, end_id)
    raw_ids = scratch(spark, "tokens")
    tokens = written(tokenize(docs, tokenizer_path, end_id, id_col, text_col), raw_ids)
    of_rank = ranks(tokens, size, kind)
    spark.createDataFrame([(k, int(i)) for k, i in enumerate(of_rank)], "rank int, id int").coalesce(1).write.parquet(f"{store}/ranks")
    rank = np.empty(size, np.uint32)
    rank[of_rank] = np.arange(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            at = offsets // np.dtype(kind).itemsize
            for lo, hi in blocks(at, BLOCK_TOKENS):
                ids = rank[data[offsets[lo] : offsets[hi]].view(kind)]
                row = [shard, block, before, len(ids), batch.column(0)[lo:hi].to_pylist(), *pack(np.diff(at[lo : hi + 1])), *pack(ids)]
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, BLOCK_TYPES, strict=True)], BLOCK_NAMES)
                block, before = block + 1, before + len(ids)

    total = tokens.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_BYTES))
    ordered = tokens.withColumn("tie", F.xxhash64("ids")).repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    arrow(ordered, run, BLOCK_SCHEMA).write.option("compression", "none").parquet(f"{store}/blocks")
    discard(spark, raw_ids)
    sizes = spark.read.parquet(f"{store}/blocks").groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    sizes.select("shard", F.coalesce(before, F.lit(0)).alias("base")).coalesce(1).write.parquet(f"{store}/shards")


BLOCK_NAMES = [x.split()[0] for x in BLOCK_SCHEMA.split(", ")]
BLOCK_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.binary()]


def decoded(spark: SparkSession, store: str, function, schema: str) -> DataFrame:
    """function(ids of a block as uint32, sizes of its documents, document ids, index of its first token in the corpus) by block."""
    found = spark.read.parquet(f"{store}/blocks")
    of_rank = spark.read.parquet(f"{store}/ranks").toArrow()
    table = np.zeros(of_rank.num_rows, np.uint32)
    table[of_rank.column(0).to_numpy()] = of_rank.column(1).to_numpy()
    bases = spark.read.parquet(f"{store}/shards")
    bases = F.broadcast(bases) if bases.count() <= SHARDS_SENT else bases
    found = found.join(bases, "shard").withColumn("tokens_before", F.col("tokens_before") + F.col("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                sizes = unpack(r["size_control"], r["size_data"], len(r["doc_ids"])).astype(np.int64)
                ids = table[unpack(r["control"], r["data"], r["n_tokens"])]
                yield function(ids, sizes, r["doc_ids"], r["tokens_before"])

    return arrow(found.select(*BLOCK_NAMES), run, schema)


def read(spark: SparkSession, store: str) -> DataFrame:
    """doc_id, start (tokens of all documents before it) and ids of each document of a store."""

    def rows(ids: np.ndarray, sizes: np.ndarray, docs: list, start: int) -> pa.RecordBatch:
        ends = np.cumsum(sizes)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(start + ends - sizes), lists], ["doc_id", "start", "ids"])

    return decoded(spark, store, rows, "doc_id long, start long, ids array<long>")


def digests(spark: SparkSession, store: str) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids, of each document of a store."""

    def rows(ids: np.ndarray, sizes: np.ndarray, docs: list, start: int) -> pa.RecordBatch:
        ends = np.cumsum(sizes)
        raw = memoryview(ids.astype("<u4").tobytes())
        crc = [zlib.crc32(raw[4 * (b - n) : 4 * b]) for b, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(start + ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return decoded(spark, store, rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def new_store(spark: SparkSession) -> str:
    """A folder for a store that lasts as long as the application."""
    return scratch(spark, "token-store")
