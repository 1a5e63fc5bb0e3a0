"""Quality by importance resampling.

Two generative models over hashed word n-grams (unigrams and bigrams), one of a target and one of all raw
text, give every document a log importance weight: the sum over its n-grams of log p_target - log p_raw.
Adding Gumbel noise to the weights and keeping the k largest draws k documents without replacement in
proportion to their weights.

The raw model counts every document; the target model counts the documents whose label is 1 within a bounded
hash sample of labelled rows. Both are tables of ``buckets`` counts, whatever the corpus size. The noise of
a document depends on its id and the seed alone, so the sample does not depend on partitioning.

Null and empty texts have no n-grams and weight 0. Rows with the same id share their noise; rows equal in
key and id share their fate, so repeated rows may exceed k. An empty table gives an empty result. Without
target documents the models are equal and all weights 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, cut, id_text, kth_largest, label_rows, label_sample
from .vectext import K1, U, Text, blocks, mix, sums, text_bytes, within

BUCKETS = 1 << 16


def ngrams(text: Text, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and bounds of the unigrams, then of the bigrams, of a block."""
    starts, ends, bounds = text.words()
    h = text.hashes(starts, ends)
    at, pairs = within(bounds, 2)
    two = mix(h[at] * K1 + h[at + 1])
    return (h % U(buckets)).astype(np.int64), bounds, (two % U(buckets)).astype(np.int64), pairs


def count_models(docs: DataFrame, labels: DataFrame, buckets: int, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts by bucket over all raw text, and over the target's documents."""
    sample = label_sample(labels, "quality", bound).filter("label = 1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            wanted = np.array(batch.column(1).is_valid())
            for lo, hi in blocks(offsets):
                text = Text(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], lower=True)
                one, b1, two, b2 = ngrams(text, buckets)
                raw += np.bincount(one, minlength=buckets) + np.bincount(two, minlength=buckets)
                own = wanted[lo:hi]
                target += np.bincount(one[np.repeat(own, np.diff(b1))], minlength=buckets) + np.bincount(two[np.repeat(own, np.diff(b2))], minlength=buckets)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])], ["bucket", "raw", "target"])

    marked = id_text(docs).join(F.broadcast(sample), "doc_id", "left").select("text", "label")
    rows = arrow(marked, run, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw"), F.sum("target")).toArrow()
    out = np.zeros((2, buckets), np.int64)
    out[:, rows.column(0).to_numpy()] = rows.column(1).to_numpy(), rows.column(2).to_numpy()
    return out[0], out[1]


def log_ratio(raw: np.ndarray, target: np.ndarray, prior: float = 1.0) -> np.ndarray:
    """log p_target - log p_raw of each bucket; ``prior`` raw-shaped pseudo-counts per bucket smooth the target."""
    p = (raw + 1e-9) / (raw.sum() + 1e-9 * len(raw))
    q = (target + prior * len(raw) * p) / (target.sum() + prior * len(raw))
    return np.log(q / p)


def gumbel(ids: np.ndarray, seed: int) -> np.ndarray:
    u = (mix(ids.astype(np.int64).view(U) ^ mix(np.full(1, seed, U))) >> U(11)).astype(float)
    return -np.log(-np.log((u + 0.5) / (1 << 53)))


def weigh(docs: DataFrame, ratio: np.ndarray, seed: int) -> DataFrame:
    """doc_id, n_ngrams, log_weight, gumbel_key and the key as an order-preserving long."""
    buckets = len(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            ids = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
            n, weight = [], []
            for lo, hi in blocks(offsets):
                text = Text(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], lower=True)
                one, b1, two, b2 = ngrams(text, buckets)
                n.append(np.diff(b1) + np.diff(b2))
                weight.append(sums(ratio[one], b1) + sums(ratio[two], b2))
            n, weight = np.concatenate(n or [np.zeros(0, np.int64)]), np.concatenate(weight or [np.zeros(0)])
            # running sums leave rounding that depends on the block; rounded off, results don't depend on it
            weight = np.round(weight, 6) + 0.0
            key = weight + gumbel(ids, seed)
            bits = key.view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(weight), pa.array(key), pa.array(np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits))], ["doc_id", "n_ngrams", "log_weight", "gumbel_key", "ordered"])

    return arrow(id_text(docs), run, "doc_id long, n_ngrams long, log_weight double, gumbel_key double, ordered long")


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, buckets: int = BUCKETS, label_bound: int = 20_000, seed: int = 42) -> DataFrame:
    """One row per document: doc_id, n_ngrams, log_weight, gumbel_key, kept.

    ``share`` of the documents is drawn; by default the share of label 1 among all labelled documents.
    ``label_bound`` bounds the labelled documents that fit the target model.
    """
    if share is None:
        share = label_rows(labels, "quality").agg(F.avg("label")).first()[0]
        share = 1.0 if share is None else share
    raw, target = count_models(docs, labels, buckets, label_bound)
    scored = cut(weigh(docs, log_ratio(raw, target), seed))
    n = scored.count()
    k = round(share * n)
    if k >= n or k <= 0:
        kept = F.lit(k > 0)
    else:
        value, above = kth_largest(scored, "ordered", k)
        ties = scored.filter(F.col("ordered") == value).select((-F.coalesce("doc_id", F.lit(-1))).alias("back"))
        last, _ = kth_largest(ties, "back", k - above)
        kept = (F.col("ordered") > value) | ((F.col("ordered") == value) & (-F.coalesce("doc_id", F.lit(-1)) >= last))
    return scored.select("doc_id", "n_ngrams", "log_weight", "gumbel_key", kept.alias("kept"))
