"""The queries of the corpus operators, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, decontamination, pii, quality_rules, resampling, simhash, token_store, toxicity, url_filter, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.rules(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(warc.resolve(warc.captures(table(spark, sf_dir, "pages"))))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = token_store.new_store(spark)
    token_store.write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), store)
    return token_store.digests(spark, store)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).drop("score")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_importance_resampling, op2_decontamination, op3_quality_rules, op4_byte_bpe, op5_simhash, op6_warc_revisits, op7_token_store, op8_url_filter, op9_pii, op10_toxicity)}

#: Words and five-word shingles as the operators take them.
SHINGLES = r"""
words AS (SELECT *, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM {table}),
shingled AS (SELECT *, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct([array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]) END) AS s FROM words)
"""

ORACLE_SQL = {
    "op2_decontamination": f"""
WITH d AS (WITH {SHINGLES.format(table="documents")} SELECT doc_id, s FROM shingled),
b AS (WITH {SHINGLES.format(table="benchmark")} SELECT item_id, s FROM shingled),
n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id)
SELECT doc_id, item_id, n_shared, n_item FROM (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN b USING (s) GROUP BY doc_id, item_id) JOIN n USING (item_id)
WHERE n_shared >= 0.8 * n_item - 1e-9
""",
    "op6_warc_revisits": warc.ORACLE_SQL,
    "op8_url_filter": url_filter.oracle_sql(),
}
