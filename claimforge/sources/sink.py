"""Shards, manifest and reports."""

from __future__ import annotations

import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.dedup import content_key, evidence_signature
from ..schemas import SINK

#: Files that are moved at a time.
MOVES = 16


def rows(accepted: DataFrame) -> DataFrame:
    """The eleven columns of the sink. A null query is empty, a null label -1, and the truth state that of the first option."""
    first = F.get("propositions", F.lit(0)).truth_state
    out = accepted.select(
        "example_id", "split", "video_id", F.coalesce("query_text", F.lit("")).alias("query"), F.transform("propositions", lambda p: p.text).alias("options"),
        F.transform("propositions", lambda p: F.coalesce(p.label, F.lit(-1).cast("tinyint"))).alias("labels"), F.coalesce(first, F.lit("UNKNOWN")).alias("truth_state"),
        F.size("propositions").alias("option_count"), "task_type", F.col("reasoning.family").alias("reasoning_family"), "generator_family",
    )
    blank = F.col("video_id").isNull() | (F.trim("video_id") == "")
    return out.withColumn("video_id", F.when(blank, F.raise_error(F.lit("a row without video_id"))).otherwise(F.col("video_id")))


def write(accepted: DataFrame, path: str, shard_size: int = 50_000) -> None:
    """Appends shards of at most ``shard_size`` rows to ``path``/split, numbered part-000000.parquet and so on; the split is also a column of every file.

    Rows are written beside the split's folder by Spark's commit protocol and then moved, so a folder never holds half a
    shard. What a broken run leaves behind begins with an underscore, which readers skip.
    """
    out, spark, splits = rows(accepted), accepted.sparkSession, ("train", "val", "test")
    fs, of = hadoop(spark, path)
    # all splits in one pass: the rows are made once
    new = f"{path}/_new-{uuid.uuid4().hex}"
    out.filter(F.col("split").isin(*splits)).withColumn("_split", F.col("split")).write.partitionBy("_split").option("maxRecordsPerFile", shard_size).parquet(new)
    listed = lambda at: (x.getPath().getName() for x in (fs.listStatus(at) if fs.exists(at) else ()))
    names = lambda at: sorted(n for n in listed(at) if n.startswith("part-"))
    for split in splits:
        staged, final = f"{new}/_split={split}", of(f"{path}/{split}")
        fs.mkdirs(final)
        first = max((int(n[5:11]) + 1 for n in names(final) if n[5:11].isdigit()), default=0)

        def move(numbered: tuple[int, str], staged: str = staged, split: str = split, first: int = first) -> None:
            k, name = numbered
            if not fs.rename(of(f"{staged}/{name}"), of(f"{path}/{split}/part-{first + k:06}.parquet")):
                raise OSError(f"{name} could not be moved to {path}/{split}")

        # a move waits for the file system, so many go on at a time
        with ThreadPoolExecutor(MOVES) as pool:
            list(pool.map(move, enumerate(names(of(staged)))))
    fs.delete(of(new), True)


def hadoop(spark: SparkSession, path: str):
    """The file system of a path, and what makes a path of a string."""
    of = spark._jvm.org.apache.hadoop.fs.Path
    return of(path).getFileSystem(spark._jsc.hadoopConfiguration()), of


def as_json(accepted: DataFrame) -> DataFrame:
    """(example_id, json): each example with all its columns as one JSON object."""
    return accepted.select("example_id", F.to_json(F.struct(*accepted.columns)).alias("json"))


def existing_keys(spark: SparkSession, path: str) -> DataFrame:
    """(split, key) of the rows that earlier runs have written; only three columns are read."""
    out = spark.createDataFrame([], "split string, key string")
    fs, of = hadoop(spark, path)
    for split in ("train", "val", "test"):
        if fs.exists(of(f"{path}/{split}")) and fs.listStatus(of(f"{path}/{split}")):
            shards = spark.read.schema(SINK).parquet(f"{path}/{split}")
            out = out.union(shards.select(F.lit(split), content_key(F.col("video_id"), F.col("query"), F.col("options"))))
    return out


DIMENSIONS = {
    "task_types": "task_type", "reasoning_families": "reasoning.family", "generator_families": "generator_family", "complexity": "reasoning.complexity", "k_counts": "size(propositions)",
    "split_counts": "split", "negative_difficulty": "difficulty", "reasoning_depth": "reasoning.hops", "rules": "generation_rule",
}


def counts_table(accepted: DataFrame) -> DataFrame:
    """(dimension, value, n, share) of each of DIMENSIONS, in one pass: a row becomes a pair for each dimension, and pairs are counted.
    Options are not read where ``accepted`` has their number as ``option_count``."""
    of = {**DIMENSIONS, **({"k_counts": "option_count"} if "option_count" in accepted.columns else {})}
    pairs = F.array(*(F.struct(F.lit(d).alias("dimension"), F.expr(e).cast("string").alias("value")) for d, e in of.items()))
    n = accepted.select(F.inline(pairs)).groupBy("dimension", "value").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(W.partitionBy("dimension")), 6))


def counts(accepted: DataFrame) -> dict[str, dict[str, int]]:
    """The same as a dict of dicts, the most frequent first."""
    out: dict[str, dict[str, int]] = {d: {} for d in DIMENSIONS}
    for r in counts_table(accepted).orderBy("dimension", F.desc("n"), "value").collect():
        out[r.dimension][r.value] = r.n
    return out


def subtypes_table(accepted: DataFrame) -> DataFrame:
    """(kind, value, n): temporal claims by subtype (several hops, else the relation of the first true option, else unknown) and by hops; grounding claims by subtype."""
    family, kind = F.col("reasoning.family"), F.col("reasoning.type")
    true = F.get(F.filter("propositions", lambda p: (p.semantics.canonical_type == "temporal") & (p.truth_state == "TRUE")), F.lit(0))
    of_time = F.when(kind.contains("multihop"), "multihop").otherwise(F.coalesce(true.semantics.temporal_relation, F.lit("unknown")))
    of_place = F.when(kind.contains("identification"), "identification").when(kind.contains("verification"), "verification")
    pair = lambda k, v: F.struct(F.lit(k).alias("kind"), v.cast("string").alias("value"))
    pairs = F.when(family == "temporal", F.array(pair("temporal_subtypes", of_time), pair("temporal_hops", F.col("reasoning.hops")))).when((family == "grounding") & of_place.isNotNull(), F.array(pair("grounding_subtypes", of_place)))
    return accepted.select(F.inline(pairs)).groupBy("kind", "value").agg(F.count("*").alias("n"))


def diversity_table(accepted: DataFrame) -> DataFrame:
    """One row: distinct videos, templates, evidence signatures (without and with the video), option sets and proposition signatures; truth states and "none" options."""
    e = F.col("evidence")
    sig = lambda video=None: evidence_signature(e.object_ids, e.relation_ids, e.frame_ids, video)
    texts = F.array_join(F.sort_array(F.transform("propositions", lambda p: p.text)), "\u0001")
    one = accepted.agg(F.count("*").alias("examples"), F.count_distinct("video_id").alias("videos"), F.count_distinct("query_template_id").alias("templates"), F.count_distinct(sig()).alias("evidence_signatures"), F.count_distinct(sig(F.col("video_id"))).alias("video_evidence_signatures"), F.count_distinct(F.md5(texts)).alias("option_sets"))
    options = accepted.select(F.explode("propositions").alias("p")).select("p.*")
    none = F.col("semantics.canonical_type") == "logical_none"
    states = {s: F.count_if(F.col("truth_state") == s).alias(s) for s in ("TRUE", "FALSE", "UNKNOWN")}
    two = options.agg(*states.values(), F.count_if(none).alias("none_included"), F.count_if(none & (F.col("truth_state") == "TRUE")).alias("none_true"), F.count_if(none & (F.col("truth_state") == "FALSE")).alias("none_false"), F.count_distinct(F.to_json("semantics")).alias("proposition_signatures"))
    return one.join(two, how="cross")


def diversity(accepted: DataFrame) -> dict[str, int]:
    return diversity_table(accepted).first().asDict()


def samples_table(accepted: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` examples of each rule, by slot, with their rank."""
    rank = F.row_number().over(W.partitionBy("generation_rule").orderBy("split", "slot_id", "attempt"))
    return accepted.withColumn("_rank", rank).filter(F.col("_rank") <= n)


def samples(accepted: DataFrame, n: int = 5) -> list:
    return samples_table(accepted, n).orderBy("generation_rule", "_rank").collect()


def manifest(config, stats: dict) -> str:
    keys = ("split_counts", "task_types", "reasoning_families", "negative_difficulty", "reasoning_depth", "k_counts")
    head = {"dataset_name": config.raw["dataset_name"], "version": config.raw["version"], "scale": config.raw["scale"], "seed": config.seed, "total_examples": stats["accepted"]}
    return json.dumps({**head, **{k: stats["counts"][k] for k in keys}, "generated_timestamp": time.strftime("%Y-%m-%d %H:%M:%S")}, indent=2)


def reports(stats: dict, examples: list, videos: dict[str, int]) -> dict[str, str]:
    """The four reports by file name."""
    share = lambda n, of: f"{n / of:.2%}" if of else "0.00%"
    n, d = stats["accepted"], stats["diversity"]
    lines = ["# Samples", ""]
    for r in examples:
        lines += [f"## {r.generation_rule}", f"{r.example_id} | {r.split} | {r.task_type} | {len(r.propositions)} options | {r.reasoning.hops} hops", f"Query: {r.query_text}"]
        lines += [f"- [{'?' if p.label is None else p.label}] {p.text} ({p.truth_state})" for p in r.propositions] + [""]
    checked = ["# Validation", "", f"- Candidates: {stats['candidates']}", f"- Accepted: {n}", f"- Rejected: {stats['rejected']}", f"- Duplicates: {stats['duplicates']}", f"- Open slots: {stats['shortfall']}", "", "## Reasons"]
    checked += [f"- {c}: {reason}" for reason, c in stats["reasons"].items()]
    split = ["# Splits", "", *(f"- {s} videos: {c}" for s, c in videos.items()), "", "## Examples", *(f"- {s}: {c}" for s, c in stats["counts"]["split_counts"].items())]
    spread = ["# Diversity", "", f"- Videos used: {d['videos']}", f"- Examples a video: {n / max(1, d['videos']):.2f}", f"- Examples an evidence signature: {n / max(1, d['evidence_signatures']):.2f}", f"- Evidence reuse: {share(n - d['evidence_signatures'], n)}", f"- The same, by video: {share(n - d['video_evidence_signatures'], n)}"]
    spread += [f"- Proposition signatures: {d['proposition_signatures']}", f"- Option sets: {d['option_sets']}", f"- Templates: {d['templates']}", f"- Duplicates caught: {share(stats['duplicates'], stats['candidates'])}", f"- Truth states: TRUE {d['TRUE']}, FALSE {d['FALSE']}, UNKNOWN {d['UNKNOWN']}", f"- NONE options: {d['none_included']} ({d['none_true']} true, {d['none_false']} false)"]
    for name, values in {**stats["counts"], **stats.get("subtypes", {})}.items():
        spread += ["", f"## {name}", *(f"- {v}: {c} ({share(c, n)})" for v, c in values.items())]
    return {name: "\n".join(x) + "\n" for name, x in (("SAMPLE_REPORT.md", lines), ("VALIDATION_REPORT.md", checked), ("SPLIT_REPORT.md", split), ("DIVERSITY_REPORT.md", spread))}


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file on any file system that Spark reaches."""
    fs, of = hadoop(spark, path)
    out = fs.create(of(path), True)
    out.write(bytearray(text.encode()))
    out.close()
