"""Content keys, first-wins deduplication, and resuming after earlier runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def content_key(video: Column, query: Column, options: Column) -> Column:
    """md5 of video, query and the sorted option texts. Nulls and empty texts differ from all other values."""
    return F.md5(F.to_json(F.struct(video.alias("v"), query.alias("q"), F.sort_array(options).alias("o")), {"ignoreNullFields": "false"}))


def evidence_signature(objects: Column, relations: Column, frames: Column, video: Column | None = None) -> Column:
    """Sorted ids of objects, relations and frames; with ``video``, of that video alone."""
    parts = [F.array_join(F.sort_array(c), ",") for c in (objects, relations, frames)]
    return F.concat_ws("_", *([video] if video is not None else []), *parts)


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order. The rank is limited before the shuffle, so a common key costs one row a task."""
    return df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("_rank = 1").drop("_rank")


def resume(df: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key no existing row has."""
    return df.join(existing.select(*keys).distinct(), keys, "left_anti")
