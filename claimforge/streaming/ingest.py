"""Scene graphs as they arrive: each micro-batch runs the batch operators and appends its claims."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Config
from ..operators import planner
from ..operators.dedup import content_key, first_wins
from ..operators.generate import generate
from ..operators.normalize import video_pools
from ..operators.validate import validate
from ..schemas import RAW
from ..sources import sink


def claims_of(spark: SparkSession, config: Config, raw: DataFrame, per_video: int, batch: int) -> DataFrame:
    """Valid claims of new videos: ``per_video`` slots of each, planned as one split "train"."""
    videos = raw.select("video_id").dropna().distinct().withColumn("split", F.lit("train"))
    n = videos.count() * per_video
    slots = planner.assign_videos(planner.plan(spark, config, "train", n).withColumn("attempt", F.lit(0)), videos, config.seed + batch)
    made = generate(slots, video_pools(raw), config.seed + batch, config.strict, config.families())
    made = made.withColumn("key", content_key(F.col("video_id"), F.col("query_text"), F.transform("propositions", lambda p: p.text)))
    return validate(first_wins(made, ["key"], ["slot_id"])).filter("is_valid")


def start(spark: SparkSession, source: str, output: str, checkpoint: str, config: Config, per_video: int = 4) -> StreamingQuery:
    """Reads JSON lines that appear in ``source`` and writes claims to ``output``/train/batch=N.

    A video that comes again is dropped by the stream's state (ids only; a state store on disk suits many), so no batch
    reads what earlier ones have written. Content keys hold the video, so claims of different batches never collide. A
    batch that is repeated after a failure replaces its own folder: every claim is written exactly once.
    """
    stream = spark.readStream.schema(RAW).json(source).filter("video_id is not null").dropDuplicates(["video_id"])

    def add(batch: DataFrame, number: int) -> None:
        new = claims_of(spark, config, batch.persist(), per_video, number)
        sink.rows(new).write.mode("overwrite").option("maxRecordsPerFile", config.raw["generation"]["shard_size"]).parquet(f"{output}/train/batch={number}")
        batch.unpersist()

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """(window, event_type, n) of a stream of timed events with a watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"))
