"""The whole engine: plan slots, assign videos, generate, drop duplicates, validate; open slots go into further rounds.

A round is one declarative plan; its result is written before the next begins, so lineage doesn't grow and a lost
executor costs no earlier round. Within a round the first row of a content key wins, ahead of validation, over all
splits; keys of earlier rounds and runs are left out. A rejected row takes its key. Rounds go on until every slot is
filled or a round fills none (or ``rounds`` of the configuration are over); what is still open then is reported.
"""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import planner
from ..operators.dedup import content_key, first_wins, resume
from ..operators.generate import UNTARGETED, generate, route
from ..operators.normalize import SceneGraphs, normalize, video_pools, wide_pools
from ..operators.validate import rejection_reasons, validate
from ..sources import sink


@dataclass
class Run:
    accepted: DataFrame
    stats: dict
    videos: dict[str, int] = field(default_factory=dict)


def scratch(spark: SparkSession, what: str = "engine") -> str:
    """A folder of its own under spark.checkpoint.dir, which all executors share; it goes when the application ends. A local Spark may do without the setting."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="claimforge-")
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"
    fs, of = sink.hadoop(spark, path)
    fs.mkdirs(of(path))
    fs.deleteOnExit(of(path))
    return path


def written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def splits_of(train: DataFrame, test: DataFrame | None, seed: int, val_share: float) -> DataFrame:
    """(video_id, split): the train source is split by draw, the test source stays; a video of both is a test video."""
    own = planner.split_videos(train, seed, val_share)
    if test is None:
        return own
    ids = test.select("video_id").dropna().distinct()
    return own.join(ids, "video_id", "left_anti").unionByName(ids.withColumn("split", F.lit("test")))


def run(spark: SparkSession, config: Config, train: DataFrame, test: DataFrame | None = None, existing: DataFrame | None = None, progress: Callable[[str], None] | None = None) -> Run:
    """All splits. ``train`` and ``test``: raw scene graphs; ``existing``: (split, key) of earlier rows, which count toward the targets;
    ``progress`` is told of each round."""
    at = scratch(spark)
    raw = train if test is None else train.unionByName(test)
    pools = written(video_pools(raw), f"{at}/pools")
    videos = written(splits_of(train, test, config.seed, config.raw["splits"]["val_share"]), f"{at}/videos")
    sizes = {r.split: r["count"] for r in videos.groupBy("split").count().collect()}
    there = {r.split: r["count"] for r in existing.groupBy("split").count().collect()} if existing is not None else {}
    slots = None
    for split, n in config.targets().items():
        if sizes.get(split):
            part = planner.plan(spark, config, split, n).filter(F.col("slot_id") >= there.get(split, 0))
            slots = part if slots is None else slots.unionByName(part)
    if slots is None:
        raise ValueError("no split has a video")
    keys = existing.select("key") if existing is not None else spark.createDataFrame([], "key string")
    kept, checked = [], []
    produced = spark.createDataFrame([], "n long")
    left, began, most = sum(config.targets().values()), time.monotonic(), config.raw["generation"]["rounds"]
    for k in count():
        tried = planner.assign_videos(slots.withColumn("attempt", F.lit(k)), videos, config.seed)
        tried = route(tried, pools, config.seed) if UNTARGETED in config.families() else tried
        made = generate(tried, pools, config.seed, config.strict, config.families())
        made = written(made.withColumn("key", content_key(F.col("video_id"), F.col("query_text"), F.transform("propositions", lambda p: p.text))), f"{at}/made-{k}")
        produced = produced.union(made.agg(F.count("*")))
        fresh = resume(first_wins(made, ["key"], ["split", "slot_id"]), keys, ["key"])
        rows = written(validate(fresh), f"{at}/checked-{k}")
        checked.append(rows)
        kept.append(rows.filter("is_valid"))
        keys = keys.union(rows.select("key"))
        slots = written(slots.join(rows.filter("is_valid").select("split", "slot_id"), ["split", "slot_id"], "left_anti"), f"{at}/open-{k}")
        before, left = left, slots.count()
        if progress:
            progress(f"round {k}: {left} of {sum(config.targets().values())} examples open after {time.monotonic() - began:.0f} s")
        # the first round also takes the rows that are there already
        if not left or (k and left == before) or (most and k + 1 >= most):
            break
    union = lambda parts: reduce(DataFrame.unionByName, parts)
    accepted, every = union(kept), union(checked)
    candidates, n_checked, n = produced.agg(F.sum("n")).first()[0] or 0, every.count(), accepted.count()
    reasons = {r.reason: r.n for r in rejection_reasons(every).orderBy(F.desc("n"), "reason").collect()}
    subtypes: dict[str, dict[str, int]] = {}
    for r in sink.subtypes_table(accepted).orderBy("kind", F.desc("n"), "value").collect():
        subtypes.setdefault(r.kind, {})[r.value] = r.n
    stats = {"candidates": candidates, "accepted": n, "rejected": n_checked - n, "duplicates": candidates - n_checked, "shortfall": left, "reasons": reasons, "counts": sink.counts(accepted), "diversity": sink.diversity(accepted), "subtypes": subtypes}
    for name in ("task_types", "reasoning_families", "split_counts", "k_counts"):
        if sum(stats["counts"][name].values()) != n:
            raise AssertionError(f"{name} does not add up to {n}")
    return Run(accepted, stats, sizes)


def publish(spark: SparkSession, config: Config, result: Run) -> None:
    """Shards, manifest and reports under the configured output folder."""
    path = config.output()
    sink.write(result.accepted, path, config.raw["generation"]["shard_size"])
    sink.write_text(spark, f"{path}/manifest.json", sink.manifest(config, result.stats))
    for name, text in sink.reports(result.stats, sink.samples(result.accepted), result.videos).items():
        sink.write_text(spark, f"{path}/{name}", text)


def register_views(spark: SparkSession, raw: DataFrame | SceneGraphs) -> None:
    """The normalized tables and pools as SQL views, of raw graphs or of such as are normalized."""
    g = raw if isinstance(raw, SceneGraphs) else normalize(raw)
    for name in ("splits", "frames", "objects", "relations", "actions"):
        getattr(g, name).createOrReplaceTempView(name)
    wide_pools(g).createOrReplaceTempView("pools")
