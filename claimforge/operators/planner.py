"""Planning: exact quotas, specifications by slot, video splits and samples; no driver loop, no draw that depends on order.

Drawing with weights equal to the remaining quota is drawing from an urn without replacement. So each dimension
is the quota multiset under a random bijection of slot numbers, its own for each dimension: the counts are exact, the
dimensions independent of each other, and no row has to know another.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import Config
from ..functions import rand

K_BUCKETS = {"k_4_8": (4, 8), "k_9_15": (9, 15), "k_16_28": (16, 28), "k_29_40": (29, 40)}


def quotas(shares: dict[str, float], n: int) -> dict[str, int]:
    """Whole numbers that sum to n, by the largest remainders (first come first among equals)."""
    total = sum(shares.values())
    exact = {k: n * v / total for k, v in shares.items()}
    out = {k: int(x + 1e-9) for k, x in exact.items()}
    for k in sorted(exact, key=lambda k: out[k] - exact[k])[: n - sum(out.values())]:
        out[k] += 1
    return out


#: Rounds of a bijection, and the prime its coins are drawn by; products of two values below it fit a long.
ROUNDS, PRIME = 36, (1 << 31) - 1


@lru_cache(256)
def rounds(*purpose: str | int) -> list[tuple[int, int, int]]:
    """(k, a, b) of each round of a bijection."""
    draws = (md5("|".join(map(str, (*purpose, r))).encode()).hexdigest() for r in range(ROUNDS))
    return [(int(h[:15], 16), int(h[15:22], 16) + 1, int(h[22:29], 16)) for h in draws]


def place(slot: Column, n: Column | int, *purpose: str | int) -> Column:
    """A bijection of 0 ... n - 1, its own for each purpose, by swap-or-not.

    In each round x and (k - x) mod n are partners, and a coin of the larger of the two says whether they change places:
    ((u * u + a) mod PRIME) div 8 is odd, where u = (larger * a + b) mod PRIME. It holds for any n, by arithmetic alone.
    """
    n = n if isinstance(n, Column) else F.lit(n)
    n, prime = n.cast("long"), F.lit(PRIME).cast("long")
    steps = F.expr("array(" + ", ".join(f"named_struct('k', {k}L, 'a', {a}L, 'b', {b}L)" for k, a, b in rounds(*purpose)) + ")")

    def step(x: Column, r: Column) -> Column:
        partner = (r.k % n - x + n) % n
        u = (F.greatest(x, partner) % prime * r.a + r.b) % prime
        return F.when(F.expr("8L") <= (u * u + r.a) % prime % 16, partner).otherwise(x)

    return F.aggregate(steps, slot.cast("long"), step)


def spread(at: Column, counts: dict[str, int]) -> Column:
    """The value whose share of 0 ... n - 1, in the order given, holds ``at``."""
    out, top = F.lit(None).cast("string"), sum(counts.values())
    for value, n in reversed(counts.items()):
        out = F.when(at < top, value).otherwise(out)
        top -= n
    return out


def plan(spark: SparkSession, config: Config, split: str, n: int) -> DataFrame:
    """(split, slot_id, family, task_type, k, hops, difficulty) of n slots; every marginal count is its quota.

    The places of single and multiple choice come first in their dimension, so they also index the quotas of the
    larger option counts. Empty for n = 0.
    """
    n = max(n, 0)
    m, slot, seed = max(n, 1), F.col("slot_id"), config.seed
    tasks = quotas(config.distribution("task_modalities"), m)
    tasks = {t: tasks[t] for t in ("single_choice", "multi_label", "binary", "three_way")}
    sizes = config.distribution("option_counts")
    choices = tasks["single_choice"] + tasks["multi_label"]
    buckets = quotas({b: sizes[b] for b in K_BUCKETS}, choices)
    hops = quotas(config.distribution("reasoning_depth"), m)
    hops = {str(i): hops[h] for i, h in enumerate(("hop_1", "hop_2", "hop_3", "hop_4_plus"), 1)}
    rows = spark.range(n).withColumnRenamed("id", "slot_id")
    at = place(slot, m, seed, split, "task")
    bucket = spread(place(at, choices, seed, split, "k") if choices else F.lit(0), buckets)
    k = F.when(F.col("task_type") == "binary", 2).when(F.col("task_type") == "three_way", 3)
    for name, (low, high) in K_BUCKETS.items():
        k = k.when(bucket == name, rand.integer(low, high, seed, split, slot, "k"))
    return rows.withColumn("task_type", spread(at, tasks)).select(
        F.lit(split).alias("split"), "slot_id",
        spread(place(slot, m, seed, split, "family"), quotas(config.distribution("reasoning_families"), m)).alias("family"),
        "task_type", k.cast("int").alias("k"),
        spread(place(slot, m, seed, split, "hops"), hops).cast("int").alias("hops"),
        spread(place(slot, m, seed, split, "difficulty"), quotas(config.distribution("negative_difficulty"), m)).alias("difficulty"),
    )


def ranked(df: DataFrame, key: Column, item: str, group: str | None = None) -> DataFrame:
    """``df`` with _rank (1, 2, ... in the order of ``key`` and ``item``) and _total, of each group or of all rows.

    A rank is found from counts: rows are dealt over 4096 ranges of their key (hexadecimal text), each range is ranked by
    itself, and the sizes of the ranges before it are added, so no task sees all rows. Only sizes of ranges are sent.
    """
    by = [group] if group else []
    rows = df.withColumn("_key", key).withColumn("_range", F.substring("_key", 1, 3))
    sizes = rows.groupBy(*by, "_range").agg(F.count("*").alias("_n"))
    before = sizes.select(*by, "_range", (F.sum("_n").over(W.partitionBy(*by).orderBy("_range")) - F.col("_n")).alias("_before"), F.sum("_n").over(W.partitionBy(*by)).alias("_total"))
    rank = F.row_number().over(W.partitionBy(*by, "_range").orderBy("_key", item)) + F.col("_before")
    return rows.join(F.broadcast(before), [*by, "_range"]).withColumn("_rank", rank).drop("_key", "_range", "_before")


def split_videos(videos: DataFrame, seed: int, val_share: float = 0.1) -> DataFrame:
    """(video_id, split): the val_share of ids with the smallest draws is val, the rest train."""
    rows = ranked(videos.select("video_id").dropna().distinct(), rand.key(seed, "split", F.col("video_id")), "video_id")
    return rows.select("video_id", F.when(F.col("_rank") <= F.floor(F.lit(val_share) * F.col("_total")), "val").otherwise("train").alias("split"))


def stratified(df: DataFrame, stratum: str, item: str, n: int, seed: int) -> DataFrame:
    """(item, stratum) of n random items of each stratum; ranks are limited before the shuffle."""
    rank = F.row_number().over(W.partitionBy(stratum).orderBy(rand.key(seed, "sample", F.col(item)), item))
    return df.select(item, stratum).withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def assign_videos(spec: DataFrame, videos: DataFrame, seed: int) -> DataFrame:
    """``spec`` with a video for each slot and attempt: every n slots in a row take every video of their split once.

    ``videos``: (video_id, split). Videos are numbered in the order of their draws; a slot takes the number that a
    bijection of 0 ... n - 1 gives for its own number, a further attempt the one for the next. Slots of a split
    without videos are left out.
    """
    numbered = ranked(videos.select("split", "video_id"), rand.key(seed, "order", F.col("video_id")), "video_id", "split")
    sizes = numbered.groupBy("split").agg(F.count("*").alias("_n"))
    turn = place((F.col("slot_id") + F.col("attempt")) % F.col("_n"), F.col("_n"), seed, "videos") + 1
    return spec.join(F.broadcast(sizes), "split").withColumn("_rank", turn).drop("_n").join(numbered.drop("_total"), ["split", "_rank"]).drop("_rank")
