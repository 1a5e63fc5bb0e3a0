"""What holds in a scene and what does not: present and absent sets, false relations, event order.

All operators take any table with a scene column and item columns. A vocabulary is a short list (tens of items),
carried as an array literal: absent items are an array difference per scene, without a join. Set operators put
out distinct rows; null scenes and items are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rand


def literals(items: list) -> Column:
    return F.array(*map(F.lit, items))


def present(df: DataFrame, scene: str, *items: str) -> DataFrame:
    """Distinct (scene, items)."""
    return df.select(scene, *items).dropna().distinct()


def present_sets(df: DataFrame, scene: str, item: str, name: str = "items") -> DataFrame:
    """(scene, sorted array of its distinct items)."""
    return df.select(scene, item).dropna().groupBy(scene).agg(F.sort_array(F.collect_set(item)).alias(name))


def absent(df: DataFrame, scene: str, item: str, vocabulary: list) -> DataFrame:
    """(scene, item) of every vocabulary item that the scene lacks (closed world)."""
    sets = present_sets(df, scene, item)
    return sets.select(scene, F.explode(F.array_except(literals(vocabulary), "items")).alias(item))


def false_object(df: DataFrame, scene: str, item: str, vocabulary: list, seed: int) -> DataFrame:
    """(scene, item): one vocabulary item, drawn by the scene's key, that the scene lacks; null where it has them all."""
    sets = present_sets(df, scene, item)
    return sets.select(scene, rand.pick(F.array_except(literals(vocabulary), "items"), seed, "false_object", F.col(scene)).alias(item))


def joint(df: DataFrame, scene: str, obj: str, relation: str) -> DataFrame:
    """(scene, object, first, second) of every two relations of one object, in order (HAVING at least two)."""
    sets = df.select(scene, obj, relation).dropna().groupBy(scene, obj).agg(F.sort_array(F.collect_set(relation)).alias("r")).filter(F.size("r") > 1)
    left = sets.select(scene, obj, "r", F.explode("r").alias("first"))
    return left.select(scene, obj, "first", F.explode(F.filter("r", lambda x: x > F.col("first"))).alias("second"))


def false_relations(df: DataFrame, scene: str, obj: str, relation: str, vocabulary: list) -> DataFrame:
    """(scene, object, relation) of every vocabulary relation that a present object lacks (closed world)."""
    sets = df.select(scene, obj, relation).dropna().groupBy(scene, obj).agg(F.collect_set(relation).alias("r"))
    return sets.select(scene, obj, F.explode(F.array_except(literals(vocabulary), "r")).alias(relation))


def exclusive_present(df: DataFrame, scene: str, obj: str, relation: str, pairs: list[tuple]) -> DataFrame:
    """(scene, object, first, second) where both of an exclusive pair are asserted."""
    sets = df.select(scene, obj, relation).dropna().groupBy(scene, obj).agg(F.collect_set(relation).alias("r"))
    both = F.array(*(F.struct(F.lit(a).alias("first"), F.lit(b).alias("second")) for a, b in pairs))
    found = F.filter(both, lambda p: F.array_contains("r", p["first"]) & F.array_contains("r", p["second"]))
    return sets.select(scene, obj, F.inline(found))


def compatible(df: DataFrame, pairs: DataFrame, on: list[str]) -> DataFrame:
    """The rows whose (relation, object) is in a table of compatible pairs."""
    return df.join(pairs.select(*on), on, "left_semi")


def before_pairs(events: DataFrame, scene: str, event: str, start: str) -> DataFrame:
    """(scene, event_a, start_a, event_b, start_b) of every two events of a scene, a earlier than b, of different kinds."""
    a = events.select(F.col(scene).alias("scene"), F.col(event).alias("event_a"), F.col(start).alias("start_a"))
    b = events.select(F.col(scene).alias("scene"), F.col(event).alias("event_b"), F.col(start).alias("start_b"))
    return a.join(b, "scene").filter("start_a < start_b and event_a <> event_b").withColumnRenamed("scene", scene)


def chains(events: DataFrame, scene: str, event: str, start: str, length: int) -> DataFrame:
    """(scene, event_1, start_1, ... ) of chains of ``length`` events, each later than the one before, no kind twice."""
    name = lambda k: [F.col(event).alias(f"event_{k}"), F.col(start).alias(f"start_{k}")]
    out = events.select(scene, *name(1))
    for k in range(2, length + 1):
        new = F.col(f"start_{k - 1}") < F.col(f"start_{k}")
        for j in range(1, k):
            new = new & (F.col(f"event_{j}") != F.col(f"event_{k}"))
        out = out.join(events.select(scene, *name(k)), scene).filter(new)
    return out


def around(events: DataFrame, scene: str, event: str, start: str, pivot: Column) -> DataFrame:
    """(scene, event, side) of the other events of a scene, "earlier" or "later" than the first event that meets ``pivot``."""
    first = events.filter(pivot).groupBy(scene).agg(F.min(start).alias("pivot_start"))
    side = F.when(F.col(start) < F.col("pivot_start"), "earlier").otherwise("later")
    return events.filter(~pivot).join(first, scene).select(scene, event, side.alias("side"))


def same_group(df: DataFrame, item: str, group: str) -> DataFrame:
    """(item, other, group) of every two items of one group."""
    a, b = df.select(item, group).dropna().distinct(), df.select(F.col(item).alias("other"), group).dropna().distinct()
    return a.join(b, group).filter(F.col(item) != F.col("other")).select(item, "other", group)
