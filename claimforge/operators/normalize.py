"""Raw scene graphs to tables of frames, objects, relations and actions, and to one wide row of pools per video.

Missing keys take defaults, other entry types are dropped, repeated frame and vertex ids keep the last, and class
ids without a name keep the id. Null videos are left out; an empty input gives empty tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import rand
from ..schemas import RELATION_ITEM, VERTEX
from ..vocab import OBJECTS, RELATION_NAMES


def named(ids: Column, names: dict[str, str]) -> Column:
    """The name of a class id, or the id."""
    return F.coalesce(F.try_element_at(rand.table(names), ids), ids)


@dataclass
class SceneGraphs:
    videos: DataFrame
    splits: DataFrame
    frames: DataFrame
    objects: DataFrame
    relations: DataFrame
    actions: DataFrame


def last_wins(df: DataFrame, keys: list[str], *position: str) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*map(F.desc, position)))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def entries_of(raw: DataFrame) -> DataFrame:
    """(video_id, row, pos, key, v): the entries of raw graphs with a number of their row, which tells rows of one video apart, and their places."""
    entries = raw.filter("video_id is not null").select("video_id", F.monotonically_increasing_id().alias("row"), "entries").select("video_id", "row", F.posexplode(F.map_entries("entries")).alias("pos", "e"))
    return entries.select("video_id", "row", "pos", F.col("e.key").alias("key"), F.col("e.value").alias("v"))


def normalize(raw: DataFrame) -> SceneGraphs:
    """``videos`` are those with a frame or an action."""
    return normalize_entries(entries_of(raw))


def normalize_entries(entries: DataFrame) -> SceneGraphs:
    """The same from rows of entries_of(): where they are made row by row, no graph has to be put together and taken apart."""
    entries = entries.filter("video_id is not null and v is not null")
    videos = entries.filter(F.col("v.type").isin("frame", "action")).select("video_id").distinct()
    text = lambda c: F.coalesce(c, F.lit(""))
    actions = entries.filter("v.type = 'action'").select(
        "video_id", "pos", F.coalesce("v.id", "key").alias("action_id"), text("v.charades").alias("charades_id"), text("v.phrase").alias("phrase"),
        F.coalesce("v.start", F.lit(0.0)).alias("start_secs"), F.coalesce("v.end", F.lit(0.0)).alias("end_secs"),
        F.coalesce("v.all_f", F.array().cast("array<string>")).alias("frame_ids"), F.col("v.object_id").alias("object_id"), F.col("v.verb_id").alias("verb_id"),
    )
    of_frames = entries.filter("v.type = 'frame'")
    splits = of_frames.groupBy("video_id").agg(F.coalesce(F.max_by("v.metadata", F.when(F.col("v.metadata").isNotNull(), F.col("pos"))), F.lit("unknown")).alias("split"))
    frames = last_wins(of_frames.select("video_id", "pos", F.coalesce("v.id", "key").alias("frame_id"), F.coalesce("v.secs", F.lit(0.0)).alias("secs"), F.col("v.vertices").alias("vertices"), "row"), ["video_id", "frame_id"], "pos", "row").drop("row")
    box = F.when(F.size("x.bbox") == 4, F.col("x.bbox"))
    # the fields of objects are taken out before the last frame of an id is known, so that no whole vertex is sorted or shuffled for them
    objects = of_frames.select("video_id", "row", "pos", F.coalesce("v.id", "key").alias("frame_id"), F.coalesce("v.secs", F.lit(0.0)).alias("secs"), F.posexplode_outer("v.vertices").alias("at", "x"))
    objects = objects.select(
        "video_id", "row", "pos", "frame_id", "secs", "at", text("x.id").alias("obj_id"), text("x.class").alias("class_id"), F.coalesce("x.visible", F.lit(True)).alias("visible"), box.alias("bbox"), F.col("x").isNotNull().alias("real"),
    )
    last = F.rank().over(W.partitionBy("video_id", "frame_id").orderBy(F.desc("pos"), F.desc("row")))
    objects = objects.withColumn("_rank", last).filter("_rank = 1 and real").drop("_rank", "real", "row", "pos")
    objects = last_wins(objects, ["video_id", "frame_id", "obj_id"], "at").withColumn("name", named(F.col("class_id"), OBJECTS)).drop("at")
    vertices = frames.select("video_id", "frame_id", F.explode("vertices").alias("x")).filter("x is not null")
    kinds = F.array(*(F.struct(F.lit(kind).alias("type"), F.coalesce(F.col(f"x.{kind}"), F.array().cast(RELATION_ITEM)).alias("items")) for kind in ("attention", "contact", "spatial", "verb")))
    rows = vertices.select("video_id", "frame_id", F.explode(kinds).alias("k")).select("video_id", "frame_id", "k.type", F.explode("k.items").alias("item"))
    relations = rows.select("video_id", "frame_id", text("item.id").alias("rel_id"), F.col("type").alias("rel_type"), text("item.class").alias("class_id"), F.explode("item.objects").alias("target"))
    relations = relations.withColumn("target_class", F.col("target.class")).drop("target").filter("target_class <> ''")
    relations = relations.withColumn("name", named(F.col("class_id"), RELATION_NAMES))
    return SceneGraphs(videos, splits, frames.drop("vertices"), objects, relations, actions)


def wide_pools(g: SceneGraphs) -> DataFrame:
    """One row per video: present objects and relation triples, actions by start, frames with boxed objects; all sorted."""
    # objects are read once, for the classes of a video and the boxed ones of its frames
    box = F.when(F.col("bbox").isNotNull() & (F.col("name") != ""), F.struct("obj_id", "class_id", "name", "bbox"))
    frames = g.objects.groupBy("video_id", "frame_id").agg(F.collect_set("class_id").alias("classes"), F.sort_array(F.collect_list(box)).alias("objs"))
    frames = frames.withColumn("frame", F.when(F.size("objs") > 0, F.struct("frame_id", "objs")))
    objects = frames.groupBy("video_id").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("classes")))).alias("present_objects"), F.sort_array(F.collect_list("frame")).alias("frames"))
    triples = g.relations.filter(F.col("rel_type").isin("attention", "spatial", "contact")).groupBy("video_id")
    triples = triples.agg(F.sort_array(F.collect_set(F.struct(F.col("rel_type").alias("type"), F.col("class_id").alias("cls"), F.col("target_class").alias("obj")))).alias("present_relations"))
    acts = g.actions.filter("phrase <> ''").groupBy("video_id").agg(F.sort_array(F.collect_list(F.struct("start_secs", "pos", "phrase"))).alias("a"))
    acts = acts.select("video_id", F.transform("a", lambda x: F.struct(x.phrase.alias("phrase"), x.start_secs.alias("start_secs"))).alias("actions"))
    out = g.videos.join(objects, "video_id", "left").join(triples, "video_id", "left").join(acts, "video_id", "left")
    empty = {"present_objects": "array<string>", "present_relations": "array<struct<type:string,cls:string,obj:string>>", "actions": "array<struct<phrase:string,start_secs:double>>", "frames": "array<struct<frame_id:string,objs:array<struct<obj_id:string,class_id:string,name:string,bbox:array<double>>>>>"}
    return out.select("video_id", *(F.coalesce(F.col(c), F.array().cast(t)).alias(c) for c, t in empty.items()))


def bound(value: Column, f) -> Column:
    """f(value), with ``value`` computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def last_of(items: Column, key: str) -> Column:
    """The last of each key of an array that is sorted by the key."""
    return bound(items, lambda s: F.filter(s, lambda x, i: F.coalesce(F.get(s, i + 1)[key] != x[key], F.lit(True))))


def frame_part(key: Column, v: Column, at: Column, row: Column, vertices: list[Column] | None = None, most: int = 1) -> dict[str, Column]:
    """What pools need of an entry: its objects' classes, its boxed objects and its triples, apart, so that a plan makes only those it reads; each null if it is no frame.

    Where the ``vertices`` are known one by one (none of them null, at most ``most`` items in a list of relations and two targets in
    an item), they become plain expressions, which Spark compiles; lambdas are interpreted.
    """
    text, listed = (lambda c: F.coalesce(c, F.lit(""))), (lambda c, t: F.coalesce(c, F.array().cast(t)))
    box, kinds = (lambda x: F.when(F.size(x.bbox) == 4, x.bbox)), ("attention", "contact", "spatial")
    boxed = lambda obj_id, class_id, bbox: F.struct(obj_id.alias("obj_id"), class_id.alias("class_id"), named(class_id, OBJECTS).alias("name"), bbox.alias("bbox"))
    triple = lambda kind, r, t: F.struct(F.lit(kind).alias("type"), text(r["class"]).alias("cls"), t["class"].alias("obj"))
    if vertices is None:
        found = listed(v.vertices, f"array<{VERTEX}>")
        thing = lambda x, i: F.when(x.isNotNull(), F.struct(text(x.id).alias("obj_id"), i.alias("at"), text(x["class"]).alias("class_id"), box(x).alias("bbox")))
        objs = last_of(F.sort_array(F.array_compact(F.transform(found, thing))), "obj_id")
        classes = F.transform(objs, lambda o: o.class_id)
        boxes = F.filter(F.transform(F.filter(objs, lambda o: o.bbox.isNotNull()), lambda o: boxed(o.obj_id, o.class_id, o.bbox)), lambda o: o["name"] != "")
        targets = lambda kind: lambda r: F.transform(F.filter(listed(r.objects, "array<struct<class:string>>"), lambda t: t["class"] != ""), lambda t: triple(kind, r, t))
        triples = F.flatten(F.transform(found, lambda x: F.flatten(F.concat(*(F.transform(listed(x[kind], RELATION_ITEM), targets(kind)) for kind in kinds)))))
    else:
        last = [reduce(Column.__and__, (text(x.id) != text(y.id) for y in vertices[i + 1 :]), F.lit(True)) for i, x in enumerate(vertices)]
        some = lambda *pairs: F.concat(*(F.when(condition, F.array(x)).otherwise(F.slice(F.array(x), 1, 0)) for condition, x in pairs))
        classes = some(*((keep, text(x["class"])) for x, keep in zip(vertices, last, strict=True)))
        boxes = F.sort_array(some(*((keep & (F.size(x.bbox) == 4) & (named(text(x["class"]), OBJECTS) != ""), boxed(text(x.id), text(x["class"]), x.bbox)) for x, keep in zip(vertices, last, strict=True))))
        items = [(kind, F.get(x[kind], F.lit(i))) for x in vertices for kind in kinds for i in range(most)]
        triples = some(*((F.get(r.objects, F.lit(j))["class"] != "", triple(kind, r, F.get(r.objects, F.lit(j)))) for kind, r in items for j in range(2)))
    # a lambda keeps the projection out of whole-stage code, which would make one method of it, too large for the JIT
    place = (bound(F.coalesce(v.id, key), lambda x: x).alias("frame_id"), at.cast("long").alias("pos"), row.alias("row"))
    return {name: F.when(v.type == "frame", F.struct(*place, part.alias(name))) for name, part in (("classes", classes), ("boxes", boxes), ("triples", triples))}


def action_part(v: Column, at: Column) -> Column:
    """The same of an action; one without a phrase counts as an entry of its video only."""
    return F.when(v.type == "action", F.struct(F.coalesce(v.start, F.lit(0.0)).alias("start_secs"), at.cast("long").alias("pos"), F.coalesce(v.phrase, F.lit("")).alias("phrase")))


#: The columns of parts that pools_of() takes: arrays of the parts of frames, and of actions.
PARTS = ("classes", "boxes", "triples", "actions")


def pools_of(parts: DataFrame) -> DataFrame:
    """The same as wide_pools() from (video_id, *PARTS), each row by itself: no sort, shuffle or join of rows. Pools that nothing reads are not made."""
    rows = parts.select("video_id", "actions", *(F.sort_array(c).alias(c) for c in PARTS[:3]))
    last = lambda c: F.transform(F.filter(c, lambda x, i: F.coalesce(F.get(c, i + 1).frame_id != x.frame_id, F.lit(True))), lambda x: x[c])
    rows = rows.select("video_id", "actions", "boxes", F.flatten(last("classes")).alias("classes"), F.sort_array(F.flatten(last("triples"))).alias("triples"))
    boxes = F.filter("boxes", lambda x, i: F.coalesce(F.get("boxes", i + 1).frame_id != x.frame_id, F.lit(True)) & (F.size(x.boxes) > 0))
    return rows.select(
        "video_id", F.sort_array(F.array_distinct("classes")).alias("present_objects"),
        F.filter("triples", lambda x, i: (i == 0) | (F.get("triples", i - 1) != x)).alias("present_relations"),
        F.transform(F.sort_array(F.filter("actions", lambda a: a.phrase != "")), lambda a: F.struct(a.phrase.alias("phrase"), a.start_secs.alias("start_secs"))).alias("actions"),
        F.transform(boxes, lambda f: F.struct(f.frame_id.alias("frame_id"), f.boxes.alias("objs"))).alias("frames"),
    )


def video_pools(raw: DataFrame) -> DataFrame:
    """wide_pools() of raw graphs. Only the parts that pools need are shuffled, to join the rows of a video that comes more than once."""
    rows = raw.filter("video_id is not null and entries is not null").select("video_id", F.monotonically_increasing_id().alias("row"), F.map_entries("entries").alias("entries"))
    of = {name: (lambda name: lambda e, i: frame_part(e.key, e.value, i, F.col("row"))[name])(name) for name in PARTS[:3]} | {"actions": lambda e, i: action_part(e.value, i)}
    parts = rows.select("video_id", *(F.array_compact(F.transform("entries", f)).alias(name) for name, f in of.items()))
    parts = parts.filter((F.size("classes") > 0) | (F.size("actions") > 0)).groupBy("video_id")
    return pools_of(parts.agg(*(F.flatten(F.collect_list(c)).alias(c) for c in PARTS)))
