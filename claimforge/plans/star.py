"""The engine's operators over star-schema tables, each with the SQL that must give the same rows.

Three kinds of scenes stand in for videos. A user's day: events are actions that start at ``ts``. An order: parts'
brands are objects, part types relations, return flags relation families. A document: a row of the corpus.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import rand, render
from ..operators import dedup, planner, pools

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(scene, event, ts) of each event; a scene is a user's day."""
    scene = F.concat_ws("/", F.col("user_id"), F.date_format("ts", "yyyy-MM-dd"))
    return table(spark, sf_dir, "events").select(scene.alias("scene"), F.col("event_type").alias("event"), "ts")


def first_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(scene, event, start): the first time of each kind of event in a scene."""
    return days(spark, sf_dir).groupBy("scene", "event").agg(F.min("ts").alias("start"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(scene, flag, relation, object): return flag, part type and brand of each line of an order."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select(F.col("l_orderkey").alias("scene"), F.col("l_returnflag").alias("flag"), F.col("p_type").alias("relation"), F.col("p_brand").alias("object"))


def values(df: DataFrame, col: str) -> list:
    """The vocabulary of a column: a short list by contract, an error beyond a thousand."""
    found = sorted(r[0] for r in df.select(col).dropna().distinct().limit(1001).collect())
    if len(found) > 1000:
        raise ValueError(f"{col} is no vocabulary: over 1000 values")
    return found


DAYS = "d AS (SELECT user_id || '/' || strftime(ts, '%Y-%m-%d') AS scene, event_type AS event, ts FROM events), e AS (SELECT scene, event, min(ts) AS start FROM d GROUP BY ALL)"
ORDERS = "o AS (SELECT l_orderkey AS scene, l_returnflag AS flag, p_type AS relation, p_brand AS object FROM lineitem JOIN part ON l_partkey = p_partkey)"


@query(f"WITH {ORDERS} SELECT DISTINCT scene, object FROM o")
def present_objects(spark, sf_dir):
    return pools.present(orders(spark, sf_dir), "scene", "object")


@query(f"WITH {ORDERS} SELECT DISTINCT scene, flag, relation, object FROM o WHERE flag IN ('A', 'R')")
def present_relations(spark, sf_dir):
    return pools.present(orders(spark, sf_dir).filter(F.col("flag").isin("A", "R")), "scene", "flag", "relation", "object")


@query(f"WITH {ORDERS} SELECT s.scene, v.object FROM (SELECT DISTINCT scene FROM o) s CROSS JOIN (SELECT DISTINCT p_brand AS object FROM part) v WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.scene = s.scene AND o.object = v.object)")
def absent_objects(spark, sf_dir):
    return pools.absent(orders(spark, sf_dir), "scene", "object", values(table(spark, sf_dir, "part"), "p_brand"))


@query(f"WITH {DAYS} SELECT s.scene, v.event FROM (SELECT DISTINCT scene FROM e) s CROSS JOIN (SELECT DISTINCT event FROM e) v WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.scene = s.scene AND e.event = v.event)")
def absent_actions(spark, sf_dir):
    return pools.absent(days(spark, sf_dir), "scene", "event", values(table(spark, sf_dir, "events"), "event_type"))


@query(f"WITH {ORDERS} SELECT s.scene, s.object, v.relation FROM (SELECT DISTINCT scene, object FROM o) s CROSS JOIN (SELECT DISTINCT p_type AS relation FROM part) v WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.scene = s.scene AND o.object = s.object AND o.relation = v.relation)")
def closed_world_false_relations(spark, sf_dir):
    return pools.false_relations(orders(spark, sf_dir), "scene", "object", "relation", values(table(spark, sf_dir, "part"), "p_type"))


@query(f"WITH {ORDERS} SELECT DISTINCT a.scene, a.object, 'A' AS first, 'R' AS second FROM o a JOIN o b ON a.scene = b.scene AND a.object = b.object AND a.flag = 'A' AND b.flag = 'R'")
def exclusive_pairs(spark, sf_dir):
    return pools.exclusive_present(orders(spark, sf_dir), "scene", "object", "flag", [("A", "R")])


@query(f"WITH {ORDERS}, c(relation, object) AS (SELECT DISTINCT p_type, p_brand FROM part WHERE p_size <= 10) SELECT DISTINCT scene, relation, object FROM o WHERE EXISTS (SELECT 1 FROM c WHERE c.relation = o.relation AND c.object = o.object)")
def compat_semi(spark, sf_dir):
    allowed = table(spark, sf_dir, "part").filter("p_size <= 10").select(F.col("p_type").alias("relation"), F.col("p_brand").alias("object")).distinct()
    return pools.compatible(orders(spark, sf_dir).select("scene", "relation", "object").distinct(), allowed, ["relation", "object"])


@query(f"WITH {DAYS} SELECT a.scene, a.event AS event_a, b.event AS event_b FROM e a JOIN e b ON a.scene = b.scene AND a.start < b.start AND a.event <> b.event")
def temporal_pairs(spark, sf_dir):
    return pools.before_pairs(first_events(spark, sf_dir), "scene", "event", "start").select("scene", "event_a", "event_b")


@query(f"WITH {DAYS} SELECT a.scene, a.event AS event_1, b.event AS event_2, c.event AS event_3 FROM e a JOIN e b ON a.scene = b.scene AND a.start < b.start JOIN e c ON c.scene = b.scene AND b.start < c.start WHERE a.event <> b.event AND c.event NOT IN (a.event, b.event)")
def temporal_chain3(spark, sf_dir):
    return pools.chains(first_events(spark, sf_dir), "scene", "event", "start", 3).select("scene", "event_1", "event_2", "event_3")


@query(f"WITH {DAYS} SELECT a.scene, a.event AS event_1, b.event AS event_2, c.event AS event_3, f.event AS event_4 FROM e a JOIN e b ON a.scene = b.scene AND a.start < b.start JOIN e c ON c.scene = b.scene AND b.start < c.start JOIN e f ON f.scene = c.scene AND c.start < f.start WHERE a.event <> b.event AND c.event NOT IN (a.event, b.event) AND f.event NOT IN (a.event, b.event, c.event)")
def temporal_chain4(spark, sf_dir):
    return pools.chains(first_events(spark, sf_dir), "scene", "event", "start", 4).select("scene", "event_1", "event_2", "event_3", "event_4")


@query(f"WITH {DAYS}, p AS (SELECT scene, start FROM e WHERE event = 'purchase') SELECT e.scene, e.event, CASE WHEN e.start < p.start THEN 'earlier' ELSE 'later' END AS side FROM e JOIN p USING (scene) WHERE e.event <> 'purchase'")
def earlier_later_split(spark, sf_dir):
    return pools.around(first_events(spark, sf_dir), "scene", "event", "start", F.col("event") == "purchase")


@query(f"WITH {DAYS} SELECT a.scene, a.event AS event_a, b.event AS event_b, count(*) AS n_after FROM e a JOIN e b ON a.scene = b.scene AND a.start < b.start AND a.event <> b.event JOIN e c ON c.scene = a.scene AND c.start > b.start AND c.event <> b.event GROUP BY ALL")
def after_events(spark, sf_dir):
    events = first_events(spark, sf_dir)
    pairs = pools.before_pairs(events, "scene", "event", "start")
    return pairs.join(events, "scene").filter("start > start_b and event <> event_b").groupBy("scene", "event_a", "event_b").agg(F.count("*").alias("n_after"))


@query(f"WITH {ORDERS}, t AS (SELECT DISTINCT scene, object, relation FROM o) SELECT a.scene, a.object, a.relation AS first, b.relation AS second FROM t a JOIN t b ON a.scene = b.scene AND a.object = b.object AND a.relation < b.relation")
def compositional_pairs(spark, sf_dir):
    return pools.joint(orders(spark, sf_dir), "scene", "object", "relation")


@query("SELECT DISTINCT a.p_brand AS brand, b.p_brand AS other, a.p_type AS type FROM part a JOIN part b ON a.p_type = b.p_type AND a.p_brand <> b.p_brand")
def verb_group_negatives(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), F.col("p_type").alias("type"))
    return pools.same_group(part, "brand", "type")


@query("SELECT c_custkey AS video_id, CASE WHEN row_number() OVER (ORDER BY md5('42|split|' || c_custkey), c_custkey) <= floor(0.1 * count(*) OVER ()) THEN 'val' ELSE 'train' END AS split FROM customer")
def split_assignment(spark, sf_dir):
    videos = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("video_id"))
    return planner.split_videos(videos, 42, 0.1)


@query("WITH s AS (SELECT c_custkey AS video_id, CASE WHEN row_number() OVER (ORDER BY md5('42|split|' || c_custkey), c_custkey) <= floor(0.1 * count(*) OVER ()) THEN 'val' ELSE 'train' END AS split FROM customer) SELECT count(*) AS n_both FROM (SELECT video_id FROM s WHERE split = 'val' INTERSECT SELECT video_id FROM s WHERE split = 'train')")
def split_disjoint_check(spark, sf_dir):
    s = split_assignment(spark, sf_dir)
    return s.filter("split = 'val'").select("video_id").intersect(s.filter("split = 'train'").select("video_id")).agg(F.count("*").alias("n_both"))


QUOTA_N = 10_000


@query(f"""
WITH w AS (SELECT * FROM (VALUES ('family', 'action', 2000), ('family', 'temporal', 2000), ('family', 'compositional', 2000), ('family', 'object', 1500), ('family', 'spatial_contact', 1500), ('family', 'grounding', 1000),
('task_type', 'single_choice', 4500), ('task_type', 'multi_label', 2000), ('task_type', 'binary', 2500), ('task_type', 'three_way', 1000),
('hops', '1', 2000), ('hops', '2', 3000), ('hops', '3', 3000), ('hops', '4', 2000), ('difficulty', 'easy', 2000), ('difficulty', 'medium', 4000), ('difficulty', 'hard', 4000),
('k', 'k_2', 2500), ('k', 'k_3', 1000), ('k', 'k_4_8', 2500), ('k', 'k_9_15', 2000), ('k', 'k_16_28', 1500), ('k', 'k_29_40', 500)) t(dimension, value, n))
SELECT dimension, value, n::BIGINT AS n FROM w""")
def quota_spec(spark, sf_dir):
    """The planned specification of 10,000 slots counted by each dimension; the quotas are exact."""
    from ..config import Config

    spec = planner.plan(spark, Config.load(), "train", QUOTA_N)
    bucket = F.expr("case when k = 2 then 'k_2' when k = 3 then 'k_3' when k <= 8 then 'k_4_8' when k <= 15 then 'k_9_15' when k <= 28 then 'k_16_28' else 'k_29_40' end")
    dims = {"family": F.col("family"), "task_type": F.col("task_type"), "hops": F.col("hops").cast("string"), "difficulty": F.col("difficulty"), "k": bucket}
    pairs = F.array(*(F.struct(F.lit(d).alias("dimension"), c.alias("value")) for d, c in dims.items()))
    return spec.select(F.inline(pairs)).groupBy("dimension", "value").agg(F.count("*").alias("n"))


@query("SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42|sample|' || doc_id), doc_id) AS r FROM documents) WHERE r <= 10")
def stratified_sample(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return planner.stratified(docs, "lang", "doc_id", 10, 42)


@query("SELECT min(doc_id) AS doc_id FROM documents GROUP BY text")
def first_wins_dedup(spark, sf_dir):
    keyed = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("key"))
    return dedup.first_wins(keyed, ["key"], ["doc_id"]).select("doc_id")


@query("SELECT a.doc_id FROM documents a WHERE a.source <> 'src0' AND NOT EXISTS (SELECT 1 FROM documents b WHERE b.source = 'src0' AND b.text = a.text)")
def resume_antijoin(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2("text", 256).alias("key"))
    return dedup.resume(docs.filter("source <> 'src0'"), docs.filter("source = 'src0'"), ["key"]).select("doc_id")


@query("SELECT lang, count(*) AS n, count(DISTINCT text) AS n_distinct, round(1 - count(DISTINCT text) / count(*), 6) AS duplicate_ratio FROM documents GROUP BY lang")
def duplicate_ratio(spark, sf_dir):
    keyed = table(spark, sf_dir, "documents").select("lang", F.sha2("text", 256).alias("key")).groupBy("lang", "key").agg(F.count("*").alias("n"))
    return keyed.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("n_distinct")).withColumn("duplicate_ratio", F.round(1 - F.col("n_distinct") / F.col("n"), 6))


@query(f"WITH {ORDERS}, s AS (SELECT scene, array_to_string(list_sort(list_distinct(list(object))), ',') || '_' || array_to_string(list_sort(list_distinct(list(relation))), ',') AS signature FROM o GROUP BY scene) SELECT count(*) AS n_scenes, count(DISTINCT signature) AS n_signatures, round(count(*) / count(DISTINCT signature), 6) AS per_signature, round(1 - count(DISTINCT signature) / count(*), 6) AS reuse FROM s")
def evidence_reuse(spark, sf_dir):
    sets = orders(spark, sf_dir).groupBy("scene").agg(F.collect_set("object").alias("o"), F.collect_set("relation").alias("r"))
    signature = dedup.evidence_signature(F.col("o"), F.col("r"), F.array().cast("array<string>"))
    counts = sets.groupBy(signature.alias("s")).agg(F.count("*").alias("n")).agg(F.sum("n").alias("n_scenes"), F.count("*").alias("n_signatures"))
    ratio = F.col("n_signatures") / F.col("n_scenes")
    return counts.withColumn("per_signature", F.round(1 / ratio, 6)).withColumn("reuse", F.round(1 - ratio, 6))


@query("SELECT event_type AS family, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM events GROUP BY event_type")
def family_share(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("family")).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(W.partitionBy()), 6))


@query("SELECT l_returnflag AS flag, l_linestatus AS status, p_type AS type, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), (p_type), ())")
def distribution_sets(spark, sf_dir):
    lines, parts = table(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")), table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("type"))
    rows = lines.join(parts, lines.l_partkey == parts.p_partkey)
    flag, status, kind = (F.col(c) for c in ("flag", "status", "type"))
    return rows.groupingSets([[flag], [status], [kind], []], flag, status, kind).agg(F.count("*").alias("n"))


@query(f"WITH {ORDERS} SELECT count(DISTINCT object) AS n_objects, count(DISTINCT object || '|' || relation || '|' || flag) AS n_signatures, (SELECT count(DISTINCT s) FROM (SELECT array_to_string(list_sort(list_distinct(list(object))), ',') AS s FROM o GROUP BY scene)) AS n_option_sets FROM o")
def distinct_signatures(spark, sf_dir):
    rows = orders(spark, sf_dir)
    one = rows.agg(F.count_distinct("object").alias("n_objects"), F.count_distinct("object", "relation", "flag").alias("n_signatures"))
    sets = rows.groupBy("scene").agg(F.array_join(F.sort_array(F.collect_set("object")), ",").alias("s")).agg(F.count_distinct("s").alias("n_option_sets"))
    return one.withColumn("k", F.lit(1)).join(sets.withColumn("k", F.lit(1)), "k").drop("k")


@query(f"""WITH {ORDERS}, v AS (SELECT DISTINCT p_brand AS object FROM part), a AS (SELECT s.scene, list(v.object ORDER BY v.object) AS absent FROM (SELECT DISTINCT scene FROM o) s CROSS JOIN v WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.scene = s.scene AND o.object = v.object) GROUP BY s.scene)
SELECT scene, absent[1 + floor((('0x' || substr(md5('42|false_object|' || scene), 1, 13))::BIGINT / 4503599627370496.0) * len(absent))::INT] AS object FROM a""")
def false_object_pick(spark, sf_dir):
    return pools.false_object(orders(spark, sf_dir), "scene", "object", values(table(spark, sf_dir, "part"), "p_brand"), 42)


@query("SELECT DISTINCT p_type AS noun, 'This region contains the ' || p_type || '.' AS positive, 'This region does not contain the ' || p_type || '.' AS negative FROM part")
def render_grounding(spark, sf_dir):
    nouns = table(spark, sf_dir, "part").select(F.col("p_type").alias("noun")).distinct()
    return nouns.select("noun", render.grounding(F.col("noun")).alias("positive"), render.grounding(F.col("noun"), negative=True).alias("negative"))


@query("SELECT event_type AS rule, event_id, r AS rank FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS r FROM events) WHERE r <= 5")
def top5_per_rule(spark, sf_dir):
    rank = F.row_number().over(W.partitionBy("event_type").orderBy("ts", "event_id"))
    return table(spark, sf_dir, "events").select("event_type", "event_id", "ts").withColumn("rank", rank).filter("rank <= 5").select(F.col("event_type").alias("rule"), "event_id", "rank")


@query("""SELECT DISTINCT p_type AS noun, p_brand AS brand, upper(substr(x, 1, 1)) || lower(substr(x, 2)) || ' is present.' AS positive, upper(substr(x, 1, 1)) || lower(substr(x, 2)) || ' is not present.' AS negative
FROM (SELECT *, CASE WHEN lower(substr(p_type, 1, 1)) IN ('a', 'e', 'i', 'o', 'u') THEN 'an ' ELSE 'a ' END || p_type AS x FROM part)""")
def render_existence(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_type").alias("noun"), F.col("p_brand").alias("brand")).distinct()
    return rows.withColumn("positive", render.existence(F.col("noun"))).withColumn("negative", render.existence(F.col("noun"), negative=True))


@query(f"WITH {DAYS} SELECT DISTINCT 'The person is ' || a.event || ' before ' || b.event || '.' AS positive, 'The person is not ' || a.event || ' before ' || b.event || '.' AS negative FROM e a JOIN e b ON a.scene = b.scene AND a.start < b.start AND a.event <> b.event")
def render_temporal(spark, sf_dir):
    pairs = pools.before_pairs(first_events(spark, sf_dir), "scene", "event", "start").select("event_a", "event_b").distinct()
    a, b = F.concat(F.lit("The person is "), F.col("event_a"), F.lit(".")), F.col("event_b")
    return pairs.select(render.temporal(a, b).alias("positive"), render.temporal(a, b, negative=True).alias("negative"))


@query("SELECT DISTINCT 'The person is ' || p_type || ' the ' || p_brand || '.' AS positive, 'The person is not ' || p_type || ' the ' || p_brand || '.' AS negative FROM part")
def render_relation(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_type", "p_brand").distinct()
    return rows.select(render.relation(F.col("p_type"), F.col("p_brand")).alias("positive"), render.relation(F.col("p_type"), F.col("p_brand"), negative=True).alias("negative"))


@query("SELECT event_type AS family, count(*) FILTER (value IS NULL OR value < 10) AS none_true, count(*) FILTER (value >= 10) AS none_false, count(*) AS n FROM events GROUP BY event_type")
def bool_mix(spark, sf_dir):
    low = F.col("value").isNull() | (F.col("value") < 10)
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("family")).agg(F.count_if(low).alias("none_true"), F.count_if(~low).alias("none_false"), F.count("*").alias("n"))


def drawn(sql_scene: str, what: str) -> str:
    return f"md5('42|{what}|' || {sql_scene} || '|' || event)"


def uniform_sql(what: str) -> str:
    return f"(('0x' || substr(md5('42|{what}|' || scene), 1, 13))::BIGINT / 4503599627370496.0)"


CLAIMS = f"""
WITH {DAYS}, v AS (SELECT DISTINCT event FROM e),
t AS (SELECT scene, list(event ORDER BY md5('42|true|' || scene || '|' || event)) AS truths FROM e GROUP BY scene),
f AS (SELECT s.scene, list(v.event ORDER BY md5('42|false|' || s.scene || '|' || v.event)) AS falses FROM (SELECT DISTINCT scene FROM e) s CROSS JOIN v WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.scene = s.scene AND e.event = v.event) GROUP BY s.scene),
c AS (SELECT scene, truths, coalesce(falses, []) AS falses FROM t LEFT JOIN f USING (scene))"""


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(scene, truths, falses): events that a scene has and lacks, each in a drawn order."""
    vocabulary = values(table(spark, sf_dir, "events"), "event_type")
    sets = pools.present_sets(days(spark, sf_dir), "scene", "event", "truths")
    order = lambda items, what: F.transform(F.array_sort(F.transform(items, lambda x: F.struct(rand.key(42, what, F.col("scene"), x).alias("h"), x.alias("x")))), lambda s: s.x)
    return sets.select("scene", order(F.col("truths"), "true").alias("truths"), order(F.array_except(pools.literals(vocabulary), "truths"), "false").alias("falses"))


@query(f"""{CLAIMS}, b AS (SELECT scene, CASE WHEN {uniform_sql("coin")} >= 0.5 OR len(falses) = 0 THEN 1 ELSE 0 END AS positive, truths, falses FROM c)
SELECT scene, positive::INT AS label, CASE WHEN positive = 1 THEN truths[1] ELSE falses[1] END AS event, 'The person is ' || CASE WHEN positive = 1 THEN truths[1] ELSE falses[1] END || '.' AS statement FROM b""")
def binary_claims(spark, sf_dir):
    positive = (rand.uniform(42, "coin", F.col("scene")) >= 0.5) | (F.size("falses") == 0)
    event = F.when(positive, F.get("truths", F.lit(0))).otherwise(F.get("falses", F.lit(0)))
    return claims(spark, sf_dir).select("scene", positive.cast("int").alias("label"), event.alias("event"), render.action(event).alias("statement"))


@query(f"{CLAIMS} SELECT scene, truths[1] AS answer, array_to_string(list_sort(list_concat([truths[1]], falses[1:3])), '|') AS options, (1 + least(3, len(falses)))::INT AS option_count FROM c WHERE len(falses) > 0")
def single_choice_claims(spark, sf_dir):
    answer, others = F.get("truths", F.lit(0)), F.slice("falses", 1, 3)
    return claims(spark, sf_dir).filter(F.size("falses") > 0).select("scene", answer.alias("answer"), F.array_join(F.sort_array(F.concat(F.array(answer), others)), "|").alias("options"), (1 + F.size(others)).alias("option_count"))


@query(f"""{CLAIMS}, m AS (SELECT *, CASE WHEN {uniform_sql("zero")} < 0.2 THEN 0 ELSE 1 + floor({uniform_sql("count")} * least(len(truths), 3))::INT END AS n_true FROM c)
SELECT scene, n_true::INT AS n_true, array_to_string(list_sort(truths[1:n_true]), '|') AS trues, array_to_string(list_sort(falses[1:4 - n_true]), '|') AS falses, ({uniform_sql("none")} < 0.7) AS has_none FROM m""")
def multi_label_claims(spark, sf_dir):
    scene = F.col("scene")
    n_true = F.when(rand.uniform(42, "zero", scene) < 0.2, 0).otherwise(rand.integer(1, F.least(F.size("truths"), F.lit(3)), 42, "count", scene))
    rows = claims(spark, sf_dir).withColumn("n_true", n_true.cast("int"))
    return rows.select("scene", "n_true", F.array_join(F.sort_array(F.slice("truths", F.lit(1), F.col("n_true"))), "|").alias("trues"), F.array_join(F.sort_array(F.slice("falses", F.lit(1), 4 - F.col("n_true"))), "|").alias("falses"), (rand.uniform(42, "none", scene) < 0.7).alias("has_none"))


@query(f"""{CLAIMS}, w AS (SELECT *, CASE WHEN len(falses) = 0 THEN 'TRUE' WHEN {uniform_sql("unknown")} < 0.2 THEN 'UNKNOWN' WHEN {uniform_sql("truth")} >= 0.5 THEN 'TRUE' ELSE 'FALSE' END AS truth FROM c)
SELECT scene, truth, 'Is the person ' || CASE WHEN truth = 'TRUE' THEN truths[1] ELSE falses[1] END || '?' AS question, CASE truth WHEN 'TRUE' THEN 'Yes' WHEN 'FALSE' THEN 'No' ELSE 'Cannot say' END AS answer FROM w""")
def three_way_claims(spark, sf_dir):
    scene = F.col("scene")
    truth = F.when(F.size("falses") == 0, "TRUE").when(rand.uniform(42, "unknown", scene) < 0.2, "UNKNOWN").when(rand.uniform(42, "truth", scene) >= 0.5, "TRUE").otherwise("FALSE")
    rows = claims(spark, sf_dir).withColumn("truth", truth)
    event = F.when(F.col("truth") == "TRUE", F.get("truths", F.lit(0))).otherwise(F.get("falses", F.lit(0)))
    answer = F.when(F.col("truth") == "TRUE", "Yes").when(F.col("truth") == "FALSE", "No").otherwise("Cannot say")
    return rows.select("scene", "truth", F.concat(F.lit("Is the person "), event, F.lit("?")).alias("question"), answer.alias("answer"))


@query(f"{CLAIMS} SELECT truth, count(*) AS n FROM (SELECT unnest(list_concat(list_transform(truths, lambda x: 'TRUE'), list_transform(falses, lambda x: 'FALSE'))) AS truth FROM c) GROUP BY truth")
def option_truth_counts(spark, sf_dir):
    states = F.concat(F.transform("truths", lambda x: F.lit("TRUE")), F.transform("falses", lambda x: F.lit("FALSE")))
    return claims(spark, sf_dir).select(F.explode(states).alias("truth")).groupBy("truth").agg(F.count("*").alias("n"))
