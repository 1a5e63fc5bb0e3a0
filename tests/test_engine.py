"""The scene-graph engine: fixtures worked out by hand, invariants over random graphs."""

import dataclasses
import itertools
import json
import re
import time
from collections import Counter

import pytest
from conftest import action, fixture_video, frame, random_videos, vertex
from pyspark.sql import functions as F

from claimforge.config import Config
from claimforge.functions import rand, render, templates
from claimforge.operators import dedup, generate, normalize, planner, pools, validate
from claimforge.plans import engine
from claimforge.schemas import OPTION, SINK
from claimforge.sources import scene_graphs, sink
from claimforge.vocab import ACTION_IDS, ACTIONS, EXCLUSIVE, OBJECT_NAMES, RELATION_NAMES, VERB_GROUP, compatible, fits_name


def test_vocabulary_sizes():
    assert (len(ACTIONS), len(ACTION_IDS), len(OBJECT_NAMES), len(RELATION_NAMES), len(VERB_GROUP)) == (141, 141, 27, 24, 118)
    assert not fits_name("r5", "o8") and fits_name("r5", "o17") and not fits_name("r21", "o3") and compatible("r21", "o3") and not compatible("r24", "o8")
    assert sum(map(len, templates.TEMPLATES.values())) == 315 and len(EXCLUSIVE) == 4


def test_config():
    c = Config.load()
    assert c.targets() == {"train": 80_000, "val": 10_000, "test": 10_000} and c.output("val").endswith("/100k/val")
    for scale, n in (("10k", 8000), ("1m", 800_000), ("100m", 80_000_000)):
        assert Config.load({"scale": scale}).targets()["train"] == n
    with pytest.raises(ValueError, match="must sum to 1.0"):
        Config.load({"distributions": {"task_modalities": {"binary": 0.7}}})
    with pytest.raises(TypeError):
        Config.load(3)


def test_normalized_fixture(spark, raw):
    g = normalize.normalize(raw([fixture_video()]))
    p = normalize.wide_pools(g).first()
    assert (g.frames.count(), g.objects.count(), g.relations.count(), g.actions.count()) == (3, 9, 12, 2)
    assert p.present_objects == ["o17", "o36", "o8"] and len(p.present_relations) == 4 and len(p.frames) == 3
    assert [a.phrase for a in p.actions] == ["sitting in a chair", "watching outside of a window"]
    named = g.objects.select("video_id", "name")
    assert pools.absent(named, "video_id", "name", OBJECT_NAMES).count() == 24
    assert pools.absent(g.actions, "video_id", "phrase", ACTIONS).count() == 139
    assert [tuple(r)[2:] for r in pools.joint(g.relations, "video_id", "target_class", "class_id").collect()] == [("r1", "r15")]
    assert pools.before_pairs(g.actions, "video_id", "phrase", "start_secs").count() == 1
    assert pools.chains(g.actions, "video_id", "phrase", "start_secs", 3).count() == 0


def test_normalization_defaults(spark, raw):
    video = {"video_id": "v", "entries": {"f": {"type": "frame", "vertices": [{"class": "o99"}, {"id": "x", "class": "o8", "bbox": [1.0]}, {"id": "x", "class": "o9"}]}, "g": {"type": "other"}, "h": None, "a": {"type": "action"}}}
    g = normalize.normalize(raw([video, {"video_id": None, "entries": {}}, {"video_id": "none", "entries": None}]))
    assert {(r.obj_id, r.name, r.bbox) for r in g.objects.collect()} == {("", "o99", None), ("x", "closet/cabinet", None)}
    assert [tuple(r) for r in g.frames.select("frame_id", "secs").collect()] == [("f", 0.0)] and g.splits.first().split == "unknown"
    assert [(r.action_id, r.phrase, r.start_secs) for r in g.actions.collect()] == [("a", "", 0.0)]
    assert normalize.wide_pools(normalize.normalize(raw([]))).count() == 0


def test_quotas_are_exact(spark):
    for n in (1, 7, 999, 1000):
        rows = planner.plan(spark, Config.load(), "train", n).collect()
        for name, shares in (("task_type", "task_modalities"), ("family", "reasoning_families"), ("difficulty", "negative_difficulty")):
            want = {k: v for k, v in planner.quotas(Config.load().distribution(shares), n).items() if v}
            got = {}
            for r in rows:
                got[r[name]] = got.get(r[name], 0) + 1
            assert got == want
        for r in rows:
            assert (r.k == 2) if r.task_type == "binary" else (r.k == 3) if r.task_type == "three_way" else 4 <= r.k <= 40
            assert 1 <= r.hops <= 4
    assert planner.plan(spark, Config.load(), "train", 0).count() == 0


def test_places_are_bijections(spark):
    for n in (1, 2, 3, 97, 7919):
        assert sorted(r[0] for r in spark.range(n).select(planner.place(F.col("id"), n, 42, "x")).collect()) == list(range(n))
    # by plain arithmetic
    def place(x, n):
        for k, a, b in planner.rounds(42, "x"):
            partner = (k - x) % n
            u = (max(x, partner) * a + b) % planner.PRIME
            x = partner if (u * u + a) % planner.PRIME // 8 % 2 else x
        return x

    assert [r[0] for r in spark.range(500).select(planner.place(F.col("id"), 500, 42, "x")).collect()] == [place(x, 500) for x in range(500)]


@pytest.mark.parametrize("seed", [42, 7, 2024])
def test_plan_dimensions_are_independent(spark, seed):
    """Chi-square of every two dimensions, at a bound that one of many tables may reach once in thousands of runs."""
    n = 8000
    rows = planner.plan(spark, Config.load({"generation": {"seed": seed}}), "train", n).select("family", "task_type", "hops", "difficulty").collect()
    for a, b in itertools.combinations(("family", "task_type", "hops", "difficulty"), 2):
        left, right, both = (Counter(x) for x in zip(*((r[a], r[b], (r[a], r[b])) for r in rows)))
        chi = sum((both[i, j] - left[i] * right[j] / n) ** 2 / (left[i] * right[j] / n) for i in left for j in right)
        free = (len(left) - 1) * (len(right) - 1)
        assert len(both) == len(left) * len(right) and chi < free + 6 * (2 * free) ** 0.5, (a, b, chi, free)


def test_videos_are_used_evenly(spark):
    videos = spark.range(7).select(F.concat(F.lit("v"), "id").alias("video_id"), F.lit("train").alias("split")).union(spark.createDataFrame([("w", "val")], "video_id string, split string"))
    spec = spark.range(70).select(F.col("id").alias("slot_id"), F.explode(F.array(F.lit(0), F.lit(1))).alias("attempt")).select("*", F.explode(F.array(*map(F.lit, ("train", "val", "test")))).alias("split"))
    rows = planner.assign_videos(spec, videos, 42).collect()
    assert len(rows) == 280 and Counter(r.video_id for r in rows if r.split == "train") == {f"v{i}": 20 for i in range(7)} and {r.video_id for r in rows if r.split == "val"} == {"w"}
    for k in range(10):
        assert len({r.video_id for r in rows if r.split == "train" and r.attempt == 0 and 7 * k <= r.slot_id < 7 * k + 7}) == 7
    first = {(r.slot_id, r.video_id) for r in rows if r.split == "train" and r.attempt == 0}
    assert not first & {(r.slot_id, r.video_id) for r in rows if r.split == "train" and r.attempt == 1}


def test_split_does_not_depend_on_partitions(spark):
    ids = spark.range(500).select(F.concat(F.lit("v"), "id").alias("video_id"))
    a, b = ({tuple(r) for r in planner.split_videos(ids.repartition(n), 42, 0.1).collect()} for n in (1, 7))
    assert a == b and sum(s == "val" for _, s in a) == 50 and len(a) == 500


def test_rendering(spark):
    row = spark.createDataFrame([("clothes", "umbrella", "have it on the back", "not looking at", "The person is eating.", "")], "a string, b string, r string, n string, e string, z string").select(
        render.existence(F.col("a")), render.existence(F.col("b"), True), render.relation(F.col("r"), F.col("b")), render.relation(F.col("n"), F.col("a"), True), render.temporal(F.col("e"), F.col("b"), "after"), render.action(F.col("z")), render.noun_phrase(F.col("z")), render.grounding(F.col("b"), True),
    )
    assert list(row.first()) == ["Clothes are present.", "An umbrella is not present.", "The person is carrying on their back the umbrella.", "The person is looking at the clothes.", "The person is eating after umbrella.", "The person is doing something.", "something", "This region does not contain the umbrella."]


def test_keyed_draws(spark):
    df = spark.range(2000).select("id", rand.uniform(1, F.col("id")).alias("u"), rand.integer(3, 5, 2, F.col("id")).alias("i"), rand.sample(F.array(*map(F.lit, range(6))), 4, 3, F.col("id")).alias("s"), rand.pick(F.array().cast("array<int>"), 4).alias("none"))
    rows = df.collect()
    assert 0.45 < sum(r.u for r in rows) / 2000 < 0.55 and {r.i for r in rows} == {3, 4, 5}
    assert all(len(set(r.s)) == 4 for r in rows) and rows[0].none is None


@pytest.fixture(scope="module")
def made(spark, raw, tmp_path_factory):
    """All families and tasks over random graphs, in both semantics."""
    at = tmp_path_factory.mktemp("made")
    graphs = raw(random_videos(60))
    p = engine.written(normalize.wide_pools(normalize.normalize(graphs)), f"{at}/p")
    videos = engine.written(planner.split_videos(graphs, 1, 0.2), f"{at}/v")
    slots = engine.written(planner.assign_videos(planner.plan(spark, Config.load(), "train", 400).withColumn("attempt", F.lit(0)), videos, 1), f"{at}/s")
    return {strict: engine.written(validate.validate(generate.generate(slots, p, 42, strict)), f"{at}/{strict}") for strict in (False, True)}


def test_claims_hold_their_invariants(made):
    for strict, df in made.items():
        rows = df.collect()
        assert {r.family for r in rows} == {f for f, x in generate.FAMILIES.items() if x} and {r.task_type for r in rows} == set(generate.TASKS) and len({r.generation_rule for r in rows}) == 24
        assert len(rows) > 250 and sum(r.is_valid for r in rows) > 0.9 * len(rows)
        for r in rows:
            labels = [p.label for p in r.propositions]
            assert len(labels) >= 2 and set(labels) <= {0, 1} and {p.truth_state for p in r.propositions} <= {"TRUE", "FALSE", "UNKNOWN"}
            assert r.task_type == "multi_label" or sum(labels) == 1
            assert r.example_id.split("_" + r.video_id)[0].split("_")[0] in r.example_id
        if strict:
            # the random graphs can hold an object above and beneath at once; nothing else may be wrong
            assert all(e.startswith("exclusive relations") for r in rows for e in r.errors)


def test_strict_labels_agree_with_the_evidence(made, spark, raw):
    truth = {}
    for v in random_videos(60):
        frames = [e for e in v["entries"].values() if e["type"] == "frame"]
        truth[v["video_id"]] = {x["class"] for f in frames for x in f["vertices"]}, {e["phrase"] for e in v["entries"].values() if e["type"] == "action"}
    from claimforge.vocab import OBJECTS

    for r in made[True].collect():
        classes, phrases = truth[r.video_id]
        names = {OBJECTS[c] for c in classes}
        for p in r.propositions:
            s = p.semantics
            if p.truth_state == "UNKNOWN" or s.canonical_type not in ("object_existence", "action"):
                continue
            present = s.subject in names if s.canonical_type == "object_existence" else s.predicate in phrases
            assert (p.truth_state == "TRUE") == (present == (s.polarity == "positive"))


VALID = [("Yes", "TRUE", 1, "positive", "relation", "holding"), ("No", "FALSE", 0, "negative", "relation", "holding")]


def checked(spark, options, task="single_choice", template=None, reasoning=("relation_verification", "contact")):
    rows = [(t, s, l, (k, "person", p, "bag", pol, None, None, None)) for t, s, l, pol, k, p in options]
    row = [("e", task, template, (*reasoning,), rows)]
    df = spark.createDataFrame(row, f"example_id string, task_type string, query_template_id string, reasoning struct<type:string,family:string>, propositions array<{OPTION}>")
    return validate.validate(df).first().errors


def test_validator(spark):
    other = ("Other", "TRUE", 1, "positive", "relation", "wearing")
    none = lambda label: ("None", "TRUE" if label else "FALSE", label, "positive", "logical_none", None)
    assert checked(spark, VALID, "binary") == []
    assert "Proposition count" in checked(spark, VALID[:1], "binary")[0]
    assert "exactly 1 correct" in checked(spark, [*VALID, other])[0]
    assert checked(spark, [VALID[0], ("x", "FALSE", 0, "positive", "relation", "holding")]) == ["one statement is both asserted and denied"]
    both = [("a", "TRUE", 1, "positive", "relation", "above"), ("b", "TRUE", 1, "positive", "relation", "beneath")]
    assert len(checked(spark, both, "multi_label")) == 2 and all("exclusive" in e for e in checked(spark, both, "multi_label"))
    assert "beside another" in checked(spark, [VALID[0], none(1)], "multi_label")[0] and "no option is right" in checked(spark, [VALID[1], none(0)], "multi_label")[0]
    wide = [(f"t{i}", "FALSE", 0, "positive", "relation", f"p{i}") for i in range(40)] + [other]
    assert checked(spark, wide, "multi_label") == ["Proposition count 41 is not within 2 to 40"]
    assert "three_way" in checked(spark, VALID, "three_way")[0]
    texts = [("", "TRUE", 1, "positive", "relation", "a"), ("see o12", "FALSE", 0, "positive", "relation", "b"), ("is not not so", "FALSE", 0, "positive", "relation", "c"), ("A food", "FALSE", 0, "positive", "relation", "d"), ("A food", "FALSE", 0, "positive", "relation", "e")]
    assert checked(spark, texts) == ["two options read the same", "an option without text", "an id in a text", "an article before an uncountable noun", "an article before an uncountable noun", "a negation of a negation"]
    assert checked(spark, VALID, "binary", "obj_s01") == ["template: a yes-or-no claim on relations has another family's question"]
    assert checked(spark, VALID, "binary", "rel_v01") == [] and checked(spark, VALID, "binary", "x", ("object_existence", "object")) == ["template: a yes-or-no claim on objects has another family's question"]


def test_first_wins_and_resume(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), (None, 4)], "key string, slot int")
    assert {tuple(r) for r in dedup.first_wins(df, ["key"], ["slot"]).collect()} == {("a", 1), ("b", 3), (None, 4)}
    assert {r.slot for r in dedup.resume(df, spark.createDataFrame([("a",)], "key string"), ["key"]).collect()} == {3, 4}


def test_engine_end_to_end(spark, raw, tmp_path):
    config = Config.load({"splits": {"target_counts": {"train": 60, "val": 10}}, "generation": {"rounds": 1, "shard_size": 20}, "paths": {"output_dir": str(tmp_path)}})
    result = engine.run(spark, config, raw(random_videos(40)))
    s = result.stats
    assert s["candidates"] == s["accepted"] + s["rejected"] + s["duplicates"] and s["accepted"] + s["shortfall"] == 70 and s["accepted"] > 45
    engine.publish(spark, config, result)
    shards = spark.read.parquet(f"{config.output()}/train")
    assert [f.name for f in shards.schema] == [c.strip().split(" ")[0] for c in SINK.split(", ")]
    assert shards.filter("size(options) <> size(labels) or size(options) <> option_count or split <> 'train' or trim(video_id) = ''").count() == 0
    manifest = json.loads((tmp_path / "100k" / "manifest.json").read_text())
    assert manifest["total_examples"] == s["accepted"] == sum(manifest["task_types"].values())
    assert "Accepted" in (tmp_path / "100k" / "VALIDATION_REPORT.md").read_text()
    keys = sink.existing_keys(spark, config.output())
    assert keys.count() == s["accepted"] and keys.select("key").distinct().count() == s["accepted"]
    with pytest.raises(Exception, match="video_id"):
        sink.rows(result.accepted.withColumn("video_id", F.lit(" "))).collect()


def test_shards_are_numbered(made, spark, tmp_path):
    rows = made[False].filter("is_valid")
    n = rows.count()
    for _ in range(2):
        sink.write(rows, str(tmp_path), 40)
    names = sorted(p.name for p in (tmp_path / "train").iterdir() if p.name.startswith("part-"))
    assert names == [f"part-{k:06}.parquet" for k in range(len(names))] and len(names) >= 2 * n // 40
    assert spark.read.parquet(f"{tmp_path}/train").count() == 2 * n and not list(tmp_path.glob("_new*"))
    assert sink.existing_keys(spark, str(tmp_path)).count() == 2 * n


def test_shards_are_moved_side_by_side(spark, tmp_path, monkeypatch):
    """A move waits for the file system; a run of many shards does not add up all waits. A move that fails is an error."""
    under_way, most, hadoop = [], [], sink.hadoop

    class Slow:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            under_way.append(a)
            time.sleep(0.2)
            most.append(len(under_way))
            under_way.remove(a)
            return not b.toString().startswith(f"{tmp_path}/bad") and self.fs.rename(a, b)

    monkeypatch.setattr(sink, "hadoop", lambda spark, path: (Slow(hadoop(spark, path)[0]), hadoop(spark, path)[1]))
    option = "array(named_struct('text', concat('o', id), 'truth_state', 'TRUE', 'label', 1Y)) AS propositions"
    rows = spark.range(12).selectExpr("concat('e', id) AS example_id", "'train' AS split", "concat('v', id) AS video_id", "'q' AS query_text", option, "'binary' AS task_type", "named_struct('family', 'object') AS reasoning", "'g' AS generator_family")
    sink.write(rows, f"{tmp_path}/good", 1)
    assert max(most) > 1 and sorted(p.name for p in (tmp_path / "good" / "train").glob("part-*")) == [f"part-{k:06}.parquet" for k in range(12)]
    assert sink.existing_keys(spark, f"{tmp_path}/good").distinct().count() == 12
    with pytest.raises(OSError, match="could not be moved"):
        sink.write(rows, f"{tmp_path}/bad", 1)


def test_export_and_subtypes(made, spark):
    rows = made[False]
    one = json.loads(sink.as_json(rows).first().json)
    assert one["propositions"][0]["semantics"]["canonical_type"] and one["example_id"]
    found = {(r.kind, r.value): r.n for r in sink.subtypes_table(rows).collect()}
    want = Counter()
    for r in rows.collect():
        if r.reasoning.family == "temporal":
            true = [p.semantics.temporal_relation for p in r.propositions if p.semantics.canonical_type == "temporal" and p.truth_state == "TRUE"]
            want["temporal_subtypes", "multihop" if "multihop" in r.reasoning.type else true[0] if true else "unknown"] += 1
            want["temporal_hops", str(r.reasoning.hops)] += 1
        for part in ("identification", "verification"):
            if r.reasoning.family == "grounding" and part in r.reasoning.type:
                want["grounding_subtypes", part] += 1
    assert found == want


def test_a_family_of_an_application(made, spark, raw, monkeypatch):
    """A family that is registered gives claims like the others; known ones without a function give none."""
    own = generate.FAMILIES["object"]
    state = lambda x, task, negative: F.concat(F.lit("No " if negative else "A "), x.subject)
    monkeypatch.setitem(generate.FAMILIES, "thing", dataclasses.replace(own, prefix="thing", rule="own_thing", state=state, none="Nothing of these."))
    pools_ = normalize.wide_pools(normalize.normalize(raw([fixture_video()])))
    slots = spark.createDataFrame([("train", k, 0, f, t, 4, 1, "easy", "SYNTH_VID_001") for k, (f, t) in enumerate(itertools.product(("thing", "attribute", "relation_set", "original_qa", "unheard"), generate.TASKS))], "split string, slot_id long, attempt int, family string, task_type string, k int, hops int, difficulty string, video_id string")
    rows = generate.generate(slots, pools_).collect()
    assert {r.family for r in rows} == {"thing"} and len(rows) == 4
    assert all(p.text.startswith(("A ", "No ", "Nothing", "Yes", "Cannot")) or p.text == "No" for r in rows for p in r.propositions)


def test_untargeted_slots(spark, raw):
    pools_ = normalize.wide_pools(normalize.normalize(raw([fixture_video(), {"video_id": "one", "entries": dict([action(1, "standing up", 0, 1)])}])))
    slots = spark.range(1000).select(F.lit("train").alias("split"), F.col("id").alias("slot_id"), F.lit(0).alias("attempt"), F.when(F.col("id") < 900, generate.UNTARGETED).otherwise("object").alias("family"), F.when(F.col("id") % 3 == 0, "one").otherwise("SYNTH_VID_001").alias("video_id"))
    n = Counter((r.video_id, r.family) for r in generate.route(slots, pools_).collect())
    assert n["one", "action"] == 300 and n["one", "temporal"] == 0 and 0.55 < n["SYNTH_VID_001", "temporal"] / 600 < 0.65 and n["one", "object"] + n["SYNTH_VID_001", "object"] == 100


#: Two of the families, for small plans.
TWO = {"action": 0.0, "temporal": 0.0, "compositional": 0.0, "object": 0.5, "spatial_contact": 0.0, "grounding": 0.5}


def test_command_line(tmp_path, spark, capsys):
    from claimforge import cli

    (tmp_path / "graphs").mkdir()
    (tmp_path / "graphs" / "a.jsonl").write_text("".join(json.dumps(v) + "\n" for v in random_videos(12)))
    (tmp_path / "c.yaml").write_text(f"splits:\n  target_counts: {{train: 12, val: 4}}\ngeneration:\n  rounds: 1\npaths:\n  output_dir: {tmp_path}/out\ndistributions:\n  reasoning_families: {json.dumps(TWO)}\n")
    arguments = ["--config", f"{tmp_path}/c.yaml", "--train", f"{tmp_path}/graphs/a.jsonl", "--scale", "10k"]
    first = cli.main(arguments)
    assert "round 0" in capsys.readouterr().out and {p.name for p in (tmp_path / "out" / "10k").iterdir()} >= {"train", "manifest.json", "SAMPLE_REPORT.md", "VALIDATION_REPORT.md", "SPLIT_REPORT.md", "DIVERSITY_REPORT.md"}
    n = spark.read.parquet(f"{tmp_path}/out/10k/train").count()
    again = cli.main([*arguments, "--resume"])
    keys = sink.existing_keys(spark, f"{tmp_path}/out/10k")
    assert spark.read.parquet(f"{tmp_path}/out/10k/train").count() >= n and keys.count() == keys.distinct().count() == first.stats["accepted"] + again.stats["accepted"]


def test_scene_graphs_as_they_arrive(spark, tmp_path):
    from claimforge.streaming import ingest

    config = Config.load({"distributions": {"reasoning_families": TWO}})
    videos = random_videos(8)
    (tmp_path / "in").mkdir()
    run = lambda: ingest.start(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state", config, per_video=2).awaitTermination()
    write = lambda name, vs: (tmp_path / "in" / name).write_text("".join(json.dumps(v) + "\n" for v in vs))
    write("a.json", videos[:5])
    run()
    first = spark.read.parquet(f"{tmp_path}/out/train")
    ids = {r.video_id for r in first.collect()}
    assert 0 < len(ids) <= 5 and ids <= {v["video_id"] for v in videos[:5]}
    # videos that come again add nothing, new ones do
    write("b.json", videos[3:])
    run()
    both = spark.read.parquet(f"{tmp_path}/out/train").collect()
    assert {r.video_id for r in both if r.batch > 0} <= {v["video_id"] for v in videos[5:]} and len({r.batch for r in both}) == 2
    run()
    assert spark.read.parquet(f"{tmp_path}/out/train").count() == len(both)
    counts = ingest.windowed_counts(spark.readStream.schema("ts timestamp, event_type string").json(f"{tmp_path}/in"))
    assert counts.isStreaming and counts.columns == ["window", "event_type", "n"]


def test_sources(spark, tmp_path):
    import pickle

    graph = {"f1": {"type": "frame", "id": "f1", "secs": 1, "metadata": {"set": "train"}, "objects": {"vertices": [{"id": "x", "class": "o8", "bbox": (0, 0, 1, 1), "contact": [{"id": "r", "class": "r15", "objects": [{"class": "o8"}]}]}]}}, "junk": 3, "a": {"type": "action", "phrase": "standing up", "start": 1, "end": 2}}
    (tmp_path / "g.pkl").write_bytes(pickle.dumps({"v1": graph, "v2": {}}))
    assert scene_graphs.convert_pickle(str(tmp_path / "g.pkl"), str(tmp_path / "g.jsonl")) == 2
    g = normalize.normalize(scene_graphs.read(spark, str(tmp_path / "g.jsonl")))
    assert g.objects.first().bbox == [0, 0, 1, 1] and g.relations.first().name == "holding" and g.actions.first().phrase == "standing up" and g.splits.first().split == "train"
    (tmp_path / "bad.pkl").write_bytes(pickle.dumps(Config))
    with pytest.raises(pickle.UnpicklingError):
        scene_graphs.convert_pickle(str(tmp_path / "bad.pkl"), str(tmp_path / "x"))
    table = {f"q{i}": {"question": "é" * i, "n": i} for i in range(300)}
    (tmp_path / "q.json").write_text(json.dumps(table, indent=1))
    assert dict(scene_graphs.stream_questions(str(tmp_path / "q.json"))) == table
    assert scene_graphs.questions(spark, str(tmp_path / "q.json"), "struct<question:string,n:int>").filter("question.n = 299").count() == 1
    assert scene_graphs.first_existing(str(tmp_path / "no"), str(tmp_path / "q.json")) == str(tmp_path / "q.json")


def test_scenes_make_only_what_a_plan_reads(spark):
    """No graph is put together as a map to be taken apart again."""
    from claimforge.plans import scenes, star  # noqa: F401  scenes adds its queries

    plan = lambda name: star.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert not any("map_from_entries" in plan(name) for name in ("wide_pools", "claims_relation", "normalized_objects", "object_view"))


def test_objects_of_a_video_that_comes_twice(raw):
    """The last copy of a frame wins as a whole, also one without vertices and one at the same place of another row."""
    a = {"video_id": "v", "entries": dict([frame(1, 1.0, [vertex(1, "o8", contact=["r21"]), vertex(2, "o17")])])}
    b = {"video_id": "v", "entries": dict([frame(1, 1.0, [vertex(3, "o36", spatial=["r6"])])])}
    g = normalize.normalize(raw([a, b]))
    assert sorted(r.class_id for r in g.objects.collect()) in (["o17", "o8"], ["o36"]) and g.frames.count() == 1
    key, late = frame(1, 2.0, [])
    g = normalize.normalize(raw([{"video_id": "v", "entries": {**a["entries"], "later": late}}]))
    assert g.frames.count() == 1 and g.objects.count() == 0 and g.relations.count() == 0


def test_sink_makes_its_rows_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    one = "named_struct('text', 't', 'truth_state', 'TRUE', 'label', cast(1 as tinyint))"
    made = spark.range(30).selectExpr("concat('e', id) AS example_id", "elt(1 + id % 3, 'train', 'val', 'test') AS split", "cast(id AS string) AS video_id").mapInArrow(count, "example_id string, split string, video_id string")
    made = made.selectExpr("*", "'q' AS query_text", f"array({one}) AS propositions", "'binary' AS task_type", "named_struct('family', 'object') AS reasoning", "'g' AS generator_family")
    for k in (1, 2):
        sink.write(made, str(tmp_path), 4)
        assert seen.value == 30 * k and {s: spark.read.schema(SINK).parquet(f"{tmp_path}/{s}").count() for s in ("train", "val", "test")} == dict.fromkeys(("train", "val", "test"), 10 * k)
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_")]


def test_scene_graphs_are_written_compressed(spark, monkeypatch, tmp_path):
    from claimforge.plans import scenes, star  # noqa: F401  scenes adds its queries

    monkeypatch.setattr(engine, "scratch", lambda spark, what: str(tmp_path))
    assert star.QUERIES["json_lines_scan"](spark, "/root/testdata/sf0.001").count() > 0
    parts = [p.name for p in (tmp_path / "part.jsonl").iterdir() if p.name.startswith("part-")]
    assert parts and all(p.endswith(".json.gz") for p in parts)


def test_diversity_makes_its_claims_once(spark, monkeypatch):
    from claimforge.plans import scenes, star

    calls, write = [], engine.written
    monkeypatch.setattr(engine, "written", lambda df, path: calls.append(path) or write(df, path))
    plan = star.QUERIES["claim_diversity"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert len(calls) == 1 and "lineitem" not in plan and "l_orderkey" not in plan and scenes


def test_pools_row_by_row(raw):
    """The same as from the normalized tables, also for videos in several rows, null entries and vertices, and entries of no use; a query over orders sorts their lines once."""
    from claimforge.plans import scenes, star  # noqa: F401  scenes adds its queries

    key, empty = frame(1, 2.0, [])
    holes = frame(2, 1.0, [None, vertex(1, "o99", contact=["r15"]), vertex(1, "o8", None, verb=["v1"])])
    videos = [*random_videos(20), {"video_id": "V00003", "entries": {"late": empty, **dict([holes, action(9, "", 3, 4)])}}, {"video_id": "none", "entries": None}, {"video_id": None, "entries": {key: empty}}]
    videos += [{"video_id": "odd", "entries": {"a": None, "b": {"type": "other"}}}, {"video_id": "bare", "entries": {"z": {"type": "action"}}}]
    rows = raw(videos).coalesce(1)
    want = {r.video_id: r for r in normalize.wide_pools(normalize.normalize(rows)).collect()}
    got = {r.video_id: r for r in normalize.video_pools(rows).collect()}
    assert got == want and "bare" in got and "odd" not in got
    for name in ("content_keys", "claims_relation", "claims_order", "claim_samples"):
        plan = star.QUERIES[name](rows.sparkSession, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert sum("Relation [l_orderkey" in line for line in plan.splitlines()) == 1


def test_claims_draw_once(spark):
    """An option names its item in many places; none of them repeats the draw."""
    from claimforge.plans import scenes, star  # noqa: F401  scenes adds its queries

    plan = lambda name: star.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    drawn = {name: plan(name).count(", positive)") for name in ("claims_object", "claims_relation", "claims_order", "claims_box", "claims_pair", "claims_action")}
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert all(0 < n <= 3 for n in drawn.values()), drawn


def test_claims_make_no_method_too_large_to_compile(spark):
    """The JVM never compiles a method of more than 8,000 bytes; a chain of projections in one whole-stage method had more."""
    from claimforge.plans import scenes

    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    for name in ("claims_pair", "content_keys"):
        code = getattr(scenes, name)(spark, "/root/testdata/sf0.001")._jdf.queryExecution().explainString(mode)
        assert 0 < max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000, name
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_plan_makes_only_the_options_and_pools_it_reads(spark):
    """Samples and counts read no option, so none is made; claims on objects need no relation of a vertex."""
    from claimforge.plans import scenes

    plan = lambda name: getattr(scenes, name)(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "truth_state" in plan("content_keys")
    assert all("truth_state" not in plan(name) for name in ("claim_samples", "claim_counts"))
    assert "AS triples" not in plan("content_keys") and "AS boxes" not in plan("content_keys")


def test_options_are_as_many_as_counted(spark, raw):
    slots = spark.createDataFrame([(s, f, t, k) for s, (f, t, k) in enumerate((f, t, k) for f in ("object", "temporal", "spatial_contact") for t, k in (("single_choice", 5), ("multi_label", 40), ("binary", 2), ("three_way", 3)))], "slot_id long, family string, task_type string, k int")
    slots = slots.selectExpr("'train' AS split", "slot_id", "0 AS attempt", "family", "task_type", "k", "2 AS hops", "'hard' AS difficulty", "'SYNTH_VID_001' AS video_id")
    rows = generate.generate(slots, normalize.video_pools(raw([fixture_video()])), counted=True).collect()
    assert len(rows) > 9 and all(r.option_count == len(r.propositions) > 1 for r in rows)
