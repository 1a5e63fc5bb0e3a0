"""The pipeline's stages in order, each against a brute-force reading of its rule."""

import corpus_pipeline
from claimforge.llm import byte_bpe, decontamination, pii, simhash


def test_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "byte_bpe"]
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, sf)
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept[name] = docs
        if name != "byte_bpe":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    own = {r.doc_id: simhash.fingerprint(r.text.encode()) for r in kept["toxicity"].collect()}
    left = {r.doc_id for r in kept["near_duplicates"].collect()}
    assert len({own[i] for i in left}) == len(left) and all(any((own[i] ^ own[j]).bit_count() <= 2 for j in own if j != i) for i in own if i not in left)
    items = [decontamination.exact(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    holds = lambda s: any(len(q & decontamination.exact(s)) >= 0.8 * len(q) for q in items)
    assert {r.doc_id for r in kept["decontamination"].collect()} == {r.doc_id for r in kept["near_duplicates"].collect() if not holds(r.text)}
    assert not any(pii.base_spans(r.text) for r in kept["personal_data"].collect()) and all(len(r.text) == r.n_chars for r in kept["personal_data"].collect())
    text = {r.doc_id: r.text for r in kept["personal_data"].collect()}
    path = corpus_pipeline.public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert {r.doc_id: r.text for r in byte_bpe.decode(kept["byte_bpe"], path).collect()} == text


LONG = "many different words " + " ".join(f"w{i}" for i in range(60_000)) + " " + "x" * 50_000


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls in any column, empty and very long texts, repeated rows, extra columns whose names clash with the operators' own."""
    sf = "/root/testdata/sf0.001"
    real = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()][:40]
    odd = [(None, "a text without an id of its own", None, None, None), (900, None, None, None, None), (901, "", "en", "s", 0), (902, " \n\t", "en", "s", 3), (903, LONG, "en", "s", len(LONG)), (904, "write to me@x.org now please", "en", "s", None)]
    rows = [*real, *odd, real[0], real[0], odd[0], odd[5]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept_id int, label int, ids string, fp long, score double, row string"
    docs = spark.createDataFrame([(*r, 1, 1, "x", 2, 0.5, None) for r in rows], schema)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        docs = stage(spark, docs, sf)
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "byte_bpe":
            assert docs.columns == columns and docs.count() <= before, name
        if name == "near_duplicates":
            keys = [(r.doc_id, r.text) for r in docs.collect()]
            assert len(keys) == len(set(keys)) and (904, odd[5][1]) in keys and (None, odd[0][1]) in keys
            # empty, blank and null texts share a fingerprint: one of them stays
            assert len({k for k in keys if k[0] in (900, 901, 902)}) == 1
        if name == "personal_data":
            assert {r.text: r.n_chars for r in docs.filter("doc_id = 904").collect()} == {"write to [EMAIL] now please": 27}
    out = {r.doc_id: r for r in docs.collect()}
    assert docs.count() == before and out[900 if 900 in out else 901].ids == [] and len(out[903].ids) > 60_000


def test_stages_on_empty_tables(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/out-{name}")
        docs = spark.read.parquet(f"{tmp_path}/out-{name}")
        assert docs.count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_run_gives_what_the_stages_give(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    plain = lambda df: sorted((r.doc_id, tuple(r.ids), tuple(r.offsets)) for r in df.collect())
    assert plain(docs) == plain(corpus_pipeline.run(spark, sf))
