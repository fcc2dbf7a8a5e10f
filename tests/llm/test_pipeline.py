import corpus_pipeline as cp
from webloom.llm import mixing
from webloom.llm.queries import op2_simhash_near_dedup, op8_decontaminate, op9_quality

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_order():
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "mixing sources", "sharding"]


def test_each_stage_against_its_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    good = cp.quality_stage(spark, docs, SF)
    assert good.columns == COLUMNS and good.schema == docs.schema
    assert ids(good) == sorted(r.doc_id for r in op9_quality(spark, SF).collect() if r.predicted)
    once = cp.near_duplicate_stage(spark, docs, SF)
    assert once.columns == COLUMNS
    assert ids(once) == sorted({r.component_id for r in op2_simhash_near_dedup(spark, SF).collect()})
    clean = cp.decontamination_stage(spark, docs, SF)
    bad = {r.doc_id for r in op8_decontaminate(spark, SF).collect()}
    assert clean.columns == COLUMNS and bad and ids(clean) == sorted(set(ids(docs)) - bad)


def test_whole_run(spark):
    out = cp.run(spark, SF)
    assert out.columns == [*COLUMNS, "shard", "slot"]
    rows = out.collect()
    assert sorted((r.shard, r.slot) for r in rows) == sorted(
        (s, i) for s in range(8) for i in range(sum(r.shard == s for r in rows)))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in cp.STAGES[:3]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
    size = {}
    for r in docs.collect():
        size[r.source] = size.get(r.source, 0) + len((r.text or "").split())
    taken = {}
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
    for s, t in mixing.targets(size).items():
        assert abs(taken.get(s, 0) - t) <= 1
    assert {r.doc_id for r in rows} <= {r.doc_id for r in docs.collect()}


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
        assert docs.count() == 0
