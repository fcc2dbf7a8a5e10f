import pytest
from pyspark.sql import functions as F

from webloom.operators import index as IX
from webloom.operators import search as S

DOCS = [(1, "Spark spark join. The join!"), (2, "join data 42"), (3, "nothing here")]


def test_term_freqs_and_word_count(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    tf = {(r.doc_id, r.term): r.tf for r in IX.term_freqs(docs).collect()}
    assert tf == {(1, "spark"): 2, (1, "join"): 2, (2, "join"): 1, (2, "data"): 1,
                  (3, "nothing"): 1, (3, "here"): 1}
    wc = {r.word: r["count"] for r in IX.word_count(IX.term_freqs(docs)).collect()}
    assert wc["join"] == 3 and sum(wc.values()) == sum(tf.values())


def test_postings_map_chunks_round_trip(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    post = IX.term_freqs(docs)
    wide = IX.postings_map(post, max_entries=1)
    assert wide.filter("term = 'join'").count() >= 1
    assert max(len(r.postings) for r in wide.collect()) <= 2
    back = sorted(map(tuple, IX.explode_postings_map(wide).select("term", "doc_id", "tf").collect()))
    assert back == sorted(map(tuple, post.select("term", "doc_id", "tf").collect()))


def test_index_scan_range(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    rows = IX.index_scan(IX.term_freqs(docs), "h", "o").collect()
    assert [r.term for r in rows] == ["here", "join", "join", "nothing"]


def test_search_keyword(spark):
    post = spark.createDataFrame([("kw", "a", 1), ("kw", "b", 3), ("kw", "c", 2), ("kw", "d", 1),
                                  ("other", "a", 5)], "term string, doc_id string, tf int")
    pages = spark.createDataFrame([("a", "u/a", "x"), ("b", "u/b", "y"), ("c", "u/c", "z")],
                                  "doc_id string, uri string, content string")
    ranks = spark.createDataFrame([("a", 0.5), ("b", 0.5), ("c", 0.9), ("d", 1.0)],
                                  "doc_id string, page_rank float")
    res = S.search_keyword(post, pages, ranks, "KW", k=2).collect()
    assert [(r.doc_id, r.uri, r.term_freq) for r in res] == [("c", "u/c", 2), ("a", "u/a", 1)]
    assert S.search_eval_count(post, "kw").first()[0] == 4
    assert S.search_keyword(post, pages, ranks, "absent").count() == 0


def test_doc_rank_load_missing_is_zero(spark):
    m = spark.createDataFrame([("clueweb09-en0000-01-00001", 1, 1), ("clueweb09-en0000-01-00002", 2, 2),
                               ("clueweb09-en0000-01-00001", 3, 3)], "trec_id string, node_id int, line_no long")
    r = spark.createDataFrame([(1, 0.25), (3, 0.75)], "node_id int, rank double")
    got = {x.doc_id: (x.node_id, x.page_rank) for x in S.doc_rank_load(m, r, order_col="line_no").collect()}
    assert got == {"00000100001": (3, 0.75), "00000100002": (2, 0.0)}


def test_page_keyword_lines(spark):
    pages = spark.createDataFrame([("a", "u", "one kw\ntwo\nkw three")], "doc_id string, uri string, content string")
    rows = S.page_keyword_lines(pages, "kw").collect()
    assert [(r.line_no, r.line) for r in rows] == [(1, "one kw"), (3, "kw three")]


def test_stored_index_pushdown(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"alpha{i % 7} beta{i % 3} gamma") for i in range(200)],
                                 "doc_id long, text string")
    path = str(tmp_path / "index")
    IX.write_index(IX.term_freqs(docs), path, num_partitions=4)
    stored = spark.read.parquet(path)
    hits = stored.filter(F.col("term") == "beta1")
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(term), EqualTo(term,beta1)]" in plan
    assert sorted(r.doc_id for r in hits.collect()) == [i for i in range(200) if i % 3 == 1]
    ranges = sorted(tuple(r) for r in stored.groupBy(F.input_file_name()).agg(
        F.min("term"), F.max("term")).select("min(term)", "max(term)").collect())
    assert len(ranges) > 1
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))   # disjoint term ranges per file


def test_search_reads_the_stored_tables_by_key(spark):
    """Filters on term and doc_id reach the parquet scans of the stored tables."""
    from webloom.plans import inputs as I
    sf = "/root/testdata/sf0.001"
    t = I.search_tables(spark, sf)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    hits = plan(S.search_keyword(t["postings"], t["pages"], t["ranks"], "der"))
    assert "PushedFilters: [IsNotNull(term), EqualTo(term,der)" in hits
    key = t["pages"].first().doc_id
    page = S.get_page(t["pages"], key)
    assert f"EqualTo(doc_id,{key})" in plan(page) and page.count() == 1
    assert S.search_keyword(t["postings"], t["pages"], t["ranks"], "nosuchword").count() == 0


def _rows_scanned(df):
    """Rows that the file scans of an executed plan put out."""
    def leaves(plan):
        if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return leaves(plan.executedPlan())
        if plan.getClass().getSimpleName().endswith("QueryStageExec"):
            return leaves(plan.plan())
        kids = plan.children()
        return [x for i in range(kids.size()) for x in leaves(kids.apply(i))] or [plan]
    df.collect()
    scans = [x for x in leaves(df._jdf.queryExecution().executedPlan()) if "FileSourceScan" in x.getClass().getSimpleName()]
    assert scans
    return sum(x.metrics().get("numOutputRows").get().value() for x in scans)


def test_ranked_index_gives_the_same_and_reads_little(spark, scratch):
    n = 60_000
    pages = spark.range(n).select(F.format_string("d%07d", "id").alias("doc_id"), F.concat(F.lit("u"), "id").alias("uri"), F.lit("").alias("content"))
    # two thirds of the pages have one and the same rank, some have none, some postings have no page
    ranks = spark.range(n + 50).filter("id % 50 <> 7").select(
        F.format_string("d%07d", "id").alias("doc_id"), F.when(F.col("id") % 3 == 0, (F.col("id") * 37 % 1009) / 1009).otherwise(0.25).cast("float").alias("page_rank"))
    words = spark.range(n + 100).select(F.format_string("d%07d", "id").alias("doc_id"), F.col("id"))
    postings = (words.filter("id % 3 < 2").select(F.lit("hot").alias("term"), "doc_id", (F.col("id") % 5).cast("int").alias("tf"))
                .unionByName(words.filter("id % 3 = 1").select(F.lit("tied").alias("term"), "doc_id", F.lit(1).alias("tf")))
                .unionByName(words.filter("id < 7").select(F.lit("rare").alias("term"), "doc_id", F.lit(2).alias("tf"))))
    S.write_ranked_index(postings, pages, ranks, f"{scratch}/ranked", block=256)
    for word, k in [("Hot", 20), ("hot", 700), ("tied", 20), ("rare", 20), ("none", 20)]:
        want = S.search_keyword(postings, pages, ranks, word, k).collect()
        assert S.search_ranked(spark, f"{scratch}/ranked", pages, word, k).collect() == want
    assert _rows_scanned(S.ranked_hits(spark, f"{scratch}/ranked", "hot", 20)) <= 2_000
    assert _rows_scanned(S.ranked_hits(spark, f"{scratch}/ranked", "tied", 20)) <= 2_000
    directory = spark.read.parquet(f"{scratch}/ranked/directory").groupBy("term").agg({"n": "sum"})
    stored = spark.read.parquet(f"{scratch}/ranked/postings").groupBy("term").count()
    assert sorted(map(tuple, directory.collect())) == sorted(map(tuple, stored.collect()))


def test_a_lookup_in_unsorted_files_reads_one_row_group(spark, scratch):
    """Keys spread over 12 files without order: least and greatest keys spare nothing, the filters do."""
    n = 24_000
    keys = spark.range(n, numPartitions=12).select(F.md5(F.col("id").cast("string").cast("binary")).alias("doc_id"), F.lit("u").alias("uri"), F.lit("c").alias("content"))
    S.with_key_filter(keys.write, "doc_id").parquet(scratch + "/filtered")
    keys.write.parquet(scratch + "/plain")
    key = keys.filter("doc_id > '8'").first()["doc_id"]
    read = {name: S.get_page(spark.read.parquet(f"{scratch}/{name}"), key) for name in ("filtered", "plain")}
    assert _rows_scanned(read["plain"]) == n and _rows_scanned(read["filtered"]) == n // 12
    assert [r.doc_id for r in read["filtered"].collect()] == [key]
    assert _rows_scanned(S.get_page(spark.read.parquet(scratch + "/filtered"), "9" * 32)) <= n // 12
