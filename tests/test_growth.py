"""Steps whose work must grow with the input: each is done once, and nothing in it is compared or copied for every word."""

import random
from collections import Counter

from pyspark.sql import functions as F

from webloom.functions import text as T
from webloom.functions.html import html_to_text
from webloom.operators import alignment as A
from webloom.operators import index as IX
from webloom.operators import search as S
from webloom.operators.segments import SegmentIndex


def _plan(df, optimized=False):
    q = df._jdf.queryExecution()
    return (q.optimizedPlan() if optimized else q.executedPlan()).toString()


def test_plain_words_are_taken_first_and_change_no_token(spark):
    assert T.TOKEN_PATTERN_JAVA.startswith(f"(?:{T._PLAIN}|")
    rest = "(?:" + T.TOKEN_PATTERN_JAVA[len(f"(?:{T._PLAIN}|"):]
    rng = random.Random(5)
    pieces = ["a", "der", "é", "ß", "ÿ", " ", " ", "\n", ". ", ".", ",", ", ", "'", ":", "_", "7", "3.5", "́", "­", "Ω", "漢", "カ", "ไทย", "é.", "x,y", "\t", "\x85", " "]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(30))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    both = [F.regexp_extract_all(F.lower("t"), F.lit(p), 0) for p in (T.TOKEN_PATTERN_JAVA, rest)]
    assert df.select(*both).filter(both[0] != both[1]).count() == 0


def test_postings_are_counted_by_runs(spark):
    rng = random.Random(6)
    words = ["der", "des", "desto", "the", "bad", "0x1f", "12", "zug", "éa", "漢", "g", "{", "ab_", "fa"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(50)] + ["zug " * 300_000, "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = IX.term_freqs(df)
    assert "lambda" not in _plan(got).split("Generate")[0]  # nothing is interpreted for each word after the tokenizer
    tokens = {r.doc_id: r.t for r in df.select("doc_id", T.index_terms("text").alias("t")).collect()}
    want = {(i, w, n) for i, t in tokens.items() for w, n in Counter(t or []).items()}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(want) and set(rows) == want


def test_page_text_is_extracted_once(spark):
    df = spark.createDataFrame([("<p>a</p><p> b </p>",), ("",), ("<p> </p>",), (None,)], "h string").select(html_to_text("h").alias("t"))
    assert _plan(df, True).count("regexp_extract_all(h") == 1
    assert [r.t for r in df.collect()] == ["a\nb\n", "", "", None]


def test_seeds_copy_no_text_and_compare_no_pairs(spark):
    words = [["la"] * 200_000 + ["li", "lo"], [], None, ["a", "b", "c", "d"], ["a", "b", "c", "d", "e"]]
    df = spark.createDataFrame(list(enumerate(words)), "id long, words array<string>")
    cells = A._cells(df, "id", 5)
    assert "slice(" not in _plan(cells) and "array_distinct" not in _plan(cells)
    seed = F.xxhash64(F.lit("a b c d e"))
    assert [tuple(r) for r in cells.filter("id = 4").collect()] == [(4, spark.range(1).select(seed).first()[0], 0)]
    assert cells.distinct().groupBy("id").count().filter("id = 0").first()["count"] == 200_002 // A.CELL + 2


def test_the_links_of_a_step_are_joined_once(spark):
    from webloom.plans import queries as Q
    ids, edges = Q._stored_graph_b(spark, "/root/testdata/sf0.001")
    assert "Join" not in _plan(edges) and "Aggregate" not in _plan(ids)


def test_a_merge_stores_postings_once(spark, scratch):
    index = SegmentIndex.create(spark, f"{scratch}/index", fanout=2)
    asked, fs = [], index.files.fs
    index.files.fs = lambda path: (asked.append(path), fs(path))[1]
    for i in range(2):
        index.add(spark.createDataFrame([(f"p{i}", f"zug horst{i}")], "doc_id string, text string"), merge=False)
    before = sum("unsorted" in p for p in asked)
    assert index.merge() == 1 and sum("unsorted" in p for p in asked) == before == 2
    assert sorted(map(tuple, index.postings().collect())) == [("horst0", "p0", 1), ("horst1", "p1", 1), ("zug", "p0", 1), ("zug", "p1", 1)]


def test_postings_meet_the_ranks_of_pages_in_one_join(spark):
    rows = lambda name, n: spark.range(n).select(F.concat(F.lit("d"), "id").alias("doc_id"), F.lit(name).alias("uri"))
    ranks = rows("r", 5).select("doc_id", F.lit(0.5).cast("float").alias("page_rank"))
    postings = rows("p", 6).select(F.lit("zug").alias("term"), "doc_id", F.lit(1).alias("tf"))
    plan = _plan(S.ranked_postings(postings, rows("u", 4), ranks.union(ranks.limit(1))))
    assert "ShuffledHashJoin" in plan
    got = S.ranked_postings(postings, rows("u", 4), ranks.union(ranks.filter("doc_id = 'd0'"))).groupBy("doc_id").count()
    assert sorted(map(tuple, got.collect())) == [("d0", 2), ("d1", 1), ("d2", 1), ("d3", 1)]
