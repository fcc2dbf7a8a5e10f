from pyspark.sql import Window
from pyspark.sql import functions as F

from webloom.operators import keyed as K


def test_upsert_latest(spark):
    base = spark.createDataFrame([(1, 10, "a"), (2, 5, "b")], "k int, v int, x string")
    upd = spark.createDataFrame([(1, 11, "c"), (2, 4, "d"), (3, 1, "e")], "k int, v int, x string")
    got = sorted(map(tuple, K.upsert_latest(base, upd, "k", ["v"]).collect()))
    assert got == [(1, 11, "c"), (2, 5, "b"), (3, 1, "e")]


def test_delete_by_key_and_first(spark):
    t = spark.createDataFrame([(1, 3, 9.0), (1, 1, 7.0), (2, 1, 5.0)], "k int, o int, v double")
    assert sorted(r.k for r in K.delete_by_key(t, t.filter("k = 2"), "k").collect()) == [1, 1]
    assert sorted(map(tuple, K.first_per_key(t, "k", "v", ["o"]).collect())) == [(1, 7.0), (2, 5.0)]


def test_table_peek(spark):
    t = spark.createDataFrame([(3, "c", 1.5), (1, "a", 2.0), (2, "b", 3.0)], "id int, name string, val double")
    rows = [tuple(r) for r in K.table_peek(t, "id", 2).collect()]
    assert sorted(rows) == [("1", "name", "a"), ("1", "val", "2.0"), ("2", "name", "b"), ("2", "val", "3.0")]


def test_dense_index_matches_row_number(spark):
    df = spark.range(0, 3000, 7).select((F.col("id") * 7919 % 10007).alias("x")).repartition(5)
    got = {r.x: r.idx for r in K.dense_index(df, ["x"]).collect()}
    want = {r.x: r.i for r in df.select("x", (F.row_number().over(Window.orderBy("x")) - 1).alias("i")).collect()}
    assert got == want


def test_pack_paths(spark):
    p = spark.createDataFrame([(f"/d/f{i:02d}.warc.gz",) for i in range(7)] + [("/d/x.txt",)], "path string")
    rows = K.pack_paths(p, 3, suffix=".warc.gz").collect()
    by = {}
    for r in rows:
        by.setdefault(r.manifest, []).append(r.path)
    assert sorted(len(v) for v in by.values()) == [1, 3, 3]
    assert "warcPaths_2.txt" in by and all(x.endswith(".gz") for v in by.values() for x in v)
