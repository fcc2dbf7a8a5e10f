import os

from pyspark.sql import functions as F

from webloom.operators import external as EX
from webloom.sinks import text as SK


def test_key_value_round_trip(spark, scratch):
    df = spark.createDataFrame([(1, 0.5), (2, 0.25)], "id long, rank double")
    path = os.path.join(scratch, "kv")
    SK.write_key_value(df, "id", "rank", path)
    back = spark.read.text(path).select(F.split("value", "\t").alias("p"))
    assert sorted((r.p[0], r.p[1]) for r in back.collect()) == [("1", "0.5"), ("2", "0.25")]


def test_init_tables(spark, scratch):
    paths = SK.init_tables(spark, scratch)
    assert len(paths) == 4
    assert spark.read.parquet(paths[1]).columns == ["term", "doc_id", "tf"]
    assert SK.init_tables(spark, scratch, ["word_count"]) == [os.path.join(scratch, "word_count")]


def test_write_outputs_per_input_name(spark, scratch):
    res = spark.createDataFrame([("a.fa", 0, "out a", "", "out a"), ("b.fa", 0, "out b", "", None)],
                                EX.RESULT_SCHEMA)
    path = os.path.join(scratch, "res")
    EX.write_outputs(res, path)
    assert {"file_name=a.fa", "file_name=b.fa"} <= set(os.listdir(path))
    got = spark.read.text(path).collect()
    assert sorted((r.file_name, r.value) for r in got) == [("a.fa", "out a"), ("b.fa", "out b")]
