import os
import random

import pytest
from pyspark.sql import functions as F

from webloom.operators.keyed_store import KeyedTable

SCHEMA = "id long, part string, ts long, v string"


def rows(spark, some):
    return spark.createDataFrame(some, SCHEMA)


def files(path):
    return {os.path.join(d, n) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_against_a_dictionary(spark, scratch):
    rng, table, want = random.Random(3), KeyedTable.create(spark, scratch + "/t", SCHEMA, ["id", "part"], ["ts"], 8), {}
    for turn in range(7):
        some = [(rng.randrange(40), rng.choice(["a", None]), rng.randrange(9), f"{turn}-{i}") for i in range(60)]
        some = list({(r[0], r[1], r[2]): r for r in some}.values())  # a batch has one row of a key and version
        table.put(rows(spark, some))
        newest = {}
        for r in some:
            if r[:2] not in newest or newest[r[:2]][2] < r[2]:
                newest[r[:2]] = r
        for k, r in newest.items():
            if k not in want or r[2] >= want[k][2]:
                want[k] = r
        if turn % 2:
            gone = [(rng.randrange(40), rng.choice(["a", None])) for _ in range(9)]
            table.delete(spark.createDataFrame(gone, "id long, part string"))
            for k in gone:
                want.pop(k, None)
        if turn == 4:
            before = sorted(map(tuple, table.read().collect()), key=str)
            assert table.compact(3) and sorted(map(tuple, table.read().collect()), key=str) == before
            table.vacuum()
        assert sorted(map(tuple, KeyedTable.open(spark, scratch + "/t").read().collect()), key=str) == sorted(want.values(), key=str)
    key = next(iter(want))
    assert [tuple(r) for r in table.get(*key).collect()] == [want[key]] and table.get(999, "a").count() == 0


def test_an_update_rewrites_no_other_bucket(spark, scratch):
    table = KeyedTable.create(spark, scratch + "/t", SCHEMA, ["id"], buckets=32)
    table.put(spark.range(3200).selectExpr("id", "'p' AS part", "1L AS ts", "'old' AS v"))
    assert len(table.compact(1)) == 32
    table.vacuum()
    base, size = files(scratch), sum(map(os.path.getsize, files(scratch)))
    few = spark.range(32).selectExpr("id * 100 AS id", "'p' AS part", "0L AS ts", "'new' AS v").filter("id < 900")  # nine keys
    table.put(few)
    added = files(scratch) - base
    assert base <= files(scratch) and len(added) <= 9 and sum(map(os.path.getsize, added)) < size / 2
    assert table.read().groupBy("v").count().orderBy("v").collect() == [("new", 9), ("old", 3191)]
    touched = table.compact(1)
    assert len(touched) <= 9
    table.vacuum()
    kept = {f for f in base if int(f.split("_bucket=")[1].split("/")[0]) not in touched}
    assert kept <= files(scratch) and table.read().count() == 3200


def test_a_crash_before_the_swap_loses_nothing(spark, scratch, monkeypatch):
    table = KeyedTable.create(spark, scratch + "/t", SCHEMA, ["id"], buckets=4)
    table.put(rows(spark, [(1, "a", 1, "x"), (2, "a", 1, "y")]))
    want = sorted(table.read().collect())
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        for change in (lambda: table.put(rows(spark, [(1, "b", 2, "z")])), lambda: table.delete(spark.range(3)), lambda: table.compact(1)):
            with pytest.raises(OSError):
                change()
    again = KeyedTable.open(spark, scratch + "/t")
    assert sorted(again.read().collect()) == want and again.vacuum() == 3 and sorted(again.read().collect()) == want
    again.put(rows(spark, [(1, "b", 2, "z")]))
    assert sorted(again.read().collect()) == [(1, "b", 2, "z"), (2, "a", 1, "y")]


def test_two_writers_of_one_version(spark, scratch, monkeypatch):
    table = KeyedTable.create(spark, scratch + "/t", SCHEMA, ["id"], buckets=2)
    other = KeyedTable.open(spark, scratch + "/t")
    table.put(rows(spark, [(1, "a", 1, "x")]))
    monkeypatch.setattr(other, "_last", lambda: 1)  # it began before the other's batch
    with pytest.raises(RuntimeError):
        other.put(rows(spark, [(1, "a", 1, "lost")]))
    assert [r.v for r in table.read().collect()] == ["x"]


def test_deletes_hide_earlier_batches_only(spark, scratch):
    table = KeyedTable.create(spark, scratch + "/t", SCHEMA, ["id"], ["ts"], 2)
    assert table.read().count() == 0 and table.compact(1) == []
    table.put(rows(spark, [(1, "a", 9, "first"), (2, None, None, None), (None, "n", 1, "null key")]))
    table.delete(spark.createDataFrame([(1,), (7,)], "id long"))
    assert table.get(1).count() == 0 and table.get(None).first().v == "null key"
    table.put(rows(spark, [(1, "a", 3, "again")]))
    table.put(rows(spark, [(1, "a", 2, "late")]))
    assert table.get(1).first().v == "again" and table.get(2).first().v is None
    table.delete(spark.createDataFrame([(1,), (2,), (None,)], "id long"))
    assert table.read().count() == 0 and table.compact(1) and table.read().count() == 0
    assert KeyedTable.create(spark, scratch + "/t", SCHEMA, ["id"], ["ts"], 2).read().count() == 0
    assert table.read().select(F.count(F.lit(1))).first()[0] == 0
