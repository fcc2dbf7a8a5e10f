import gzip
import random

import pytest
from pyspark.sql import functions as F

from test_streaming import _record, files, trec
from webloom.operators.index import term_freqs
from webloom.operators.segments import SegmentIndex
from webloom.streaming.ingest import current_pages, current_postings, start_ingest

WORDS = "alpha beta gamma delta the 17 epsilon".split()


def pages(spark, some):
    return spark.createDataFrame(some, "doc_id string, text string")


def rows(df):
    return sorted(map(tuple, df.select("term", "doc_id", "tf").collect()))


def plan_joins(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join")


def test_batches_against_a_rebuild(spark, scratch):
    rng, index, want, most = random.Random(5), SegmentIndex.create(spark, scratch + "/i", fanout=3), {}, 0
    before = set()
    for turn in range(20):
        some = {f"d{rng.randrange(200 if turn % 4 else 30)}": " ".join(rng.choices(WORDS, k=rng.randrange(6))) for _ in range(15)}
        index.add(pages(spark, list(some.items())), stream="s", batch=turn)
        want |= some
        now = files(scratch + "/i/data")
        assert before <= now.items()  # nothing stored is rewritten
        before = set(now.items())
        most = max(most, len(index.segments()))
        if turn % 5 == 4:
            assert rows(index.postings()) == rows(term_freqs(pages(spark, list(want.items()))))
    assert most <= 3 and sorted(r.doc_id for r in index.docs().collect()) == sorted(want)
    assert not index.add(pages(spark, [("d1", "replayed")]), stream="s", batch=19)  # a batch counts once
    gone = [f"d{i}" for i in range(0, 200, 2)]
    index.delete(pages(spark, [(g, None) for g in gone]))
    left = {k: v for k, v in want.items() if k not in gone}
    assert rows(index.postings()) == rows(term_freqs(pages(spark, list(left.items()))))
    index.add(pages(spark, [("d0", "alpha back")]))
    same = rows(SegmentIndex.open(spark, scratch + "/i").postings())
    assert ("back", "d0", 1) in same and index.vacuum() > 0 and rows(index.postings()) == same


def test_readers_join_only_segments_with_deletes(spark, scratch):
    index = SegmentIndex.create(spark, scratch + "/i")
    index.add(pages(spark, [(f"a{i}", "alpha beta") for i in range(10)]))
    index.add(pages(spark, [(f"b{i}", "alpha gamma") for i in range(10)]))
    frame = index.postings()
    assert plan_joins(frame) == 0 and len(index.segments()) == 2
    index.add(pages(spark, [("a1", "delta")]))
    one = index.postings().filter("term = 'alpha'")
    assert plan_joins(one) == 1 and one.count() == 19 and frame.filter("term = 'alpha'").count() == 20
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,alpha)" in plan and "SortMergeJoin" not in plan


def test_a_job_that_dies_changes_nothing(spark, scratch, monkeypatch):
    index = SegmentIndex.create(spark, scratch + "/i")
    index.add(pages(spark, [("a", "alpha"), ("b", "beta")]), stream="s", batch=0)
    with monkeypatch.context() as m:
        m.setattr(index.files, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            index.add(pages(spark, [("a", "gamma")]), stream="s", batch=1)
    assert rows(index.postings()) == [("alpha", "a", 1), ("beta", "b", 1)]
    assert index.add(pages(spark, [("a", "gamma")]), stream="s", batch=1)
    assert rows(index.postings()) == [("beta", "b", 1), ("gamma", "a", 1)] and index.vacuum() > 0
    assert rows(index.postings()) == [("beta", "b", 1), ("gamma", "a", 1)]


def test_nulls_repeats_and_empty_batches(spark, scratch):
    index = SegmentIndex.create(spark, scratch + "/i")
    index.add(pages(spark, []))
    assert rows(index.postings()) == [] and index.segments() == []
    some = pages(spark, [("a", "alpha"), ("a", "beta beta"), (None, "gamma"), ("b", None), ("c", "")]).withColumn("tf", F.lit(9))
    index.add(some)
    assert rows(index.postings()) == [("beta", "a", 2)] and sorted(r.doc_id for r in index.docs().collect()) == ["a", "b", "c"]
    index.add(pages(spark, [("a", None)]))
    assert rows(index.postings()) == []


def test_stream_of_batches(spark, tmp_path):
    src, out = tmp_path / "in", {n: str(tmp_path / n) for n in ("pages", "postings", "ck", "index")}
    src.mkdir()
    for turn in range(4):
        with gzip.open(src / f"{turn}.warc.gz", "wb") as fh:
            for i in range(turn, turn + 3):
                fh.write(_record(trec(i), f"http://p{i}.org/", f"<p>page{i} version{turn}</p>"))
        start_ingest(spark, str(src), out["pages"], out["postings"], out["ck"], trigger_once=True, index_path=out["index"]).awaitTermination(120)
    got = SegmentIndex.open(spark, out["index"])
    assert rows(got.postings()) == rows(current_postings(spark, out["postings"], out["pages"])) and len(got.segments()) == 4
    assert got.docs().count() == current_pages(spark, out["pages"]).count() == 6
