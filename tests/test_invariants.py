"""Invariants on the driver tables (sf0.001) through the registered queries."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from webloom.operators import sampling as SM
from webloom.plans import inputs as I

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables missing")


def q(spark, name):
    return E.queries()[name](spark, SF)


def test_ranks_sum_to_one(spark):
    for name in ("pagerank", "web_pagerank"):
        total = q(spark, name).agg(F.sum("rank")).first()[0]
        assert total == pytest.approx(1.0, abs=1e-5), name   # rounded / float32 values


def test_word_count_equals_sum_of_tf(spark):
    wc = q(spark, "word_count").agg(F.sum("count")).first()[0]
    tf = q(spark, "term_freqs").agg(F.sum("tf")).first()[0]
    toks = q(spark, "tokens_non_numeric").agg(F.sum("n")).first()[0]
    assert wc == tf == toks


def test_postings_unique(spark):
    post = q(spark, "inverted_index")
    assert post.count() == post.select("term", "doc_id").distinct().count()


def test_distances_non_negative_and_assignment_total(spark):
    nc = q(spark, "nearest_centroid")
    assert nc.filter(F.col("dist") < 0).count() == 0
    sums = q(spark, "cluster_sums").select("cid", "n").distinct().agg(F.sum("n")).first()[0]
    assert sums == nc.count()


def test_sample_size_exact(spark):
    pts = I.points(spark, SF)
    for size in (1, 7, 50):
        assert SM.sample_fixed(pts, size, seed=3).count() == size


def test_search_top_k_ordered(spark):
    rows = q(spark, "search_keyword").collect()
    keys = [(-r.page_rank, r.doc_id) for r in rows]
    assert keys == sorted(keys) and len(rows) <= 20
