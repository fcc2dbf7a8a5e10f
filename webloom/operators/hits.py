"""Tabular hit tables (the 12-column output of an external sequence search)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Conventional names of the tool's tabular output columns (fixed layout).
HITS_SCHEMA = ("query_id string, subject_id string, pct_identity double, aln_length int, "
               "mismatches int, gap_opens int, q_start int, q_end int, s_start int, s_end int, "
               "evalue double, bit_score double")


def hits_best(hits: DataFrame) -> DataFrame:
    """Per query: best subject (highest bit score, then lowest e-value, then
    smallest subject id), its scores, and the number of hits.  Partial
    aggregation keeps a query with a third of all hits cheap."""
    order = F.struct(-F.col("bit_score"), F.col("evalue"), F.col("subject_id"))
    best = F.min_by(F.struct("subject_id", "bit_score", "evalue"), order)
    return (hits.groupBy("query_id")
            .agg(best.alias("_b"), F.count(F.lit(1)).alias("n_hits"))
            .select("query_id", F.col("_b.subject_id").alias("best_subject"),
                    F.col("_b.bit_score").alias("best_bit_score"),
                    F.col("_b.evalue").alias("best_evalue"), "n_hits"))


def hits_per_subject(hits: DataFrame) -> DataFrame:
    """(subject_id, n_queries, n_hits)."""
    return hits.groupBy("subject_id").agg(F.countDistinct("query_id").alias("n_queries"),
                                          F.count(F.lit(1)).alias("n_hits"))
