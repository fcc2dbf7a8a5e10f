"""Driver tables: one parquet file per table under a scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str, spread_out: bool = False) -> DataFrame:
    """Lazily scan one driver table; projections and filters reach the scan.

    ``spread_out`` for CPU-heavy per-row work (tokenizing, HTML parsing): see
    ``spread``.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if spread_out else df


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition only when the scan has fewer splits than the
    cluster has cores (e.g. a small file with a single row group, which
    parquet cannot split).  On large inputs the scan already yields far more
    splits than cores and this is a no-op -- no shuffle of the corpus.
    The split count comes from planning only (no job)."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df.repartition(target) if splits < target else df
