"""Keyed-table operations: keep-latest upsert, delete by key, first per key,
table peek, dense row index and manifest packing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.session import cut_lineage


def upsert_latest(base: DataFrame, updates: DataFrame | None, key: str | list,
                  version: list[str]) -> DataFrame:
    """One row per key: the row with the greatest ``version`` tuple wins
    (a put with one kept version).  ``max_by`` aggregates partially, so a key
    holding a third of all rows is reduced map-side before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    rows = base if updates is None else base.unionByName(updates)
    others = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*others), F.struct(*version)).alias("_row")
    return rows.groupBy(*keys).agg(best).select(*keys, "_row.*")


def delete_by_key(table: DataFrame, keys: DataFrame, key: str | list) -> DataFrame:
    """Rows of ``table`` whose key is not in ``keys`` (anti join)."""
    cols = [key] if isinstance(key, str) else list(key)
    return table.join(keys.select(*cols).distinct(), cols, "left_anti")


def first_per_key(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """(key, value): the value of the row that comes first by ``order``
    (deterministic 'first'; partial aggregation, skew safe)."""
    return df.groupBy(key).agg(F.min_by(F.col(value), F.struct(*order)).alias(value))


def table_peek(df: DataFrame, key: str, n: int, columns: list[str] | None = None) -> DataFrame:
    """First ``n`` rows by key, as (row_key, qualifier, value) strings -- the
    cell-by-cell dump of a table scan with a row limit (top-n heap)."""
    cols = columns or [c for c in df.columns if c != key]
    top = df.orderBy(key).limit(n)
    wide = top.select(F.col(key).cast("string").alias("row_key"),
                      *[F.col(c).cast("string").alias(c) for c in cols])
    return wide.unpivot("row_key", cols, "qualifier", "value")


def dense_index(df: DataFrame, order: list[str], name: str = "idx") -> DataFrame:
    """Add a 0-based row number in ``order`` without a single-partition window.

    The data is range-sorted, each row tagged with its partition id and local
    position, and checkpointed (so both passes see the same rows).  Per
    partition counts -- one row per partition -- give the offsets.
    """
    s = (df.orderBy(*order)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mono", F.monotonically_increasing_id()))
    s = cut_lineage(s)
    counts = sorted((r["_pid"], r["_c"]) for r in
                    s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c")).collect())
    offsets, acc = [], 0
    for pid, c in counts:
        offsets.append((pid, acc))
        acc += c
    spark = df.sparkSession
    off = spark.createDataFrame(offsets or [(0, 0)], "_pid int, _off long")
    local = F.col("_mono") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (s.join(F.broadcast(off), "_pid")
            .withColumn(name, F.col("_off") + local)
            .drop("_pid", "_mono", "_off"))


def pack_paths(paths: DataFrame, n: int, path_col: str = "path", suffix: str | None = None,
               prefix: str = "warcPaths_") -> DataFrame:
    """Group sorted paths ``n`` at a time: (manifest, path); the remainder
    goes to the last manifest.  Optional suffix filter (e.g. '.warc.gz')."""
    p = paths.select(path_col)
    if suffix:
        p = p.filter(F.col(path_col).endswith(suffix))
    idx = dense_index(p, [path_col])
    return idx.select(F.concat(F.lit(prefix), F.floor(F.col("idx") / n).cast("string"), F.lit(".txt"))
                      .alias("manifest"), path_col)
