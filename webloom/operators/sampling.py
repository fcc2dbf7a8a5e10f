"""Deterministic seeded sampling.

The hash is the first 60 bits of md5(seed:id), which the SQL oracle computes
alike: seeds give independent orders and different ids different hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEX_DIGITS = 15
SPACE = 16 ** HEX_DIGITS
HIST_BUCKETS = 4096


def seeded_hash(id_col, seed: int) -> Column:
    x = F.col(id_col) if isinstance(id_col, str) else id_col
    digest = F.md5(F.concat(F.lit(f"{seed}:"), x.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("long")


def seeded_hash_sql(id_expr: str, seed: int) -> str:
    return f"('0x' || substr(md5('{seed}:' || CAST({id_expr} AS VARCHAR)), 1, {HEX_DIGITS}))::BIGINT"


def sample_cutoffs(df: DataFrame, size: int, seeds: list[int], id_col: str = "id",
                   total: int | None = None) -> dict:
    """{seed: (hash, id)} of the ``size``-th row in (hash, id) order under each
    seed; None where the whole table is the sample.

    A threshold keeps about 1.2 x ``size`` candidates per seed; a histogram of
    their hashes (at most ``HIST_BUCKETS`` counts per seed reach the driver)
    finds the bucket that holds the cut-off, and only rows of that bucket
    (about size / HIST_BUCKETS) are put in order.  No task holds a sample.
    """
    n = total if total is not None else df.count()
    if size >= n:
        return dict.fromkeys(seeds)
    tau = min(SPACE, int(SPACE * (1.2 * size + 64) / n))
    hashed = F.array(*[F.struct(F.lit(sd).alias("seed"), seeded_hash(id_col, sd).alias("h")) for sd in seeds])
    while True:
        width = -(-tau // HIST_BUCKETS)
        cand = (df.select(id_col, F.explode(F.filter(hashed, lambda x: x["h"] < tau)).alias("_x"))
                .select(id_col, "_x.seed", "_x.h", F.expr(f"_x.h div {width}").alias("b")))
        hist: dict[int, list] = {sd: [] for sd in seeds}
        for sd, b, c in cand.groupBy("seed", "b").count().collect():
            hist[sd].append((b, c))
        if all(sum(c for _, c in h) >= size for h in hist.values()) or tau >= SPACE:
            break
        tau = min(SPACE, tau * 2)
    picked, need = F.lit(False), {}
    for sd, counts in hist.items():
        before = 0
        for b, c in sorted(counts):
            if before + c >= size:
                need[sd] = size - before
                picked = picked | ((F.col("seed") == sd) & (F.col("b") == b))
                break
            before += c
    inner: dict[int, list] = {sd: [] for sd in seeds}
    for sd, h, i in cand.filter(picked).select("seed", "h", id_col).collect():
        inner[sd].append((h, i))
    return {sd: sorted(inner[sd])[need[sd] - 1] for sd in seeds}


def in_sample(seed: int, cut: tuple | None, id_col: str = "id") -> Column:
    """Whether a row belongs to the sample that a cut-off of ``sample_cutoffs`` defines."""
    if cut is None:
        return F.lit(True)
    h = seeded_hash(id_col, seed)
    return (h < F.lit(cut[0])) | ((h == F.lit(cut[0])) & (F.col(id_col) <= F.lit(cut[1])))


def sample_fixed(df: DataFrame, size: int, seed: int, id_col: str = "id",
                 total: int | None = None) -> DataFrame:
    """Exactly ``min(size, n)`` rows without replacement: the rows with the
    smallest (hash, id)."""
    if size <= 0:
        return df.limit(0)
    return df.filter(in_sample(seed, sample_cutoffs(df, size, [seed], id_col, total)[seed], id_col))


def sample_bernoulli(df: DataFrame, fraction: float, seed: int, id_col: str = "id") -> DataFrame:
    """Each row kept independently with probability ``fraction`` (by hash)."""
    return df.filter(seeded_hash(id_col, seed) < F.lit(int(SPACE * fraction)))
