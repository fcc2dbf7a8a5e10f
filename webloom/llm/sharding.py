"""Sharding by sampled splitters; the shards' bytes are near equal.

Records are ordered by (60 bits of the text's MD5, doc_id), so copies lie side by side.
Rows that share both are interchangeable; if such a group is too large for a range or lies
across a cut, its rows are written to the shared folder with a number each, which orders
them, and the ranges are drawn anew.
A size-weighted sample of keys gives quantile boundaries of many small ranges;
ranges that turn out overfull are sampled again and subdivided, down to single
keys.  Exact sums per range then place the cuts between shards; a cut that
falls into a small group of equal texts moves to the group's nearer edge, a
large group (over ``GROUP_SHARE`` of a shard) is cut through.  The last step
range-partitions the records and numbers them inside their range.

Only keys, sums per range and a bounded sample reach the driver: at most
``MAX_RANGES`` ranges and ``PER_RANGE`` sampled keys a range.

Defined results: null text counts as no bytes and as the empty text; null
doc_id sorts first; repeated rows are numbered each, and shared out like others; an empty
table gives no rows; extra columns pass through, but columns named ``shard`` and ``slot`` are
replaced by the results.  Column names that start with ``_sh_`` are reserved.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm.common import Scratch, hash60

RANGE_ROWS = 100_000
MIN_RANGES, MAX_RANGES = 128, 16_384
PER_RANGE = 16
OVERFULL = 3.0
GROUP_SHARE = 0.02
_LEAST = -(2 ** 63)
_KEY = ("_sh_k", "_sh_id", "_sh_n")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns({
        "_sh_size": (F.octet_length(text) + 1).cast("long"), "_sh_k": hash60(text),
        "_sh_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)), "_sh_n": F.lit(0).cast("long")})


def _range_of(df: DataFrame, splits: list[tuple[int, int, int]]) -> DataFrame:
    """Adds _sh_range, the number of splitters at or below the key."""
    at = [np.array([s[i] for s in splits], dtype=np.int64) for i in range(3)]

    @F.pandas_udf("int")
    def find(k: pd.Series, i: pd.Series, n: pd.Series) -> pd.Series:
        key = [x.to_numpy() for x in (k, i, n)]
        low, high = np.zeros(len(k), dtype=np.int64), np.full(len(k), len(splits), dtype=np.int64)
        tied = np.arange(len(k))  # rows whose key is that of a splitter so far
        for part, own in zip(at, key):
            for lo, hi in set(zip(low[tied].tolist(), high[tied].tolist())):
                rows = tied[(low[tied] == lo) & (high[tied] == hi)]
                low[rows], high[rows] = (lo + np.searchsorted(part[lo:hi], own[rows], side) for side in ("left", "right"))
            tied = tied[high[tied] > low[tied]]
        return pd.Series(high.astype(np.int32))

    return df.withColumn("_sh_range", find("_sh_k", "_sh_id", "_sh_n"))


def _sample(keys: DataFrame, rate: float, salt: int) -> list:
    """Keys drawn with probability size x rate (at most 1), as (range, key, weight)."""
    u = (F.xxhash64(*_KEY, F.lit(salt)).cast("double") + 2.0 ** 63) / 2.0 ** 64
    return [(r[0], tuple(r[1:4]), max(r[4], 1 / rate)) for r in
            keys.filter(u < F.col("_sh_size") * F.lit(rate)).select("_sh_range", *_KEY, "_sh_size").distinct().collect()]


def _quantiles(sample: list, n: int) -> list[tuple[int, int, int]]:
    """Keys that split a weighted sample into n parts."""
    rows = sorted((k, w) for _, k, w in sample)
    total, out, so_far = sum(w for _, w in rows), [], 0.0
    for k, w in rows:
        if so_far >= total * (len(out) + 1) / n and len(out) < n - 1 and (not out or out[-1] != k):
            out.append(k)
        so_far += w
    return out


def plan(keys: DataFrame, n_shards: int) -> tuple[list[tuple], list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Splitters; for each range its (shard, slot of its first row, rows); and keys (k, id) that stand
    for many rows and have to be taken apart first."""
    rows, total = keys.agg(F.count(F.lit(1)), F.sum("_sh_size")).first()
    if not rows:
        return [], [], []
    n = min(MAX_RANGES, max(MIN_RANGES, -(-rows // RANGE_ROWS)))
    splits = _quantiles(_sample(keys.withColumn("_sh_range", F.lit(0)), n * PER_RANGE / total, 0), n)
    turn = 1
    while True:
        placed = _range_of(keys, splits)
        sums = {r[0]: r for r in placed.groupBy("_sh_range").agg(
            F.sum("_sh_size"), F.count(F.lit(1)), F.min(F.struct(*_KEY)), F.max(F.struct(*_KEY))).collect()}
        over = [r for r, s in sums.items() if s[1] > OVERFULL * total / n]
        full = [r for r in over if sums[r][3] != sums[r][4]]
        drawn = _sample(placed.filter(F.col("_sh_range").isin(full)), 2 * n * PER_RANGE / total, turn) if full else []
        more = {tuple(sums[r][4]) for r in full}
        for r in full:
            more |= set(_quantiles([x for x in drawn if x[0] == r], int(np.ceil(2 * sums[r][1] * n / total))))
        if more <= set(splits):  # until no range can be subdivided
            break
        splits, turn = sorted(set(splits) | more), turn + 1
    heavy = [tuple(sums[r][3])[:2] for r in over if sums[r][3] == sums[r][4] and sums[r][2] > 1]
    layout, torn = _cut(keys, splits, sums, total, n_shards)
    return splits, layout, sorted({*heavy, *torn})


def _cut(keys, splits, sums, total, n_shards):
    """Adds the cuts between shards to ``splits`` (in place) and lays out the ranges; also the
    keys of several rows that a cut falls into."""
    before, so_far = {}, 0
    for r in range(len(splits) + 1):
        before[r] = so_far
        so_far += sums[r][1] if r in sums else 0
    goals = [(j, total * j // n_shards) for j in range(1, n_shards)]
    order = sorted(before)
    holds = [(j, g, order[bisect_right([before[r] for r in order], g) - 1]) for j, g in goals]
    wanted = sorted({r for *_, r in holds})
    w = Window.partitionBy("_sh_range").orderBy(*_KEY).rowsBetween(Window.unboundedPreceding, 0)
    upto = _range_of(keys, splits).filter(F.col("_sh_range").isin(wanted)).withColumn("_sh_upto", F.sum("_sh_size").over(w))
    cases = [F.min(F.when((F.col("_sh_range") == r) & (F.col("_sh_upto") - F.col("_sh_size") / 2 >= g - before[r]),
                          F.struct(*_KEY))).alias(f"c{j}") for j, g, r in holds]
    found = upto.agg(*cases).first() if cases else []
    cuts, torn = {}, []
    for (j, _, r), c in zip(holds, found):
        # None: the goal lies behind the middle of the range's last record
        cuts[j] = tuple(c) if c else (splits[r] if r < len(splits) else None)
    at = sorted({c[0] for c in cuts.values() if c})
    if at:  # the groups of equal texts that the cuts fall into
        key, size = F.struct(*_KEY), F.col("_sh_size")
        of = lambda c: F.struct(*(F.lit(x).cast("long").alias(n) for x, n in zip(c, _KEY)))
        side = [x for j, c in cuts.items() if c for x in (
            F.sum(F.when((F.col("_sh_k") == c[0]) & (key < of(c)), size)).alias(f"l{j}"),
            F.sum(F.when(F.col("_sh_k") == c[0], size)).alias(f"a{j}"), F.count(F.when(key == of(c), 1)).alias(f"n{j}"))]
        got = keys.filter(F.col("_sh_k").isin(at)).agg(*side).first()
        for j, c in cuts.items():
            if c and (got[f"a{j}"] or 0) <= GROUP_SHARE * total / n_shards:
                low = (got[f"l{j}"] or 0) * 2 <= (got[f"a{j}"] or 0)
                cuts[j] = (c[0] + (not low), _LEAST, 0)
            elif c and got[f"n{j}"] > 1:
                torn.append(c[:2])
    inner = sorted(c for c in cuts.values() if c)
    splits[:] = sorted(set(splits) | set(inner))
    counts = dict(_range_of(keys, splits).groupBy("_sh_range").count().collect())
    out, slots = [], [0] * n_shards
    for r in range(len(splits) + 1):
        shard = bisect_right(inner, splits[r - 1]) if r else bisect_right(inner, (_LEAST, _LEAST, 0))
        out.append((shard, slots[shard], counts.get(r, 0)))
        slots[shard] += counts.get(r, 0)
    return out, torn


def _numbered(keyed: DataFrame, keys: list[tuple[int, int]], scratch: Scratch) -> DataFrame:
    """``keyed`` with a number for each row of the given keys; they are at most ranges and cuts."""
    some = keyed.sparkSession.createDataFrame([(*k, True) for k in keys], "_sh_k long, _sh_id long, _sh_many boolean")
    marked = keyed.join(F.broadcast(some), ["_sh_k", "_sh_id"], "left")
    many = scratch.save(marked.filter("_sh_many").withColumn("_sh_n", F.monotonically_increasing_id()).select(*keyed.columns))
    return marked.filter("_sh_many IS NULL").select(*keyed.columns).unionByName(many)


def shard(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """``docs`` (doc_id, text and any others) with ``shard`` and ``slot``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "sharding")
    keyed = _keyed(docs)
    splits, layout, many = plan(scratch.save(keyed.select(*_KEY, "_sh_size")), n_shards)
    if many:  # once is enough: afterwards no two rows of these keys are alike
        keyed = _numbered(keyed, many, scratch)
        splits, layout, _ = plan(scratch.save(keyed.select(*_KEY, "_sh_size")), n_shards)
    others = [c for c in docs.columns if c not in ("shard", "slot")]
    if not layout:
        return docs.select(*others, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")).limit(0)
    table = spark.createDataFrame([(r, s, b) for r, (s, b, _) in enumerate(layout)], "_sh_range int, _sh_shard int, _sh_first long")
    place = Window.partitionBy("_sh_range").orderBy(*_KEY)
    return (_range_of(keyed, splits).withColumn("_sh_at", F.row_number().over(place))
            .join(F.broadcast(table), "_sh_range")  # at most MAX_RANGES rows and their subdivisions
            .select(*others, F.col("_sh_shard").alias("shard"), (F.col("_sh_first") + F.col("_sh_at") - 1).alias("slot")))
