"""Mini-batch k-means and its building blocks.

Points: ``(id, features array<double>)``.  Centroids are a K x D summary
(bounded by the parameters, not by the data): the driver holds them between
iterations and every task receives them as a NumPy matrix.  Points are never
crossed with the centroid table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.operators.sampling import in_sample, sample_cutoffs, sample_fixed, seeded_hash
from webloom.session import Scratch

# Cells of distances that a task holds at a time.
CELLS = 1 << 20
# Fewer centroids are compared one and all.
PRUNE_FROM = 32
# Share of a block's pairs from which on all of them are worked out.
DENSE = 0.15


def euclidean(a, b) -> Column:
    """sqrt(sum((a_i - b_i)^2)), summed left to right."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    sq = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, v: acc + v))


def vector_add(a, b) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.zip_with(a, b, lambda x, y: x + y)


@dataclass
class Centroids:
    """K x D centroid summary kept on the driver (cids in table order), and
    the clustering error of each iteration's batch (sum of distances to the
    nearest previous centroid), as the reference prints per iteration."""
    cids: list
    vectors: np.ndarray           # K x D
    counts: np.ndarray            # K, the per-centroid count slot
    errors: list = field(default_factory=list)

    def to_df(self, spark) -> DataFrame:
        rows = [(int(c), [float(x) for x in v], int(n))
                for c, v, n in zip(self.cids, self.vectors, self.counts)]
        return spark.createDataFrame(rows, "cid int, features array<double>, n long")


def _squares(x: np.ndarray, mat: np.ndarray) -> np.ndarray:
    """Squared distances of vectors (last axis; the others broadcast), summed left to right over the
    dimensions, so results don't depend on how many are worked out at once."""
    total = np.zeros(np.broadcast_shapes(x.shape[:-1], mat.shape[:-1]))
    for j in range(mat.shape[-1]):
        diff = x[..., j] - mat[..., j]
        total += diff * diff
    return total


def nearest(x: np.ndarray, mat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row of the nearest centroid (the first wins ties) and the distance to it, from all distances."""
    pick, dist = np.zeros(len(x), dtype=np.int64), np.full(len(x), np.inf)
    rows = max(1, CELLS // max(1, len(mat)))
    for s in range(0, len(x), rows):
        total = _squares(x[s:s + rows, None], mat[None])
        pick[s:s + rows] = total.argmin(axis=1)
        dist[s:s + rows] = np.sqrt(total.min(axis=1))
    return pick, dist


class Groups:
    """Centroids in about sqrt(K) groups, each around one of them (farthest first), with their distances to it.

    For a point at distance t of a group's middle, a centroid at distance g of that middle is at least
    |t - g| away; if that is more than the distance to a centroid known already, it is passed over.  The
    margin for rounding is many times what the sums can be off, so the nearest centroid, and every
    other at the same distance, is always compared: results are those of ``nearest``.
    """

    def __init__(self, mat: np.ndarray):
        self.mat = mat
        owner, gap, middles = np.zeros(len(mat), dtype=np.int64), np.full(len(mat), np.inf), []
        for _ in range(int(np.ceil(np.sqrt(len(mat))))):
            at = int(gap.argmax())
            if gap[at] == 0:
                break
            d = np.sqrt(_squares(mat, mat[at]))
            closer = d < gap
            owner[closer], gap[closer] = len(middles), d[closer]
            middles.append(at)
        self.gap, self.middles = gap, np.array(middles)
        self.members = [np.flatnonzero(owner == g) for g in range(len(middles))]
        self.reach = np.array([gap[m].max() for m in self.members])
        self.margin = 8 * (mat.shape[1] + 8) * np.finfo(float).eps

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """As ``nearest``, and how many distances were worked out."""
        pick, dist, made = np.zeros(len(x), dtype=np.int64), np.full(len(x), np.inf), 0
        rows = max(1, CELLS // (len(self.members) + max(map(len, self.members))))
        for s in range(0, len(x), rows):
            pick[s:s + rows], dist[s:s + rows], n = self._chunk(x[s:s + rows])
            made += n
        return pick, dist, made

    def _chunk(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        best = _squares(x[:, None], self.mat[self.middles][None])
        to, made = np.sqrt(best), best.size
        own, pick = to.argmin(axis=1), np.full(len(x), len(self.mat))
        best = best.min(axis=1)
        slack = self.margin * (to.max(axis=1) + self.gap.max())
        odd = ~np.isfinite(to).all(axis=1)  # infinite components or sums: all distances
        for first in (True, False):  # a point's own group first: it bounds the others
            for g, members in enumerate(self.members):
                limit = np.sqrt(best) + slack
                at = np.flatnonzero(((own == g) == first) & ~odd & (to[:, g] - self.reach[g] <= limit))
                near = np.abs(to[at, g, None] - self.gap[members][None]) <= limit[at, None]
                n = np.count_nonzero(near)
                if not n:
                    continue
                if n > DENSE * near.size:  # little to spare: all pairs, which need not be gathered
                    total = _squares(x[at][:, None], self.mat[members][None])
                    least, which, of = total.min(axis=1), members[total.argmin(axis=1)], at
                    n = total.size
                else:
                    i, j = np.nonzero(near)
                    total = _squares(x[at[i]], self.mat[members[j]])
                    runs = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
                    least, of = np.minimum.reduceat(total, runs), at[i[runs]]
                    tied = total == np.repeat(least, np.diff(np.r_[runs, len(i)]))
                    which = np.minimum.reduceat(np.where(tied, members[j], len(self.mat)), runs)
                made += n
                wins = (least < best[of]) | ((least == best[of]) & (which < pick[of]))
                best[of[wins]], pick[of[wins]] = least[wins], which[wins]
        dist = np.sqrt(best)
        pick[odd], dist[odd] = nearest(x[odd], self.mat)
        return pick, dist, made + int(odd.sum()) * len(self.mat)


def assign(points: DataFrame, cents: Centroids, features: str = "features", made=None) -> DataFrame:
    """Points with their nearest centroid: (..., cid, dist); both are null for a vector that is null, of
    another length than the centroids, or holds null or NaN.

    From ``PRUNE_FROM`` centroids on, bounds between them spare most distances (see ``Groups``; same
    results).  ``made``, an accumulator, counts the distances worked out."""
    from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType
    import pyarrow as pa
    import pyarrow.compute as pc
    mat, ids = np.asarray(cents.vectors, dtype=np.float64), np.asarray(cents.cids, dtype=np.int32)
    schema = StructType([*points.schema.fields, StructField("cid", IntegerType()), StructField("dist", DoubleType())])
    groups = Groups(mat) if len(mat) >= PRUNE_FROM and np.isfinite(mat).all() else None

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            col = b.column(features)
            fits = np.flatnonzero(pc.list_value_length(col).fill_null(-1).to_numpy() == mat.shape[1])
            x = col.take(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(fits), mat.shape[1])
            fits, x = fits[~np.isnan(x).any(axis=1)], x[~np.isnan(x).any(axis=1)]  # nulls come as NaN
            cid, dist, none = np.zeros(b.num_rows, dtype=np.int32), np.zeros(b.num_rows), np.ones(b.num_rows, dtype=bool)
            if groups is None:
                pick, dist[fits] = nearest(x, mat)
                n = len(x) * len(mat)
            else:
                pick, dist[fits], n = groups.nearest(x)
            if made is not None:
                made.add(n)
            cid[fits], none[fits] = ids[pick], False
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cid, mask=none), pa.array(dist, mask=none)], [*b.schema.names, "cid", "dist"])

    return points.mapInArrow(run, schema)


def cluster_sums(assigned: DataFrame, features: str = "features") -> DataFrame:
    """(cid, sum array<double>, n): element-wise sum and count per cluster.

    One aggregation buffer per cluster and task (partial aggregation), so a
    cluster holding a third of the points is combined map-side.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    extra = [F.sum("dist").alias("err")] if "dist" in assigned.columns else []
    agg = assigned.filter("cid IS NOT NULL").groupBy("cid").agg(
        Summarizer.sum(array_to_vector(features)).alias("_s"), F.count(F.lit(1)).alias("n"), *extra)
    return agg.select("cid", vector_to_array("_s").alias("sum"), "n", *[e for e in ["err"] if extra])


def clustering_error(assigned: DataFrame) -> DataFrame:
    """Sum of distances to the nearest centroid (one row)."""
    return assigned.agg(F.sum("dist").alias("error"))


def init_centroids(points: DataFrame, k: int, seed: int, id_col: str = "id",
                   features: str = "features", total: int | None = None) -> Centroids:
    """K start centroids: the points with the smallest seeded hash (cid 0..K-1
    in hash order).  K rows reach the driver."""
    return _start(sample_fixed(points.select(id_col, features), k, seed, id_col, total), seed, id_col, features)


def _start(pick: DataFrame, seed: int, id_col: str, features: str) -> Centroids:
    rows = pick.withColumn("_h", seeded_hash(id_col, seed)).orderBy("_h", id_col).collect()
    vecs = np.array([r[features] for r in rows], dtype=np.float64)
    return Centroids(list(range(len(rows))), vecs, np.zeros(len(rows), dtype=np.int64))


def update_centroids(prev: Centroids, sums: list, count_mode: str = "reset",
                     drop_empty: bool = False) -> Centroids:
    """Mini-batch update: c = (prev * prev_n + sum) / (prev_n + n).

    count_mode 'reset' zeroes the count slot after every update (the
    reference's behaviour: each centroid becomes the mean of its batch
    members); 'cumulative' keeps it (per-centre learning rate).  Clusters
    with no batch member keep their previous centroid, or vanish with
    ``drop_empty``.
    """
    got = {int(r["cid"]): (np.asarray(r["sum"], dtype=np.float64), int(r["n"])) for r in sums}
    cids, vecs, counts = [], [], []
    for i, c in enumerate(prev.cids):
        if c in got:
            s, n = got[c]
            tot = prev.counts[i] + n
            vecs.append((prev.vectors[i] * prev.counts[i] + s) / tot)
            counts.append(0 if count_mode == "reset" else tot)
            cids.append(c)
        elif not drop_empty:
            vecs.append(prev.vectors[i])
            counts.append(prev.counts[i])
            cids.append(c)
    keys = (sums[0].asDict() if hasattr(sums[0], "asDict") else sums[0]).keys() if sums else ()
    err = sum(float(r["err"]) for r in sums) if "err" in keys else None
    return Centroids(cids, np.array(vecs, dtype=np.float64).reshape(len(cids), -1),
                     np.array(counts, dtype=np.int64), prev.errors + ([err] if err is not None else []))


def kmeans_step(points: DataFrame, cents: Centroids, batch: int, seed: int,
                count_mode: str = "reset", drop_empty: bool = False,
                id_col: str = "id", features: str = "features", total: int | None = None) -> Centroids:
    """One iteration: sample a batch, assign, sum per cluster (K rows to the
    driver), update."""
    drawn = sample_fixed(points.select(id_col, features), batch, seed, id_col, total)
    return _update(drawn, cents, count_mode, drop_empty, features)


def _update(batch: DataFrame, cents: Centroids, count_mode: str, drop_empty: bool, features: str) -> Centroids:
    return update_centroids(cents, cluster_sums(assign(batch, cents, features), features).collect(), count_mode, drop_empty)


def kmeans_minibatch(points: DataFrame, k: int, batch: int, iterations: int, seed: int = 0,
                     init: Centroids | None = None, count_mode: str = "reset",
                     drop_empty: bool = False, id_col: str = "id",
                     features: str = "features") -> Centroids:
    """Mini-batch k-means with a fixed iteration count.

    Iteration i samples its batch with seed ``seed + i + 1`` (init uses
    ``seed``).  All cut-offs come from one pass over ids; one more scan writes
    the rows of all batches (iterations x batch, plus the start), tagged by
    seed; iterations read only their own rows.  The point table is never cached.
    """
    pts = points.select(id_col, features)
    scratch = Scratch(points.sparkSession, "kmeans")
    n = pts.count()
    seeds = [seed + i + 1 for i in range(iterations)]
    wanted = [(sd, batch) for sd in seeds] + ([] if init is not None else [(seed, k)])
    cuts = {sd: c for size in {b for _, b in wanted}
            for sd, c in sample_cutoffs(pts, size, [s for s, b in wanted if b == size], id_col, n).items()}
    tags = F.filter(F.array(*[F.when(in_sample(sd, cuts[sd], id_col), F.lit(sd)) for sd, _ in wanted]), lambda t: t.isNotNull())
    drawn = scratch.save(pts.withColumn("_seed", F.explode(tags)).coalesce(max(1, -(-iterations * batch // 100_000)))
                         if batch < n else pts.withColumn("_seed", F.explode(tags)), "_seed")
    of = lambda sd: drawn.filter(F.col("_seed") == sd).select(id_col, features)
    cents = init if init is not None else _start(of(seed), seed, id_col, features)
    for sd in seeds:
        cents = _update(of(sd), cents, count_mode, drop_empty, features)
    scratch.drop(drawn)
    return cents


def centroid_lines(cents_df: DataFrame, digits: int | None = None) -> DataFrame:
    """(cid, line): each dimension followed by a TAB (trailing TAB), count slot omitted."""
    fmt = (lambda x: x.cast("string")) if digits is None else \
        (lambda x: F.format_string(f"%.{digits}f", x))
    return cents_df.select("cid", F.concat(F.array_join(F.transform("features", fmt), "\t"),
                                           F.lit("\t")).alias("line"))
