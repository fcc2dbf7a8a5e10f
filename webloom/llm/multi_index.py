"""Nearest neighbours by largest inner product with an inverted multi-index.

Vectors are divided by the largest norm and given one more component that makes them
unit vectors, so that the order by distance from a query (with 0 there) is the order by
inner product.  The two halves are quantised by k-means apart from each other; a pair of
centroids is a cell.  A query visits cells by the sum of its two squared distances,
taken from a heap over the two sorted lists, until the cells hold ``visit`` vectors;
what they hold is ranked by exact inner products.

The codebooks are fitted to a sample of ``SAMPLE`` vectors and ``PER_CENTROID`` a centroid
at most; all vectors are indexed.  ``visit`` is not a parameter of the data's
size: for ``AUDIT`` sampled queries all vectors are compared, and ``visit`` is chosen so
that half of them reach a recall of ``RECALL``; the other half must confirm it
(``CONFIRM``), or it is raised until it does.  It can rise to all vectors, so a recall
below that bound is never returned.  How large it has to be lies in the data: on vectors without
structure every index has to look at much of the table.

Equal vectors are one entry with its k + 1 smallest ids, which is all that a list of k can
hold, so a vector that a third of the rows share costs as much as any other.  A cell is
dealt to parts of about ``PART`` entries and ``ASKED`` queries, so a cell that is large or often
visited is many tasks' work.  A part's rows come sorted, entries first; its queries then
meet them as matrices, and a task hands on the k best of each query only: no pairs are
listed.  Centroids (2 x ``MAX_K``), cell sizes (``MAX_K`` squared) and audit queries are all
that the driver and the tasks share.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no
part, nor do rows with a null vec_id; vectors of different length do not meet (an index for each
length); a vec_id that repeats counts once, by its smallest embedding; equal scores by vec_id; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm.common import Scratch, cut_points

K = 20
CELL = 256           # entries a cell holds on average
MAX_K = 2_048
SAMPLE = 32_768
PER_CENTROID = 64
TURNS = 10           # of k-means
AUDIT = 512
RECALL, CONFIRM = 0.95, 0.93
PART = 8_192
ASKED = 65_536
PACK = 256           # queries of a batch that visit a cell and travel together
HELD = 400_000       # results that a task holds before it thins them out
SEED = 11


def component_type(rows: DataFrame) -> str:
    """Vectors are kept in the type they came in: single precision, or else double."""
    return "<f4" if rows.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"


def valid_vectors(rows: DataFrame, kind: str = "<f8") -> DataFrame:
    """(vec_id, v binary, dim, norm): one row per vec_id with a vector that takes part."""
    def run(batches):
        for b in batches:
            keep, out, dims, norms = [], [], [], []
            for i, x in enumerate(b.column("embedding").to_pylist()):
                if not x or None in x:
                    continue
                a = np.array(x, dtype=np.float64) + 0.0  # no negative zeros
                if np.isfinite(a).all() and a.any():
                    keep.append(i)
                    out.append(a.astype(kind).tobytes())
                    dims.append(len(x))
                    with np.errstate(over="ignore"):
                        norms.append(float(np.sqrt(a @ a)))
            yield pa.RecordBatch.from_arrays([b.column("vec_id").take(pa.array(keep, pa.int64())), pa.array(out, pa.binary()),
                                              pa.array(dims, pa.int32()), pa.array(norms, pa.float64())], ["vec_id", "v", "dim", "norm"])
    one = (rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter("vec_id IS NOT NULL AND embedding IS NOT NULL")
           .groupBy("vec_id").agg(F.min("embedding").alias("embedding")))
    return one.mapInArrow(run, "vec_id long, v binary, dim int, norm double")


def _matrix(column, dim: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=kind).reshape(-1, dim).astype(np.float64)


def k_means(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centroids; as many begin in a dense region as rows of the sample lie there."""
    rng = np.random.default_rng([SEED, seed])
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(TURNS if x.shape[1] else 0):
        own = nearest(x, centres)
        order = np.argsort(own, kind="stable")
        cut = cut_points(own[order])
        centres[own[order][cut[:-1]]] = np.add.reduceat(x[order], cut[:-1]) / np.diff(cut)[:, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres * centres).sum(1) / 2
    return np.concatenate([np.argmin(half - x[i:i + 4096] @ centres.T, axis=1) for i in range(0, len(x), 4096)] or [np.zeros(0, dtype=np.int64)])


@dataclass
class Codebooks:
    """Both halves' centroids, the largest norm, and the entries of every cell."""
    first: np.ndarray
    second: np.ndarray
    norm: float
    kind: str
    sizes: np.ndarray

    @property
    def half(self) -> int:
        return self.first.shape[1]

    def lift(self, x: np.ndarray) -> np.ndarray:
        x = x / self.norm
        return np.concatenate([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(1)))[:, None]], axis=1)

    def cells(self, x: np.ndarray) -> np.ndarray:
        x = self.lift(x)
        return nearest(x[:, :self.half], self.first) * len(self.second) + nearest(x[:, self.half:], self.second)

    def distances(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of one query's halves from the centroids."""
        q = np.append(q / np.sqrt(q @ q), 0.0)
        return ((self.first - q[:self.half]) ** 2).sum(1), ((self.second - q[self.half:]) ** 2).sum(1)

    def visited(self, q: np.ndarray, visit: int) -> Iterator[int]:
        """Cells by growing sum of distances until they hold ``visit`` entries."""
        d1, d2 = self.distances(q)
        o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
        s1, s2 = d1[o1].tolist(), d2[o2].tolist()
        heap, held, width = [(s1[0] + s2[0], 0, 0)], 0, len(s2)
        while heap and held < visit:
            _, i, j = heapq.heappop(heap)
            if j + 1 < width:
                heapq.heappush(heap, (s1[i] + s2[j + 1], i, j + 1))
            if not j and i + 1 < len(s1):
                heapq.heappush(heap, (s1[i + 1] + s2[0], i + 1, 0))
            cell = int(o1[i]) * width + int(o2[j])
            if n := int(self.sizes[cell]):
                held += n
                yield cell

    def ahead(self, q: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Entries in the cells that a query visits before each of some cells."""
        d1, d2 = self.distances(q)
        sums = (d1[:, None] + d2[None, :]).ravel()
        return np.array([int(self.sizes[sums <= sums[c]].sum() - self.sizes[c]) for c in cells], dtype=np.int64)


def _entries(vectors: DataFrame, scratch: Scratch, k: int) -> DataFrame:
    """(v, dim, norm, ids): different vectors, each with its k + 1 smallest vec_ids in order."""
    first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = vectors.withColumn("at", first).filter(F.col("at") <= k + 1)
    return scratch.save(few.groupBy("v").agg(F.first("dim").alias("dim"), F.first("norm").alias("norm"),
                                             F.array_sort(F.collect_list("vec_id")).alias("ids")))


def fit(entries: DataFrame, dim: int, n: int, norm: float, kind: str) -> Codebooks:
    """Codebooks from a bounded sample; cell sizes are still to be counted."""
    k = int(np.clip(np.ceil(np.sqrt(n / CELL)), 1, MAX_K))
    want = min(n, max(SAMPLE, PER_CENTROID * k))
    u = F.pmod(F.xxhash64("v", F.lit(SEED)), F.lit(1 << 40))
    drawn = entries.filter(u < int((1 << 40) * min(1.0, 1.2 * want / n))).select("v").limit(want).collect()
    index = Codebooks(np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2 + 1)), norm, kind, np.zeros(1, dtype=np.int64))
    x = index.lift(_matrix([r[0] for r in drawn], dim, kind))
    k = min(k, len(x))
    index.first, index.second = k_means(x[:, :dim // 2], k if dim > 1 else 1, 1), k_means(x[:, dim // 2:], k, 2)
    return index


def _in_cells(index: Codebooks, dim: int):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(index.cells(_matrix(b.column("v").to_pylist(), dim, index.kind))), b.column("v"), b.column("ids")],
                                             ["cell", "v", "ids"])
    return run


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed from the first component to the last."""
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    out = np.zeros(a.shape[1])
    for x, y in zip(a, b):
        out += x * y
    return out


def _best_pairs(q: np.ndarray, x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of x, score) of every pair that may be among a row's ``most`` best."""
    s = q @ x.T
    if s.shape[1] > most:
        # the sums of a matrix product may differ in their last digits
        slack = 8e-16 * q.shape[1] * np.sqrt((q * q).sum(1) * (x * x).sum(1).max())
        i, j = np.nonzero(s >= (np.partition(s, s.shape[1] - most, axis=1)[:, s.shape[1] - most] - slack)[:, None])
    else:
        i, j = (a.ravel() for a in np.indices(s.shape))
    return i, j, products(q[i], x[j])


def _thinned(rows: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    """The k best (query, id, score, ...) of each query."""
    cols = [np.concatenate(c) for c in zip(*rows)]
    order = np.lexsort((cols[1], -cols[2], cols[0]))
    cols = [c[order] for c in cols]
    cut = cut_points(cols[0])
    keep = np.arange(len(cols[0])) - np.repeat(cut[:-1], np.diff(cut)) < k
    return tuple(c[keep] for c in cols)


def _results(found: Iterator[tuple[np.ndarray, ...]], k: int, names: list[str]):
    """Results of a task, thinned out whenever they have become many."""
    batch = lambda cols: pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)
    held, size = [], 0
    for cols in found:
        held.append(cols)
        size += len(cols[0])
        if size > HELD:
            held = [_thinned(held, k)]
            size = len(held[0][0])
            if size > HELD // 2:
                yield batch(held[0])
                held, size = [], 0
    if size:
        yield batch(_thinned(held, k))


def _audit(cells: DataFrame, queries: list, dim: int, kind: str, k: int) -> DataFrame:
    """(query, vec_id, score, cell): the exact neighbours of a few queries."""
    own, q = np.array([r[0] for r in queries], dtype=np.int64), _matrix([r[1] for r in queries], dim, kind)

    def run(batches):
        def found():
            for b in batches:
                ids, cell = b.column("ids").to_pylist(), b.column("cell").to_numpy()
                i, j, s = _best_pairs(q, _matrix(b.column("v").to_pylist(), dim, kind), k + 1)
                yield _spread(own[i], j, s, ids, cell[j])
        yield from _results(found(), k, ["query", "vec_id", "score", "cell"])
    return _top(cells.mapInArrow(run, "query long, vec_id long, score double, cell long"), k)


def _spread(query: np.ndarray, j: np.ndarray, score: np.ndarray, ids: list, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """Entries as rows of their ids, without the query's own."""
    counts = np.array([len(x) for x in ids], dtype=np.int64)
    flat, first = np.array([y for x in ids for y in x], dtype=np.int64), np.cumsum(counts) - counts
    n = counts[j]
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[j], n)
    cols = [np.repeat(query, n), flat[at], *(np.repeat(c, n) for c in (score, *more))]
    other = cols[0] != cols[1]
    return tuple(c[other] for c in cols)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def calibrate(index: Codebooks, queries: list, truth: list) -> tuple[int, float]:
    """Entries that a query must visit, and the recall this gave on queries that did not set it."""
    found: dict[int, list] = {}
    for r in truth:
        found.setdefault(r["query"], []).append(r["cell"])
    needs = [(index.ahead(np.frombuffer(v, dtype=index.kind).astype(np.float64), np.array(found[i])) + 1) for i, v in queries if i in found]
    if not needs:
        return 1, 1.0

    def reach(some, recall):
        need, weight = np.concatenate(some), np.concatenate([np.full(len(x), 1 / len(x)) for x in some])
        order = np.argsort(need)
        return int(need[order][np.searchsorted(np.cumsum(weight[order]), recall * len(some) - 1e-9)])
    mine, others = needs[::2], needs[1::2] or needs
    visit = max(reach(mine, RECALL), reach(others, CONFIRM))
    return visit, float(np.mean([(x <= visit).mean() for x in others]))


def _probes(index: Codebooks, visit: int, dim: int):
    """Queries packed by the cells they visit: (cell, ids, v), the vectors end to end."""
    def run(batches):
        for b in batches:
            for start in range(0, b.num_rows, PACK):
                some = b.slice(start, PACK)
                ids, raw = some.column("vec_id").to_numpy(), some.column("v").to_pylist()
                own = [np.fromiter(index.visited(q, visit), dtype=np.int64) for q in _matrix(raw, dim, index.kind)]
                row, cell = np.repeat(np.arange(len(raw)), [len(x) for x in own]), np.concatenate(own)
                order = np.argsort(cell, kind="stable")
                row, cell = row[order], cell[order]
                cut = cut_points(cell)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell[cut[:-1]]), pa.array([b"".join(raw[r] for r in row[i:j]) for i, j in zip(cut[:-1], cut[1:])], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(ids[row]))], ["cell", "v", "ids"])
    return run


def _met(cells: DataFrame, probes: DataFrame, scratch: Scratch) -> DataFrame:
    """(cell, part, asked, kind, v, ids): entries (kind 0) and queries (kind 1), dealt to the parts where they meet."""
    layout = scratch.save(cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts"))
                          .join(probes.groupBy("cell").agg(F.ceil(F.sum(F.size("ids")) / ASKED).alias("turns")), "cell"))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    one = lambda n: F.pmod(F.xxhash64("v"), F.col(n))
    entries = cells.join(layout, "cell").withColumn("part", one("parts")).withColumn("asked", each("turns"))
    queries = probes.join(layout, "cell").withColumn("part", each("parts")).withColumn("asked", one("turns"))
    row = lambda df, kind: df.select("cell", "part", "asked", F.lit(kind).alias("kind"), "v", "ids")
    return (row(entries, 0).unionByName(row(queries, 1)).repartition("cell", "part", "asked")
            .sortWithinPartitions("cell", "part", "asked", "kind"))


def _rerank(dim: int, kind: str, k: int):
    def run(batches):
        def found():
            key, entries, ids, x = None, [], [], None
            for b in batches:
                cols = [b.column(c).to_numpy() for c in ("cell", "part", "asked", "kind")]
                cut = cut_points(*cols)
                for i, j in zip(cut[:-1], cut[1:]):
                    *here, asks = (int(c[i]) for c in cols)
                    if here != key:
                        key, entries, ids, x = here, [], [], None
                    v, own = b.column("v").slice(i, j - i).to_pylist(), b.column("ids").slice(i, j - i).to_pylist()
                    if not asks:
                        entries += v
                        ids += own
                        continue
                    x = _matrix(entries, dim, kind) if x is None else x
                    for at in range(0, len(v), 4):  # about a thousand queries
                        query = np.concatenate([np.array(y, dtype=np.int64) for y in own[at:at + 4]])
                        rows, near, score = _best_pairs(_matrix(v[at:at + 4], dim, kind), x, k + 1)
                        yield _thinned([_spread(query[rows], near, score, ids)], k)
        yield from _results(found(), k, ["query", "vec_id", "score"])
    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): for each of ``queries`` (vec_id, embedding) the ``k`` rows of
    ``vectors`` with the largest inner product, the row of the query's own vec_id left out."""
    scratch, kind = Scratch(vectors.sparkSession, "multi-index"), max(component_type(vectors), component_type(queries))
    entries = _entries(scratch.save(valid_vectors(vectors, kind)), scratch, k)
    asked = scratch.save(valid_vectors(queries, kind).select("vec_id", "v", "dim"))
    out = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for dim, n, norm in entries.groupBy("dim").agg(F.count(F.lit(1)), F.max("norm")).collect():  # one row per length of a vector
        here, own = entries.filter(F.col("dim") == dim), asked.filter(F.col("dim") == dim).select("vec_id", "v")
        sample = own.orderBy(F.xxhash64("vec_id", F.lit(SEED)), "vec_id").limit(AUDIT).collect()
        if not sample:
            continue
        index = fit(here, dim, n, norm, kind)
        cells = scratch.save(here.mapInArrow(_in_cells(index, dim), "cell long, v binary, ids array<long>"))
        index.sizes = np.zeros(len(index.first) * len(index.second), dtype=np.int64)
        for cell, size in cells.groupBy("cell").count().collect():  # at most MAX_K x MAX_K
            index.sizes[cell] = size
        visit, _ = calibrate(index, sample, _audit(cells, sample, dim, kind, k).select("query", "cell").collect())
        probes = scratch.save(own.mapInArrow(_probes(index, visit, dim), "cell long, v binary, ids array<long>"))
        found = scratch.save(_met(cells, probes, scratch).mapInArrow(_rerank(dim, kind, k), "query long, vec_id long, score double"))
        scratch.drop(cells, probes)
        out = out.unionByName(_top(found, k).select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
    return out
