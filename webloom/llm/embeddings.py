"""Embedding near-duplicates by NN-descent.

1. Balls.  Vectors of a tight group need no pairwise search: whatever lies
   within half the link angle of a pivot is linked to everything else there
   (triangle inequality).  In each round vectors are bucketed (first by equal
   vectors, then by the signs of seeded random projections), a bucket's pivot is
   the centre of its largest ball, and near vectors move to that ball if it is
   larger than their own.  What stays alone is a ball of radius 0.
2. NN-descent over the balls, by angle between centres less both radii: neighbour
   lists begin with the nearest inside the leaves of several independent random
   projections and, for the first step, random balls of other leaves, so that the
   graph is connected across leaves (one projection's lists never leave a leaf); then
   every ball's neighbours and reverse neighbours are joined with each other
   (pairs with a new entry only) until few lists change.  A list whose entries
   are all links is saturated and is doubled.  A ball that many lists name has its
   entries dealt anew each step to groups of at most about ``GROUP``.
   The search uses vectors rounded to bytes; it only proposes.
3. Links.  Proposed pairs of balls are decided in double precision: all members
   linked, none, or, in between, members compared in chunks.
4. Audit.  Random vectors are compared with all others, block by block, until
   ``AUDIT`` of them have a link outside their own ball or no vector is left.
   Recall is the mean over those of the share of such links that was found, so
   neither vectors without links nor large groups hide what small ones lose.  Below
   ``RECALL`` the descent goes on with twice the projections (and, ``MAX_AUDITS``
   times, lists twice as long); after ``MAX_TURNS`` it fails.

No pairs of vectors are ever emitted, only links between balls.  Joins take plain
tables of the shared folder on both sides, so hot balls can be split.

Defined results: a vector that is null, empty, zero or holds null or non-finite
components links with nothing, nor do vectors of different length; a vec_id
that repeats counts once, by its smallest embedding; a null vec_id comes out
unlinked and not kept; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from webloom.llm.common import Scratch, cut_points
from webloom.llm.components import connected_components

COSINE = 0.9
NEIGHBOURS = 10
ROUNDS = 6
LEAF = 256
TREES = 4
STRAYS = 4
MAX_STEPS = 12
SETTLED = 0.02
GROUP = 256
CHUNK = 256
AUDIT = 256
RECALL = 0.98
MAX_AUDITS = 4
AUDIT_BYTES = 1 << 21  # of the vectors that are compared with all others at a time
MAX_TURNS = 9
SEED = 77
_SLACK = 0.03  # of an angle, for vectors rounded to bytes


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype=dtype).reshape(len(rows), -1)


def _angle(cos: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cos, -1.0, 1.0))


@lru_cache(maxsize=64)
def _planes(dim: int, bits: int, turn: int) -> np.ndarray:
    return np.random.default_rng([SEED, turn, bits]).standard_normal((dim, bits))


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v binary, dim int): doubles of length one; v is null where nothing can link."""
    def run(batches):
        for b in batches:
            out, dims = [], []
            for x in b.column("embedding").to_pylist():
                v = None
                if x and None not in x:
                    a = np.array(x, dtype=np.float64)
                    top = np.abs(a).max()
                    if np.isfinite(a).all() and top > 0:
                        a = a / top
                        v = (a / np.linalg.norm(a)).tobytes()
                out.append(v)
                dims.append(len(x) if v else 0)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(out, pa.binary()), pa.array(dims, pa.int32())], ["vec_id", "v", "dim"])
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter("vec_id IS NOT NULL")
            .groupBy("vec_id").agg(F.min("embedding").alias("embedding")))
    return rows.mapInArrow(run, "vec_id long, v binary, dim int")


def _balls(rows: DataFrame, scratch: Scratch, n: int, half: float, rounds: int) -> DataFrame:
    """(vec_id, v, dim, ball, angle): the centre's vec_id of each vector's ball, and the angle to it."""
    now = scratch.save(rows.select("vec_id", "v", "dim", F.col("vec_id").alias("ball"), F.lit(0.0).alias("angle")))
    bits = int(np.clip(np.ceil(np.log2(max(2, n) / LEAF)) + 2, 1, 30))

    def place(turn):
        def run(batches):
            for b in batches:
                keys = [int(((x @ _planes(len(x), bits, turn)) > 0) @ weights) for x in map(np.frombuffer, b.column("v").to_pylist())]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.int64())], [*b.schema.names, "bucket"])
        weights = 1 << np.arange(bits)
        return run

    def near(batches):
        for b in batches:
            out = [_angle(np.frombuffer(x) @ np.frombuffer(y)) if x != y else 0.0 for x, y in
                   zip(b.column("v").to_pylist(), b.column("pv").to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, pa.float64())], [*b.schema.names[:-1], "far"])

    for turn in range(rounds + 1):
        sizes = now.groupBy("ball").agg(F.count(F.lit(1)).alias("size"))
        with_size = now.join(scratch.save(sizes), "ball")
        if turn:
            keyed = with_size.mapInArrow(place(turn), "ball long, vec_id long, v binary, dim int, angle double, size long, bucket long")
        else:
            keyed = with_size.withColumn("bucket", F.xxhash64("v"))
        keyed = scratch.save(keyed)
        centre = F.struct((-F.col("size")).alias("less"), F.xxhash64("vec_id", F.lit(turn)).alias("u"), F.col("vec_id").alias("p"))
        pivots = scratch.save(keyed.filter("vec_id = ball").groupBy("bucket", "dim").agg(
            F.min(centre).alias("c"), F.min_by("v", centre).alias("pv"))
            .select("bucket", "dim", F.col("c.p").alias("p"), (-F.col("c.less")).alias("psize"), "pv"))
        paired = keyed.join(pivots, ["bucket", "dim"], "left").select("vec_id", "v", "dim", "ball", "angle", "size", "p", "psize", F.coalesce("pv", "v").alias("pv"))
        schema = "vec_id long, v binary, dim int, ball long, angle double, size long, p long, psize long, far double"
        moves = ((F.col("far") <= half) & (F.col("p") != F.col("ball")) & ((F.col("vec_id") != F.col("ball")) | (F.col("size") == 1))
                 & ((F.col("psize") > F.col("size")) | ((F.col("psize") == F.col("size")) & (F.col("p") < F.col("ball")))))
        moved = paired.mapInArrow(near, schema).select(
            "vec_id", "v", "dim", F.when(moves, F.col("p")).otherwise(F.col("ball")).alias("ball"),
            F.when(moves, F.col("far")).otherwise(F.col("angle")).alias("angle"))
        moved = scratch.save(moved)
        # a centre may have joined another ball in the step in which it got members: those are alone again
        centres = moved.filter("vec_id = ball").select(F.col("ball").alias("c"))
        old, now = now, scratch.save(moved.join(scratch.save(centres), F.col("ball") == F.col("c"), "left").select(
            "vec_id", "v", "dim", F.coalesce("c", "vec_id").alias("ball"), F.when(F.col("c").isNull(), 0.0).otherwise(F.col("angle")).alias("angle")))
        scratch.drop(old, keyed, moved)
    return now


def _rounded(batches):
    for b in batches:
        out = []
        for v in b.column("v").to_pylist():
            x = np.frombuffer(v)
            out.append(np.round(x * (127 / np.abs(x).max())).astype(np.int8).tobytes())
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], [*b.schema.names, "q"])


def _pairs(nodes: dict, lo: int, hi: int, k: int | None):
    """Pairs inside rows lo..hi: (a, b, d) that beat the ``worst`` entry of a's list."""
    ids, q, r, worst, new = (nodes[c][lo:hi] for c in ("x", "q", "r", "worst", "new"))
    x = q.astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    d = _angle(x @ x.T) - r[:, None] - r[None, :]
    if k is not None:  # a leaf: the k nearest of each
        np.fill_diagonal(d, np.inf)
        k = min(k, len(ids) - 1)
        if k <= 0:
            return None
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        return np.repeat(ids, k), ids[near].ravel(), np.take_along_axis(d, near, 1).ravel()
    ok = (d < worst[:, None]) & (new[:, None] | new[None, :]) & (ids[:, None] != ids[None, :])
    i, j = np.nonzero(ok)
    return (ids[i], ids[j], d[i, j]) if len(i) else None


def _joined(keys: list[str], k: int | None):
    """Groups of a sorted partition -> (u, v, d)."""
    def run(batches):
        rest = None
        for b in _with_end(batches):
            t = b if rest is None else (rest if b is None else pa.Table.from_batches([*rest.to_batches(), *b.to_batches()]))
            if t is None or not t.num_rows:
                continue
            cols = [t.column(c).to_numpy() for c in keys]
            cut = cut_points(*cols)
            last = len(cut) - 1 if b is None else len(cut) - 2
            rest = t.slice(cut[last])
            if not last:
                continue
            t = t.slice(0, cut[last])
            nodes = {c: t.column(c).to_numpy() for c in ("x", "r", "worst", "new")}
            q = t.column("q").combine_chunks()
            widths = np.diff(np.frombuffer(q.buffers()[1], dtype=np.int32)[q.offset:q.offset + len(q) + 1])
            if (widths == widths[0]).all():
                start = np.frombuffer(q.buffers()[1], dtype=np.int32)[q.offset]
                nodes["q"] = np.frombuffer(q.buffers()[2], dtype=np.int8)[start:start + widths.sum()].reshape(len(q), -1)
                spans = [(lo, hi, nodes) for lo, hi in zip(cut[:last], cut[1:last + 1])]
            else:  # vectors of several lengths: groups are cut by length
                spans = []
                raw = q.to_pylist()
                for lo, hi in zip(cut[:last], cut[1:last + 1]):
                    for w in np.unique(widths[lo:hi]):
                        rows = lo + np.flatnonzero(widths[lo:hi] == w)
                        some = {c: nodes[c][rows] for c in ("x", "r", "worst", "new")}
                        some["q"] = np.frombuffer(b"".join(raw[i] for i in rows), dtype=np.int8).reshape(len(rows), -1)
                        spans.append((0, len(rows), some))
            found = [p for lo, hi, some in spans if hi - lo > 1 and (p := _pairs(some, lo, hi, k)) is not None]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[i] for f in found])).cast(kind) for i, kind in
                                                  enumerate((pa.int64(), pa.int64(), pa.float32()))], ["u", "v", "d"])
    return run


def _with_end(batches):
    for b in batches:
        if b.num_rows:
            yield pa.Table.from_batches([b])
    yield None


def _best(cand: DataFrame, limits: DataFrame | None, k: int) -> DataFrame:
    """The nearest entries of each list: (u, v, d, new)."""
    cand = cand.groupBy("u", "v").agg(F.min("d").alias("d"), F.min("new").alias("new"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy("d", "v"))
    if limits is None:
        return cand.withColumn("at", rank).filter(F.col("at") <= k).drop("at")
    return (cand.join(limits, "u", "left").withColumn("at", rank)
            .filter(F.col("at") <= F.coalesce("k", F.lit(k))).select("u", "v", "d", "new"))


def _leaves(nodes: DataFrame, scratch: Scratch, n: int, k: int, first: int, trees: int) -> DataFrame:
    """Exact neighbours inside leaves of about LEAF balls, cut further if larger, of the random projections ``first`` ..."""
    bits = int(np.clip(np.ceil(np.log2(max(1.0, n / LEAF))), 0, 30))
    at = np.arange(trees, dtype=np.int64) << 32  # each projection has leaves of its own

    def run(batches):
        weights = 1 << np.arange(bits)
        for b in batches:
            keys = []
            for x in (np.frombuffer(q, dtype=np.int8).astype(np.float32) for q in b.column("q").to_pylist()):
                signs = np.array([(x @ _planes(len(x), bits, 100 + first + t)) > 0 for t in range(trees)]).reshape(trees, bits)
                keys.append(at + signs @ weights if bits else at)
            if keys:
                yield pa.RecordBatch.from_arrays([b.column("x").take(pa.array(np.repeat(np.arange(b.num_rows), trees))),
                                                  pa.array(np.concatenate(keys), pa.int64())], ["x", "leaf"])
    keyed = scratch.save(nodes.select("x", "q").mapInArrow(run, "x long, leaf long"))
    sizes = scratch.save(keyed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / (2 * LEAF)).cast("long").alias("parts")))
    placed = keyed.join(sizes, "leaf").withColumn("part", F.pmod(F.xxhash64("x", "leaf", F.lit(first)), F.col("parts"))).drop("parts")
    full = placed.join(nodes, "x").select("leaf", "part", "x", "q", "r", F.lit(float("inf")).cast("float").alias("worst"), F.lit(True).alias("new"))
    return (full.repartition("leaf", "part").sortWithinPartitions("leaf", "part")
            .mapInArrow(_joined(["leaf", "part"], k), "u long, v long, d float").withColumn("new", F.lit(True)))


def _seeded(nodes: DataFrame, scratch: Scratch, n: int, k: int, lists: DataFrame | None, first: int, trees: int) -> DataFrame:
    """``lists`` with the neighbours in the leaves of ``trees`` more projections, ``TREES`` at a time."""
    if n <= LEAF:
        trees = 1  # one leaf holds all
    lists = None if lists is None else lists.withColumn("new", F.lit(True))
    for t in range(0, trees, TREES):
        extra = _leaves(nodes, scratch, n, k, first + t, min(TREES, trees - t))
        old, lists = lists, scratch.save(_best(extra if lists is None else extra.unionByName(lists), None, k))
        if t:
            scratch.drop(old)
    return lists


def _strays(nodes: DataFrame, n: int, first: int) -> DataFrame:
    """(w, x, new): some random balls for each ball."""
    ring = F.floor(F.pmod(F.xxhash64("x", F.lit(first)), F.lit(1 << 40)) / max(1, (1 << 40) * STRAYS // max(1, n)))
    dealt = nodes.select("x", ring.alias("ring"))
    return (dealt.select("ring", F.col("x").alias("w")).join(dealt, "ring").filter("w <> x")
            .select("w", "x", F.lit(True).alias("new")))


def descend(nodes: DataFrame, scratch: Scratch, n: int, theta: float, k: int, lists: DataFrame | None = None,
            first: int = 0, trees: int = TREES) -> DataFrame:
    """Neighbour lists (u, v, d, new) of the balls ``nodes`` (x, q, r)."""
    lists = _seeded(nodes, scratch, n, k, lists, first, trees)
    limits = None
    for step in range(MAX_STEPS):
        own = lists.groupBy("u").agg(F.count(F.lit(1)).alias("have"), F.max("d").alias("far"))
        own = own if limits is None else own.join(limits, "u", "left")
        room = F.coalesce("k", F.lit(k)) if limits is not None else F.lit(k)
        full = F.col("have") >= room
        wider = full & (F.col("far") <= theta + _SLACK)  # saturated: every entry is a link
        state = scratch.save(own.select("u", F.when(wider, 2 * room).otherwise(room).cast("int").alias("k"),
                                        F.when(full & ~wider, F.col("far")).otherwise(F.lit(float("inf"))).cast("float").alias("worst")))
        limits = state.select("u", "k")
        both = lists.select(F.col("u").alias("w"), F.col("v").alias("x"), "new").unionByName(
            lists.select(F.col("v").alias("w"), F.col("u").alias("x"), "new"))
        if not step and n > LEAF:
            both = both.unionByName(_strays(nodes, n, first))
        both = scratch.save(both.groupBy("w", "x").agg(F.max("new").alias("new")))
        parts = scratch.save(both.groupBy("w").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("long").alias("parts"), F.max("new").alias("any"))
                             .filter("any").drop("any"))
        dealt = both.join(parts, "w").withColumn("part", F.pmod(F.xxhash64("x", F.lit(step)), F.col("parts"))).drop("parts")
        about = scratch.save(nodes.join(state.select(F.col("u").alias("x"), "worst"), "x", "left")
                             .select("x", "q", "r", F.coalesce("worst", F.lit(float("inf")).cast("float")).alias("worst")))
        rows = scratch.save(dealt).join(about, "x").select("w", "part", "x", "q", "r", "worst", "new")
        found = rows.repartition("w", "part").sortWithinPartitions("w", "part").mapInArrow(
            _joined(["w", "part"], None), "u long, v long, d float")
        changed = Observation()
        merged = _best(lists.withColumn("new", F.lit(False)).unionByName(found.withColumn("new", F.lit(True))), limits, k)
        old, lists = lists, scratch.save(merged.observe(changed, F.sum(F.col("new").cast("long")).alias("n")))
        scratch.drop(old, both, about)
        if (changed.get["n"] or 0) <= SETTLED * n * k:
            break
    return lists


def _chunk_counts(cosine: float):
    def run(batches):
        for b in batches:
            for one, two in zip(*(b.column(c).to_pylist() for c in ("one", "two"))):
                v, w = (np.frombuffer(b"".join(x["v"] for x in side)).reshape(len(side), -1) for side in (one, two))
                hit = v @ w.T >= cosine
                ids = [x["id"] for x in (*one, *two)]
                counts = np.concatenate([hit.sum(1), hit.sum(0)])
                some = np.flatnonzero(counts)
                if len(some):
                    low = [one[0]["ball"], two[0]["ball"]]
                    yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in some], pa.int64()), pa.array(counts[some], pa.int64()),
                                                      pa.array([low[0]] * len(some), pa.int64()), pa.array([low[1]] * len(some), pa.int64())],
                                                     ["vec_id", "n", "a", "b"])
    return run


def _links(members: DataFrame, balls: DataFrame, lists: DataFrame, scratch: Scratch, theta: float, cosine: float):
    """(vec_id, n) link counts outside the own ball, in parts; and links between balls."""
    pairs = (lists.filter(F.col("d") <= theta + _SLACK).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct())
    side = lambda s: balls.select(F.col("ball").alias(s), F.col("v").alias(f"v{s}"), F.col("r").alias(f"r{s}"), F.col("size").alias(f"n{s}"))
    pairs = scratch.save(pairs).join(side("a"), "a").join(side("b"), "b")

    def measure(batches):
        for b in batches:
            phi = np.array([_angle(np.frombuffer(x) @ np.frombuffer(y)) if len(x) == len(y) else np.inf for x, y in
                            zip(b.column("va").to_pylist(), b.column("vb").to_pylist())], dtype=np.float64)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("a", "b", "ra", "rb", "na", "nb")), pa.array(phi)],
                                             ["a", "b", "ra", "rb", "na", "nb", "phi"])
    eps = 1e-9
    pairs = scratch.save(pairs.mapInArrow(measure, "a long, b long, ra double, rb double, na long, nb long, phi double")
                         .filter(F.col("phi") - F.col("ra") - F.col("rb") <= theta + eps))
    single = (F.col("na") == 1) & (F.col("nb") == 1)
    sure = F.when(single, F.col("phi") <= theta + 1e-12).otherwise(F.col("phi") + F.col("ra") + F.col("rb") <= theta - eps)
    whole = scratch.save(pairs.filter(sure))
    open_ = scratch.save(pairs.filter(~sure & ~single).select("a", "b"))
    per_ball = whole.select(F.col("a").alias("ball"), F.col("nb").alias("n")).unionByName(
        whole.select(F.col("b").alias("ball"), F.col("na").alias("n"))).groupBy("ball").agg(F.sum("n").alias("n"))
    sides = open_.select(F.col("a").alias("ball")).unionByName(open_.select(F.col("b").alias("ball"))).distinct()
    own = members.join(scratch.save(sides), "ball").join(balls.select("ball", "size"), "ball")
    chunks = scratch.save(own.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("size") / CHUNK)))
                          .groupBy("ball", "part").agg(F.collect_list(F.struct(F.col("vec_id").alias("id"), "v", "ball")).alias("m")))
    tasks = (open_.join(chunks.select(F.col("ball").alias("a"), F.col("m").alias("one")), "a")
             .join(chunks.select(F.col("ball").alias("b"), F.col("m").alias("two")), "b").select("one", "two"))
    counted = scratch.save(tasks.mapInArrow(_chunk_counts(cosine), "vec_id long, n long, a long, b long"))
    edges = whole.select("a", "b").unionByName(counted.select("a", "b").distinct())
    return scratch.save(per_ball), counted.groupBy("vec_id").agg(F.sum("n").alias("n")), edges


def _outside(members: DataFrame, sizes: DataFrame, n: int, cosine: float) -> list[tuple[int, int, int]]:
    """(vec_id, size of its ball, links outside it, by brute force) of ``AUDIT`` or a few more random
    vectors that have such links; of all that have, if there are fewer."""
    spark = members.sparkSession
    top = 1 << 40
    u = F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(top))
    widest = members.agg(F.max(F.octet_length("v"))).first()[0]
    if not widest:
        return []
    most = max(AUDIT, AUDIT_BYTES // widest)
    low, rows, out = 0, AUDIT, []
    while low < top and len(out) < AUDIT:
        high = min(top, low + max(1, top * rows // n))
        asked = members.filter((u >= low) & (u < high)).join(sizes, "ball").select("vec_id", "size", "v").collect()
        low, rows = high, min(most, 2 * rows)
        by_dim: dict[int, list] = {}
        for r in asked:
            by_dim.setdefault(len(r.v), []).append(r)
        sample = spark.sparkContext.broadcast({d: (np.array([r.vec_id for r in rs]), np.frombuffer(b"".join(r.v for r in rs)).reshape(len(rs), -1))
                                               for d, rs in by_dim.items()})

        def run(batches, sample=sample):
            hits = {d: np.zeros(len(ids), np.int64) for d, (ids, _) in sample.value.items()}
            for b in batches:
                vs = b.column("v").to_pylist()
                for d, (_, q) in sample.value.items():
                    x = [v for v in vs if len(v) == d]
                    for i in range(0, len(x), CHUNK):
                        some = x[i:i + CHUNK]
                        hits[d] += np.count_nonzero(q @ np.frombuffer(b"".join(some)).reshape(len(some), -1).T >= cosine, axis=1)
            for d, (ids, _) in sample.value.items():
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hits[d])], ["vec_id", "n"])
        true = dict(members.select("v").mapInArrow(run, "vec_id long, n long").groupBy("vec_id").agg(F.sum("n")).collect()) if asked else {}
        out += [(r.vec_id, r.size, true[r.vec_id] - r.size) for r in asked if true[r.vec_id] > r.size]
        sample.unpersist()
    return out


def _audit(truth: list[tuple[int, int, int]], found: DataFrame) -> float:
    """Mean share of its links outside its ball that each vector of ``truth`` got."""
    if not truth:
        return 1.0
    asked = found.sparkSession.createDataFrame(truth, "vec_id long, size long, truth long")
    share = F.least(F.col("n_links") - (F.col("size") - 1), F.col("truth")) / F.col("truth")
    return found.join(F.broadcast(asked), "vec_id").agg(F.avg(share)).first()[0]


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, neighbours: int = NEIGHBOURS, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector of ``vectors`` (vec_id, embedding)."""
    scratch = Scratch(vectors.sparkSession, "embeddings")
    theta = float(np.arccos(cosine))
    rows = scratch.save(unit_vectors(vectors))
    usable = rows.filter("v IS NOT NULL")
    members = _balls(usable, scratch, usable.count(), theta / 2 - 1e-6, rounds)
    # the centre is the member at angle 0 whose vec_id names the ball
    balls = scratch.save(members.groupBy("ball").agg(
        F.max("angle").alias("r"), F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("low"),
        F.max(F.when(F.col("vec_id") == F.col("ball"), F.col("v"))).alias("v")))
    n = balls.count()
    nodes = scratch.save(balls.select(F.col("ball").alias("x"), F.col("r").cast("float").alias("r"), "v")
                         .mapInArrow(_rounded, "x long, r float, v binary, q binary").drop("v"))
    truth = _outside(members, balls.select("ball", "size"), members.count(), cosine)
    lists, k, first = None, neighbours, 0
    for turn in range(MAX_TURNS):
        trees = TREES << turn
        lists = descend(nodes, scratch, n, theta, k, lists, first, trees)
        first += trees
        per_ball, per_vector, edges = _links(members, balls, lists, scratch, theta, cosine)
        linked = scratch.save(
            members.select("vec_id", "ball").join(balls.select("ball", "size", "low"), "ball")
            .join(per_ball, "ball", "left").withColumnRenamed("n", "outside").join(per_vector, "vec_id", "left")
            .select("vec_id", "low", (F.col("size") - 1 + F.coalesce("outside", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("n_links")))
        recall = _audit(truth, linked)
        if recall >= RECALL:
            break
        if turn < MAX_AUDITS - 1:
            k *= 2
    else:
        raise RuntimeError(f"recall of links is {recall:.4f} after {MAX_TURNS} turns, below {RECALL}")
    low = balls.select("ball", "low")
    edges = (edges.join(low.withColumnRenamed("ball", "a").withColumnRenamed("low", "la"), "a")
             .join(low.withColumnRenamed("ball", "b").withColumnRenamed("low", "lb"), "b"))
    joined = connected_components(edges.select(F.col("la").alias("a"), F.col("lb").alias("b")), scratch)
    done = linked.join(joined, F.col("low") == F.col("node"), "left").select(
        "vec_id", "n_links", F.coalesce("component", "low").alias("component_id"))
    alone = rows.filter("v IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    nameless = vectors.filter("vec_id IS NULL").select(F.col("vec_id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
                                                       F.col("vec_id").cast("long").alias("component_id"))
    return done.unionByName(alone).unionByName(nameless).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
