import numpy as np
import pytest

from webloom.operators import cluster as C
from webloom.operators import sampling as SM


def pts(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "id long, features array<double>")


def test_assign_ties_go_to_first_centroid(spark):
    cents = C.Centroids([0, 1], np.array([[0.0, 0.0], [2.0, 0.0]]), np.zeros(2, dtype=np.int64))
    got = {r.id: (r.cid, r.dist) for r in C.assign(pts(spark, [(1, [1, 0]), (2, [3, 0])]), cents).collect()}
    assert got == {1: (0, 1.0), 2: (1, 1.0)}


@pytest.mark.parametrize("k,scale", [(3, 1.0), (50, 1e8)])
def test_assignment_is_exact_at_any_size(spark, k, scale):
    """Coordinates near 1e8, where |x|^2 - 2xc + |c|^2 cancels, agree with brute force."""
    rng = np.random.default_rng(3)
    data = [(i, scale + rng.normal(size=4)) for i in range(500)]
    cents = C.Centroids(list(range(k)), scale + rng.normal(size=(k, 4)), np.zeros(k, dtype=np.int64))
    got = {r.id: (r.cid, r.dist) for r in C.assign(pts(spark, data), cents).collect()}
    for i, x in data:
        d = [float(sum((a - b) ** 2 for a, b in zip(x, c))) for c in cents.vectors]
        assert got[i][0] == int(np.argmin(d)) and got[i][1] == pytest.approx(min(d) ** 0.5, rel=1e-12)


def test_cluster_sums_and_error(spark):
    cents = C.Centroids([0, 1], np.array([[0.0, 0.0], [10.0, 10.0]]), np.zeros(2, dtype=np.int64))
    a = C.assign(pts(spark, [(1, [1, 0]), (2, [0, 1]), (3, [9, 10])]), cents)
    sums = {r.cid: (list(r.sum), r.n) for r in C.cluster_sums(a).collect()}
    assert sums == {0: ([1.0, 1.0], 2), 1: ([9.0, 10.0], 1)}
    assert C.clustering_error(a).first()[0] == pytest.approx(3.0)


def test_update_reset_and_cumulative():
    prev = C.Centroids([0, 1], np.array([[0.0], [5.0]]), np.array([4, 0]))
    sums = [{"cid": 0, "sum": [10.0], "n": 2}]
    r = C.update_centroids(prev, sums, "reset")
    assert r.vectors.tolist() == [[10.0 / 6], [5.0]] and r.counts.tolist() == [0, 0]
    c = C.update_centroids(prev, sums, "cumulative")
    assert c.counts.tolist() == [6, 0]
    d = C.update_centroids(prev, sums, "reset", drop_empty=True)
    assert d.cids == [0]


def test_sample_fixed_matches_brute_force(spark):
    df = spark.range(1000)
    got = sorted(r.id for r in SM.sample_fixed(df, 37, seed=5).collect())
    h = {r.id: r.h for r in df.select("id", SM.seeded_hash("id", 5).alias("h")).collect()}
    want = sorted(sorted(h, key=lambda i: (h[i], i))[:37])
    assert got == want
    assert SM.sample_fixed(df, 5000, seed=5).count() == 1000


def test_kmeans_minibatch_runs(spark):
    rng = np.random.default_rng(0)
    data = [(i, (rng.normal(size=3) + (10 if i % 2 else 0))) for i in range(200)]
    cents = C.kmeans_minibatch(pts(spark, data), k=2, batch=50, iterations=5, seed=1)
    assert cents.vectors.shape == (2, 3)
    lines = C.centroid_lines(cents.to_df(spark), digits=3).collect()
    assert all(r.line.endswith("\t") and r.line.count("\t") == 3 for r in lines)


def test_cut_off_does_not_depend_on_the_histogram(spark, monkeypatch):
    df = spark.range(5000)
    a = sorted(r.id for r in SM.sample_fixed(df, 321, seed=9).collect())
    monkeypatch.setattr(SM, "HIST_BUCKETS", 3)
    b = sorted(r.id for r in SM.sample_fixed(df, 321, seed=9).collect())
    assert a == b and len(a) == 321


def test_seeds_and_ids_draw_independently(spark):
    df = spark.range(20_000)
    h = df.select("id", *[SM.seeded_hash("id", s).alias(f"h{s}") for s in (1, 2)]).toPandas()
    assert h.h1.nunique() == h.h2.nunique() == 20_000 and abs(np.corrcoef(h.h1, h.h2)[0, 1]) < 0.03
    both = df.select((SM.seeded_hash("id", 1) == SM.seeded_hash(SM.F.col("id") + SM.F.lit(2 ** 31 - 1), 1)).cast("int").alias("e"))
    assert both.agg({"e": "sum"}).first()[0] == 0


def test_sample_cutoffs_equal_sample_fixed(spark):
    df = spark.range(3000)
    cuts = SM.sample_cutoffs(df, 77, [1, 2, 3])
    assert set(cuts) == {1, 2, 3}
    for sd in (1, 2, 3):
        a = sorted(r.id for r in df.filter(SM.in_sample(sd, cuts[sd])).collect())
        b = sorted(r.id for r in SM.sample_fixed(df, 77, sd).collect())
        assert a == b and len(a) == 77


def test_vectors_that_fit_no_centroid(spark):
    import numpy as np

    from webloom.operators import cluster as CL
    rows = [(1, [0.0, 1.0]), (2, None), (3, []), (4, [1.0]), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [9.0, 9.0]), (8, [1.0, 2.0, 3.0])]
    points = spark.createDataFrame(rows, "id long, features array<double>")
    cents = CL.Centroids([10, 20], np.array([[0.0, 0.0], [9.0, 8.0]]), np.zeros(2))
    got = CL.assign(points, cents)
    assert {r.id: (r.cid, r.dist) for r in got.collect()} == {1: (10, 1.0), 7: (20, 1.0), **{i: (None, None) for i in (2, 3, 4, 5, 6, 8)}}
    assert sorted((r.cid, list(r.sum), r.n) for r in CL.cluster_sums(got).collect()) == [(10, [0.0, 1.0], 1), (20, [9.0, 9.0], 1)]
    assert CL.clustering_error(got).first()[0] == 2.0


def _one_by_one(x, mat):
    total = sum((x[:, None, j] - mat[None, :, j]) ** 2 for j in range(mat.shape[1]))
    return total.argmin(axis=1), np.sqrt(total.min(axis=1))


@pytest.mark.parametrize("k,dims,scale,clusters,share", [
    (2000, 3, 0.0, 0, 0.2), (2000, 16, 0.0, 40, 0.1), (300, 2, 1e8, 0, 0.5), (200, 64, 0.0, 0, 1.2), (40, 1, 0.0, 0, 1.0)])
def test_pruned_assignment_is_brute_force(k, dims, scale, clusters, share):
    rng = np.random.default_rng(k + dims)
    middles = rng.normal(size=(clusters, dims)) * 10 if clusters else np.zeros((1, dims))
    draw = lambda n: scale + middles[rng.integers(0, len(middles), n)] + rng.normal(size=(n, dims))
    mat, x = draw(k), draw(3000)
    mat[k // 2] = mat[3]  # a tie: the first counts
    x[:50], x[50:60], x[60] = mat[rng.integers(0, k, 50)], mat[3], np.inf
    pick, dist, made = C.Groups(mat).nearest(x)
    with np.errstate(invalid="ignore"):
        want = _one_by_one(x, mat)
    assert (pick == want[0]).all() and np.array_equal(dist, want[1])
    assert made < share * len(x) * k


def test_equal_and_evenly_spaced_centroids():
    x = np.arange(200, dtype=float).reshape(-1, 1) / 4  # many points halfway between two centroids
    for mat in (np.arange(50, dtype=float).reshape(-1, 1), np.arange(50, dtype=float)[::-1].reshape(-1, 1).copy(), np.ones((40, 1))):
        pick, dist, _ = C.Groups(mat).nearest(x)
        assert (pick == _one_by_one(x, mat)[0]).all() and (dist == _one_by_one(x, mat)[1]).all()


def test_assign_counts_distances(spark):
    rng = np.random.default_rng(1)
    mat, x = rng.normal(size=(400, 2)), rng.normal(size=(2000, 2))
    made = spark.sparkContext.accumulator(0)
    some = pts(spark, enumerate(x)).unionByName(spark.createDataFrame([(9998, None), (9999, [1.0])], "id long, features array<double>"))
    got = {r.id: (r.cid, r.dist) for r in C.assign(some, C.Centroids(list(range(400)), mat, np.zeros(400, dtype=np.int64)), made=made).collect()}
    want = _one_by_one(x, mat)
    assert all(got[i] == (want[0][i], want[1][i]) for i in range(2000)) and got[9998] == got[9999] == (None, None)
    assert 2000 < made.value < 0.3 * 2000 * 400
