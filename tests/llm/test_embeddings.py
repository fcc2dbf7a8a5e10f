import numpy as np
import pytest

from webloom.llm import embeddings
from webloom.llm.common import Scratch
from webloom.llm.queries import op6_embedding_near_dedup


def brute(rows, cosine=0.9):
    """rows: vec_id -> vector or None."""
    ok = {i: np.array(v, dtype=np.float64) for i, v in rows.items()
          if v and None not in v and np.isfinite(v).all() and np.any(np.array(v))}
    ids = sorted(ok)
    comp = {i: i for i in rows}
    links = {i: 0 for i in rows}
    unit = np.array([ok[i] / np.linalg.norm(ok[i]) for i in ids])
    near = unit @ unit.T >= cosine if ids else np.zeros((0, 0), bool)
    np.fill_diagonal(near, False)
    for a, i in enumerate(ids):
        links[i] = int(near[a].sum())
    todo = True
    while todo:
        todo = False
        for a, i in enumerate(ids):
            m = min([comp[i], *(comp[ids[b]] for b in np.flatnonzero(near[a]))])
            if m != comp[i]:
                comp[i], todo = m, True
    return {i: (links[i], comp[i], i == comp[i]) for i in rows}


def result(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.vec_id: list(r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    assert result(op6_embedding_near_dedup(spark, sf)) == brute(rows)


def test_groups_chains_and_edge_cases(spark):
    rng = np.random.default_rng(4)
    rows, n = {}, 0

    def add(v):
        nonlocal n
        rows[n * 7 % 5003] = [float(x) for x in v]
        n += 1
    for _ in range(150):
        add(rng.standard_normal(16))
    centre = rng.standard_normal(16)
    for _ in range(300):  # a large tight group, some copies
        add(centre + 0.05 * rng.standard_normal(16))
    for _ in range(60):
        add(centre * rng.random())
    a, b = np.linalg.qr(rng.standard_normal((16, 2)))[0].T
    for t in np.arange(0, 3, 0.1):  # a chain, neighbours linked
        add(a * np.cos(t) + b * np.sin(t))
    wide = rng.standard_normal(16)
    for _ in range(120):  # a loose group: some pairs linked, some not
        add(wide + 0.35 * np.linalg.norm(wide) / 4 * rng.standard_normal(16))
    rows |= {9000: None, 9001: [], 9002: [0.0] * 16, 9003: [1.0, None] * 8, 9004: [float("nan")] * 16, 9005: [float("inf")] * 16,
             9006: [1e-200] * 16, 9007: [1e200] * 16}
    d = spark.createDataFrame([(i, v, 0) for i, v in rows.items()] + [(0, rows[0], 0)], "vec_id long, embedding array<double>, n_links int")
    got, want = result(embeddings.near_duplicates(d, rounds=2)), brute({i: v for i, v in rows.items() if i < 9006})
    have = sum(min(got[i][0], want[i][0]) for i in want)
    assert all(got[i][0] <= want[i][0] for i in want) and have >= 0.99 * sum(w[0] for w in want.values())
    assert np.mean([got[i][1:] == want[i][1:] for i in want]) >= 0.99
    assert got[9006][:2] == (1, 9006) and got[9007][:2] == (1, 9006) and len(got) == len(rows)
    assert embeddings.near_duplicates(d.limit(0), rounds=1).count() == 0


def test_null_id_and_lone_vector(spark):
    d = spark.createDataFrame([(None, [1.0, 0.0]), (4, [1.0, 0.0]), (5, [1.0, 0.0, 0.0])], "vec_id long, embedding array<float>")
    assert result(embeddings.near_duplicates(d, rounds=1)) == {None: (0, None, False), 4: (0, 4, True), 5: (0, 5, True)}


@pytest.mark.parametrize("k", [2, 5])
def test_leaf_pairs_are_the_nearest(k):
    rng = np.random.default_rng(k)
    q = rng.integers(-127, 128, (30, 8)).astype(np.int8)
    nodes = {"x": np.arange(30), "q": q, "r": np.zeros(30, np.float32), "worst": np.full(30, np.inf), "new": np.ones(30, bool)}
    u, v, d = embeddings._pairs(nodes, 0, 30, k)
    x = q / np.linalg.norm(q.astype(float), axis=1, keepdims=True)
    full = np.arccos(np.clip(x @ x.T, -1, 1))
    np.fill_diagonal(full, 9)
    for i in range(30):
        assert np.allclose(np.sort(d[u == i]), np.sort(full[i])[:k], atol=1e-3)


def planted(n, pairs, dim=64, seed=9):
    """Random unit vectors, the first 2 x ``pairs`` of them isolated pairs just inside the link angle."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal((pairs, dim))
    side -= (side * x[:pairs]).sum(1, keepdims=True) * x[:pairs]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    x[pairs:2 * pairs] = 0.92 * x[:pairs] + np.sqrt(1 - 0.92 ** 2) * side
    return x


def test_first_descent_crosses_leaves(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "LEAF", 32)  # 256 leaves
    n, pairs = 6000, 300
    x = planted(n, pairs)
    q = np.round(x * (127 / np.abs(x).max(1, keepdims=True))).astype(np.int8)
    nodes = spark.createDataFrame([(i, 0.0, bytearray(v.tobytes())) for i, v in enumerate(q)], "x long, r float, q binary")
    lists = embeddings.descend(nodes, Scratch(spark, "t"), n, float(np.arccos(0.9)), 10)
    near = {(r.u, r.v) for r in lists.filter("d < 0.5").collect()}
    met = np.mean([(i, i + pairs) in near or (i + pairs, i) in near for i in range(pairs)])
    assert met >= 0.9


def frame(spark, x):
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")


@pytest.mark.parametrize("pairs,hot", [(3, 0), (40, 1500)])
def test_audit_sees_links_of_few_vectors(spark, monkeypatch, pairs, hot):
    n = 3000
    x = planted(n, pairs)
    if hot:  # a tight group: its links are all inside a ball
        x[-hot:] = x[-1]
    seen = []

    def lossy(nodes, scratch, n, theta, k, lists=None, *more):
        """A descent that proposes none of the planted pairs, then all."""
        seen.append(k)
        rows = [(i, i + pairs, 0.0, True) for i in range(pairs)] if len(seen) > 1 else []
        return nodes.sparkSession.createDataFrame(rows, "u long, v long, d float, new boolean")
    monkeypatch.setattr(embeddings, "descend", lossy)
    got = result(embeddings.near_duplicates(frame(spark, x), rounds=1))
    assert len(seen) == 2 and all(got[i + pairs][:2] == (1, i) for i in range(pairs))


def test_recall_below_the_bound_is_an_error(spark, monkeypatch):
    none = lambda nodes, *more: nodes.sparkSession.createDataFrame([], "u long, v long, d float, new boolean")
    monkeypatch.setattr(embeddings, "descend", none)
    monkeypatch.setattr(embeddings, "MAX_TURNS", 2, raising=False)
    with pytest.raises(RuntimeError, match="recall"):
        embeddings.near_duplicates(frame(spark, planted(300, 30)), rounds=1)
