import numpy as np
import pytest

from webloom.llm import multi_index as M

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def exact(rows, asked, k):
    ok = {}
    for i, v, *_ in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            ok[i] = min(ok.get(i, v), v)
    out = {}
    for q in asked:
        if q in ok:
            scored = []
            for i, v in ok.items():
                if i != q and len(v) == len(ok[q]):
                    s = 0.0
                    for a, b in zip(np.float32(ok[q]).astype(float), np.float32(v).astype(float)):
                        s += a * b
                    scored.append((-s, i))
            out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def table(rng, n, dim, spread=None):
    centres = rng.standard_normal((12, dim))
    x = centres[rng.integers(0, 12, n)] + 0.3 * rng.standard_normal((n, dim))
    return (x * (spread or rng.uniform(0.2, 3, (n, 1)))).astype(np.float32)


def answers(got):
    out = {}
    for r in got.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert all([x[0] for x in v] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [x[1:] for x in v] for q, v in out.items()}


@pytest.mark.parametrize("dim", [1, 2, 17])
def test_recall_and_exact_scores(spark, monkeypatch, dim):
    monkeypatch.setattr(M, "CELL", 16)
    rng = np.random.default_rng(dim)
    rows = [(i, v.tolist(), 0, None) for i, v in enumerate(table(rng, 3000, dim))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = answers(M.search(df, df.filter("vec_id % 20 = 0"), 10))
    want = exact(rows, range(0, 3000, 20), 10)
    assert set(got) == set(want)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.9
    score = {(q, i): s for q in want for i, s in exact(rows, [q], 3000)[q]} if dim == 17 else {}
    assert all(score[q, i] == s for q in got for i, s in got[q] if score)


def test_all_is_found_when_all_is_visited(spark, monkeypatch):
    monkeypatch.setattr(M, "RECALL", 1.0)
    monkeypatch.setattr(M, "CONFIRM", 1.0)
    monkeypatch.setattr(M, "CELL", 8)
    monkeypatch.setattr(M, "PART", 5)
    monkeypatch.setattr(M, "ASKED", 9)
    monkeypatch.setattr(M, "PACK", 3)
    rng = np.random.default_rng(5)
    x = table(rng, 400, 6).tolist()
    rows = [(i, v, 0, "x") for i, v in enumerate(x)]
    rows += [(i, x[3], 1, "x") for i in range(1000, 1200)]                  # a third of the rows share a vector
    rows += [(2000, None, 0, ""), (2020, [], 0, ""), (2040, [0.0] * 6, 0, ""), (2060, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0, ""),
             (2080, [float("nan")] * 6, 0, ""), (2100, [float("inf")] * 6, 0, ""), (None, x[5], 0, ""), (2120, [1.0, 2.0], 0, ""),
             (2140, [1.0, 3.0], 0, ""), (2160, [-0.0, 2.0], 0, ""), (2180, [0.0, 2.0], 0, ""), (40, x[3], 0, "again"), (2200, [1.0] * 9, 0, "")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    asked = [i for i, *_ in rows if i is not None and i % 20 == 0]
    got = answers(M.search(df, df.filter("vec_id % 20 = 0"), 7))
    want = {q: v for q, v in exact(rows, asked, 7).items() if v}
    assert got == want and 2120 in got and 2200 not in got and 2000 not in got


def test_heap_visits_cells_in_order():
    rng = np.random.default_rng(1)
    index = M.Codebooks(rng.standard_normal((5, 2)), rng.standard_normal((7, 3)), 1.0, "<f8", rng.integers(0, 4, 35))
    q = rng.standard_normal(4)
    d1, d2 = index.distances(q)
    sums = (d1[:, None] + d2).ravel()
    want = [c for c in np.argsort(sums) if index.sizes[c]]
    assert list(index.visited(q, 10 ** 9)) == want
    some = list(index.visited(q, 20))
    assert some == want[:len(some)] and index.sizes[some[:-1]].sum() < 20 <= index.sizes[some].sum()
    assert index.ahead(q, np.array(want)).tolist() == [index.sizes[want[:i]].sum() for i in range(len(want))]


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, [1.0, 2.0], 0, ""), (2, None, 0, "")], SCHEMA)
    assert M.search(none, none).collect() == [] and M.search(some, none).collect() == []
    assert M.search(some, some).collect() == []
