import random

import numpy as np
import pytest

from webloom.operators import alignment as A
from webloom.operators import hits as H


def smith_waterman(q, d):
    """Best local score with affine gaps, cell by cell."""
    low = -10 ** 9
    h = [[0] * (len(d) + 1) for _ in range(len(q) + 1)]
    e, f = ([[low] * (len(d) + 1) for _ in range(len(q) + 1)] for _ in range(2))
    for i in range(1, len(q) + 1):
        for j in range(1, len(d) + 1):
            e[i][j] = max(h[i][j - 1] - 5, e[i][j - 1]) - 2
            f[i][j] = max(h[i - 1][j] - 5, f[i - 1][j]) - 2
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if q[i - 1] == d[j - 1] else -3), e[i][j], f[i][j])
    return max(map(max, h))


def edited(rng, words):
    out = []
    for w in words:
        x = rng.random()
        out += [] if x < 0.05 else [f"n{rng.randrange(99)}", w] if x < 0.1 else [f"s{rng.randrange(99)}"] if x < 0.18 else [w]
    return out


def check_row(r, q, d):
    """The reported columns describe an alignment of that score."""
    gapped = 2 * r.aln_length - (r.q_end - r.q_start + 1) - (r.s_end - r.s_start + 1)
    equal = r.aln_length - r.mismatches - gapped
    assert r.score == 2 * equal - 3 * r.mismatches - 5 * r.gap_opens - 2 * gapped
    assert r.pct_identity == pytest.approx(100 * equal / r.aln_length)
    assert smith_waterman(q[r.q_start - 1:r.q_end], d[r.s_start - 1:r.s_end]) == r.score
    assert q[r.q_start - 1] == d[r.s_start - 1] and q[r.q_end - 1] == d[r.s_end - 1]


def test_align_by_hand():
    f = lambda q, d: A.align(*(np.array([ord(c) for c in x]) for x in (q, d)), -len(q), len(d))
    assert f("abcdef", "xxabcdefyy") == (12, 6, 0, 0, 0, 6, 2, 8)
    assert f("abcdeXfghij", "abcdeYfghij") == (17, 11, 1, 0, 0, 11, 0, 11)
    assert f("abcdefghijkl", "abcdefZZghijkl") == (24 - 9, 14, 0, 1, 0, 12, 0, 14)
    assert f("abcdefQghijkl", "abcdefghijkl") == (24 - 7, 13, 0, 1, 0, 13, 0, 12)
    assert f("abc", "xyz")[:2] == (0, 0)


@pytest.mark.parametrize("seed", range(30))
def test_align_equals_full_dynamic_programming(seed):
    rng = random.Random(seed)
    q = [rng.randrange(4 + seed) for _ in range(rng.randrange(1, 40))]
    d = [rng.randrange(4 + seed) for _ in range(rng.randrange(1, 90))]
    if seed % 2:
        d[5:5] = [x for x in q if rng.random() > 0.1]
    got = A.align(np.array(q), np.array(d), -len(q), len(d))
    assert got[0] == smith_waterman(q, d)


@pytest.mark.parametrize("band", [4096, 40])
def test_hits_equal_full_dynamic_programming(spark, monkeypatch, band):
    monkeypatch.setattr(A, "BAND", band)
    rng = random.Random(band)
    word = lambda: f"w{int(rng.paretovariate(0.6)) % 400}"
    queries = {i: [word() for _ in range(rng.choice([4, 12, 40, 90]))] for i in range(12)}
    docs = {}
    for i in range(60):
        body = [word() for _ in range(rng.randrange(5, 250))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(body))
            body[at:at] = edited(rng, queries[rng.randrange(12)])
        docs[i] = body
    docs[90], docs[91], docs[92] = ["la"] * 700 + queries[3], [], ["la"]
    queries[20], queries[21] = ["la"] * 30 + ["li"] * 9, []
    q = spark.createDataFrame([(i, " ".join(w)) for i, w in queries.items()] + [(99, None)], "item_id long, text string")
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()] + [(99, None)], "doc_id long, text string").repartition(3)
    hits = A.passage_hits(q, d)
    assert hits.columns[:12] == [c.split()[0] for c in H.HITS_SCHEMA.split(", ")]
    best: dict = {}
    for r in hits.collect():
        key = int(r.query_id), int(r.subject_id)
        check_row(r, queries[key[0]], docs[key[1]])
        best[key] = max(best.get(key, 0), r.score)
    for i, qw in queries.items():
        for j, dw in docs.items():
            seeds = {tuple(qw[x:x + 5]) for x in range(len(qw) - 4)} & {tuple(dw[x:x + 5]) for x in range(len(dw) - 4)}
            want = smith_waterman(qw, dw) if seeds else 0
            assert best.get((i, j), 0) == (want if want >= 20 else 0), (i, j)
    assert len(best) > 30


def test_best_hit_per_query_from_stored_hits(spark, scratch):
    from webloom.sources.text import read_hits
    q = spark.createDataFrame([(1, "a b c d e f g h i j k l m n")], "item_id long, text string")
    d = spark.createDataFrame([(1, "x a b c d e f g h i j k l m n y"), (2, "a b c d e X g h i j k l m n"), (3, "nothing")], "doc_id long, text string")
    A.passage_hits(q, d).select(*(c.split()[0] for c in H.HITS_SCHEMA.split(", "))).write.option("sep", "\t").csv(f"{scratch}/hits")
    best = H.hits_best(read_hits(spark, f"{scratch}/hits")).collect()
    assert [(r.query_id, r.best_subject, r.n_hits) for r in best] == [("1", "1", 2)]
    assert best[0].best_evalue == pytest.approx(14 * 31 * 2 ** -best[0].best_bit_score)
