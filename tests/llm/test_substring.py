import hashlib
import random

import numpy as np
import pytest

from webloom.llm import substring
from webloom.llm.queries import op5_substring_dedup


def brute(rows, window=50):
    """rows: (doc_id, text) -> sorted (doc_id, n_words, n_removed, sha)."""
    first = {}
    texts = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in texts:
        if d is not None:
            for i in range(len(w) - window + 1):
                k = tuple(w[i:i + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i:i + window])] < d:
                gone[i:i + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((d, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()]
    got = op5_substring_dedup(spark, f"/root/testdata/{sf}")
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    want = brute(rows)
    assert sum(w[2] for w in want) > 0
    assert sorted(map(tuple, got.collect()), key=str) == want


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_random_pastes_against_brute_force(spark, seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3 if seed == 2 else 400)}"
    passages = [[word() for _ in range(rng.randrange(45, 130))] for _ in range(6)]
    rows = []
    for d in range(80):
        w = [word() for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            lo = rng.randrange(0, 30)
            w += p[lo:lo + rng.randrange(30, 130)] + [word() for _ in range(rng.randrange(0, 5))]
        rows.append((rng.randrange(0, 60), " ".join(w)))  # some doc_ids repeat
    rows += [(None, " ".join(passages[0])), (70, None), (71, ""), (3, " ".join(passages[1] * 3)), (90, "x " * 3000), (91, "x " * 300),
             rows[0], (95, "\n\t".join(passages[2]) + "\x0b")]
    d = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, a string").repartition(3)
    got = [tuple(r)[:4] for r in substring.find_repeats(d).collect()]
    assert sorted(got, key=str) == brute(rows)
    if not seed:
        assert substring.find_repeats(d.limit(0)).count() == 0


def test_spans_point_at_equal_words(spark):
    rng = np.random.default_rng(1)
    a = [f"a{x}" for x in rng.integers(0, 10 ** 6, 300)]
    b = [f"b{x}" for x in rng.integers(0, 10 ** 6, 200)]
    texts = {1: a, 2: b, 3: b[20:150] + a[10:200] + ["z"] * 10 + a[100:170]}
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in substring.find_repeats(d).collect()}
    assert not spans[1] and not spans[2]
    assert [(s.start, s.length, s.ref, s.ref_start) for s in spans[3]] == [(0, 130, 2, 20), (130, 190, 1, 10), (330, 70, 1, 100)]


def test_blocks_cover_every_window_once():
    w = np.random.default_rng(2).integers(0, 2 ** 63, 1000, dtype=np.uint64)
    a, c, s, n = substring.cut_blocks(w)
    assert (np.concatenate([np.arange(x, x + k) for x, k in zip(s, n)]) == np.arange(951)).all() and n.max() <= 31
    a2, c2, s2, n2 = substring.cut_blocks(w[37:900])
    inner = {(int(x), int(y)) for x, y in zip(a, c)}
    assert sum((int(x), int(y)) in inner for x, y in zip(a2, c2)) >= len(a2) - 2
