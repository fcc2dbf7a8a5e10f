import re

from webloom.operators import similarity as SIM

Q = [(1, "alpha beta gamma delta epsilon zeta eta theta"), (2, "one two three four five six"),
     (3, "short one")]
D = [(10, "x alpha beta gamma delta epsilon zeta eta theta y"), (11, "alpha beta gamma delta epsilon"),
     (12, "one two three four five six one two three four five six"), (13, "nothing at all here today ok")]


def brute(k, cont, min_shared):
    def sh(t):
        w = re.findall(r"\w+", t.lower())
        return {" ".join(w[i:i + k]) for i in range(len(w) - k + 1)}
    out = set()
    for qi, qt in Q:
        qs = sh(qt)
        for di, dt in D:
            s = len(qs & sh(dt))
            need = min(len(qs), max(min_shared, -(-len(qs) * cont // 1)))
            if qs and s >= need:
                out.add((qi, di, s, len(qs)))
    return out


def test_matches_brute_force(spark):
    q = spark.createDataFrame(Q, "item_id long, text string")
    d = spark.createDataFrame(D, "doc_id long, text string")
    for k, cont, ms in [(3, 0.5, 1), (2, 0.9, 2), (3, 0.1, 1)]:
        got = {tuple(r) for r in SIM.seed_similarity(q, d, k, cont, ms).collect()}
        assert got == brute(k, cont, ms), (k, cont, ms)


def test_short_passages_are_found(spark):
    q = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "alpha beta gamma delta epsilon zeta"), (3, "solo"), (4, ""), (5, None)], "item_id long, text string")
    d = spark.createDataFrame([(1, "x alpha beta gamma delta epsilon zeta y"), (2, "a solo b"), (3, "gamma delta alpha beta"), (4, None)], "doc_id long, text string")
    got = sorted((r.item_id, r.doc_id, r.shared) for r in SIM.seed_similarity(q, d).collect())
    assert got == [(1, 1, 1), (2, 1, 2), (3, 2, 1)]
