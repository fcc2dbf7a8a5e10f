import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from webloom.llm import collocations as C

SCHEMA = "doc_id long, lang string, text string, phrase string, rank int"


def brute(rows, max_words, min_count, top):
    f, n = defaultdict(Counter), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for _, lang, text, *_ in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    f[lang or "und"][tuple(w[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        gone = {p[i:j] for p, a in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                if j - i < len(p) and counts[p[i:j]] <= a}
        scored = []
        for p, a in cand.items():
            if p not in gone:
                s, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def docs(seed, n=60, longest=60):
    rng = random.Random(seed)
    words = ["The", "the", "of", "a", "Éa", "x\x1cy", "b", "c|", "dd", "\x00", "ÉA"] + [f"w{i}" for i in range(30)]
    passage = "of the many things in a long passage"
    rows = [(i, rng.choice(["en", "de", None]), "".join(
        rng.choice([w, w, passage]) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b"])
        for w in rng.choices(words, weights=[9] * 11 + [1] * 30, k=rng.randrange(longest))), "mine", 7) for i in range(n)]
    return rows + [(900, "en", None, None, None), (901, None, "", None, None), (None, "und", "a b. " * 40, "x", 1), (5, "en", "a a a a a a a a a", "x", 1),
                   (5, "en", "a a a a a a a a a", "x", 1)]


@pytest.mark.parametrize("how", [{}, {"budget": 3}, {"budget": 40, "dict_words": 4}, {"dict_words": 0}])
def test_equals_brute_force(spark, how):
    rows = docs(len(how))
    got = C.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), 5, 6, 25, **how)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 6, 25)


def test_other_lengths_and_windows(spark, monkeypatch):
    rows = docs(9, 30, 300)
    monkeypatch.setattr(C, "WINDOW", 64)
    want = [w for t in rows for w in b" ".join(b" ".join(x) for x in C.words((t[2] or "").encode())).split()]
    monkeypatch.setattr(C, "WINDOW", 1 << 20)
    assert want == [w for t in rows for x in C.words((t[2] or "").encode()) for w in x]
    got = C.collocations(spark.createDataFrame(rows, SCHEMA), 3, 4, 5)
    assert sorted(map(tuple, got.collect())) == brute(rows, 3, 4, 5)


def test_hot_words_are_split_over_groups(spark):
    rows = [(i, "en", f"the w{i % 50} the x{i % 9} the the", None, None) for i in range(400)]
    got = C.collocations(spark.createDataFrame(rows, SCHEMA), 4, 3, 9, budget=30)
    assert sorted(map(tuple, got.collect())) == brute(rows, 4, 3, 9)
    groups = np.zeros(2, dtype=np.int64)
    prefixes = C.Prefixes(groups, (1, 0), 1)
    prefixes.add_level(np.array([0]), np.array([1]), np.array([1600]), 30)
    ids = np.array([0, *np.tile([1, 2, 1, 3, 1, 4, 1, 5], 20)], dtype=np.int32)
    at, group = prefixes.place(ids, 4)
    assert len(set(group[ids[at] == 1])) > 2 and max(group) < prefixes.groups == len(prefixes.depth)


def test_large_products_stay_exact(spark):
    df = spark.sql("SELECT (CAST(1000 AS DECIMAL(4,0)) * (CAST(a AS DECIMAL(17,0)) * CAST(n AS DECIMAL(17,0)))) DIV (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0))) s "
                   "FROM VALUES (90000000000001, 90000000000000007, 900000000000003, 9000000000001) AS t(a, n, l, r)")
    assert df.first()[0] == 1000 * 90000000000001 * 90000000000000007 // (900000000000003 * 9000000000001)


def test_empty_and_rare(spark):
    assert C.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert C.collocations(spark.createDataFrame([(1, "en", "a b", None, None), (2, None, None, None, None)], SCHEMA)).collect() == []
