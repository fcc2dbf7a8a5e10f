import time
from itertools import combinations

import numpy as np
import pytest
import xxhash

from webloom.llm import decontaminate, simhash
from webloom.llm.common import Scratch
from webloom.llm.components import connected_components
from webloom.llm.queries import op2_simhash_near_dedup, op8_decontaminate

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    """fps: list of (doc_id, fp)."""
    comp = {d: d for d, _ in fps}
    changed = True
    near = [(a, b) for (a, x), (b, y) in combinations(fps, 2) if bin(x ^ y).count("1") <= 4]
    while changed:
        changed = False
        for a, b in near:
            m = min(comp[a], comp[b])
            if comp[a] != m or comp[b] != m:
                comp[a] = comp[b] = m
                changed = True
    return comp


@pytest.mark.parametrize("text", ["", None, " \t\n", "one", "a b c", "A b C d", "É é x  y\x0bz", "w " * 1000, "x y\r\nz q r s t u"])
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) == brute_fingerprint(text)


def test_fingerprint_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 37}" for i in range(700))
    monkeypatch.setattr(simhash, "_PIECE", 50)
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, brute_fingerprint(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    comp = brute_components(docs)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op2_simhash_near_dedup(spark, SF).collect()}
    assert got == {d: (f"{fp:016x}", comp[d]) for d, fp in docs}


@pytest.mark.parametrize("seed", [0, 1])
def test_links_are_exact(spark, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2 ** 63, 40, dtype=np.uint64)
    fps = {int(x) for x in base} | {0}
    for x in base:
        for d in range(1, 7):
            fps.add(int(x) ^ sum(1 << int(b) for b in rng.choice(64, d, replace=False)))
    if seed:  # correlated bits
        fps = {f | (0xFFFF if f & 1 else 0) for f in fps}
    fps = sorted(fps)
    d = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    got = {frozenset((r.x & (2 ** 64 - 1), r.y & (2 ** 64 - 1))) for r in simhash.links(d).collect()}
    assert got == {frozenset(p) for p in combinations(fps, 2) if bin(p[0] ^ p[1]).count("1") <= 4}


def test_allocation_is_optimal():
    rng = np.random.default_rng(3)
    for _ in range(20):
        cost = [[0.0, *np.cumsum(rng.random(5))] for _ in range(3)]
        best = min(sum(c[t] for c, t in zip(cost, ts)) for ts in
                   ((a, b, 5 - a - b) for a in range(6) for b in range(6 - a)))
        value, ts = simhash.allocate(cost, 5)
        assert value == pytest.approx(best) and sum(t + 1 for t in ts) == 5


def test_simhash_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " "), (4, "a"), (4, "a"), (5, "A"), (None, "a"), (7, "x " * 50_000)]
    d = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, fp string")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(d).collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (5, 4), (None, None), (7, 7)], key=str)
    kept = simhash.keep_one(d)
    assert kept.columns == d.columns and sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 4, 7, None], key=str)
    assert simhash.near_duplicates(d.limit(0)).count() == 0 and simhash.keep_one(d.limit(0)).count() == 0


def test_repeated_ids_lose_no_text(spark):
    far, near = "q " * 30 + "some words of a text", "other things altogether in this one here " * 3
    rows = [(1, far, "x", 1), (1, near, "y", 2), (1, near, "y", 3), (2, near, "z", 4), (3, far, "w", 5), (4, None, "v", 6), (4, None, "v", 6), (5, "alone", "u", 7)]
    d = spark.createDataFrame(rows, "doc_id int, text string, _sim_id string, _sim int").repartition(3)
    for parts in (1, 4):  # the same rows whatever the order they are read in
        kept = simhash.keep_one(d.repartition(parts))
        assert kept.schema == d.schema
        got = sorted(map(tuple, kept.collect()), key=str)
        assert [(r[0], r[1]) for r in got] == [(1, near), (1, far), (4, None), (5, "alone")] and got[0][3] in (2, 3)
        assert parts == 1 or got == first
        first = got
    found = {(r.doc_id, r.fp): r.component_id for r in simhash.near_duplicates(d).collect()}
    assert sorted(found.values()) == [1, 1, 1, 1, 4, 5]


def test_components(spark):
    rng = np.random.default_rng(5)
    pairs = [(i, i + 1) for i in range(0, 400)] + [(1000, 1000 + i) for i in range(1, 300)] + [(int(a), int(b)) for a, b in
             rng.integers(2000, 2300, (150, 2))] + [(5, 5), (-3, 7)]
    want = {x: x for p in pairs for x in p}
    for _ in range(500):
        for a, b in pairs:
            want[a] = want[b] = min(want[a], want[b])
    d = spark.createDataFrame(pairs, "a long, b long").repartition(5)
    got = dict(connected_components(d, Scratch(spark, "t")).collect())
    assert {x: got.get(x, x) for x in want} == want
    assert connected_components(d.limit(0), Scratch(spark, "t")).count() == 0


def test_masks_hit_every_stretch_with_two_substitutions():
    for miss in combinations(range(decontaminate.MIN_WORDS), 2):
        assert any(all(o + p not in miss for p in m) for m in decontaminate.MASKS
                   for o in range(decontaminate.MIN_WORDS - m[-1]))


def test_short_masks_hit_every_stretch_that_counts():
    for length in range(4, decontaminate.SHORT_ITEM):
        for miss in combinations(range(length), length // 5):
            assert any(all(o + p not in miss for p in m) for m in decontaminate.SHORT_MASKS for o in range(length - m[-1]))


@pytest.mark.parametrize("n", range(1, 18))
def test_short_items_against_brute_force(n):
    rng = np.random.default_rng(n)
    item = [f"w{i}" for i in range(n)]
    block = decontaminate.Block([(0, " ".join(item).encode())])
    for miss in [m for k in range(4) for m in combinations(range(n), k)][:300]:
        doc = ["x"] * int(rng.integers(0, 3)) + ["y" if i in miss else w for i, w in enumerate(item)][int(rng.integers(0, 2)):] + ["z"] * int(rng.integers(0, 2))
        got = block.matches(decontaminate.words_of(" ".join(doc).encode()), 13, 0.8)
        assert bool(got) == (bool(brute_best(doc, item)) if n >= 5 else doc == item), (doc, got)


def test_repetitive_text_is_not_quadratic():
    block = decontaminate.Block([(0, b"la " * 400), (1, b"la " * 200 + b"li " * 200)])
    start = time.time()
    words = decontaminate.words_of(b"la " * 100_000)
    assert block.matches(words, 13, 0.8) == [(0, 400, 400, 0), (1, 200, 250, 99_750)] or block.matches(words, 13, 0.8)[1][1:3] == (200, 250)
    assert time.time() - start < 10


def tokens(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalnum():
            if word:
                out.append(word)
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return out


def brute_best(doc, item):
    """Longest aligned stretch with four fifths of its words equal, if it counts."""
    best = 0
    for shift in range(-len(item) + 1, len(doc)):
        same = [doc[i] == item[i - shift] for i in range(max(0, shift), min(len(doc), shift + len(item)))]
        if sum(same) <= 0.5 * min(13, len(item)):
            continue
        for i in range(len(same)):
            for j in range(i + best + 1, len(same) + 1):
                if 5 * sum(same[i:j]) >= 4 * (j - i):
                    best = j - i
    return best if best >= min(13, 0.8 * len(item)) else 0


def test_decontamination_against_brute_force(spark):
    docs = {r.doc_id: tokens(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: tokens(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r.length for r in op8_decontaminate(spark, SF).collect()}
    assert got
    words = {i: set(w) for i, w in items.items()}
    for d, dw in docs.items():
        if len(dw) > 700:
            continue
        for i, iw in items.items():
            if len(words[i] & set(dw)) < 0.5 * len(words[i]) and (d, i) not in got:
                continue
            assert bool(brute_best(dw, iw)) == ((d, i) in got), (d, i)


def test_decontamination_cases(spark):
    item = " ".join(f"w{i}" for i in range(20))
    changed = " ".join("X" if i in (3, 9, 15) else f"w{i}" for i in range(20))
    bench = spark.createDataFrame([(1, item, 0), (2, "alpha beta gamma delta epsilon", 0), (3, "of", 0), (4, None, 0), (5, "", 0)],
                                  "item_id long, text string, doc_id int")
    rows = [(1, f"intro {item.upper()}, end"), (2, changed), (3, " ".join(f"w{i}" for i in range(12))), (4, "of of of"),
            (5, "x alpha BETA, gamma (delta) epsilon y"), (6, None), (7, ""), (1, f"intro {item.upper()}, end"),
            (8, " ".join(f"w{i}" for i in range(0, 20, 2))), (9, "z " * 30_000 + item), (None, item)]
    d = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, item_id string")
    got = sorted(((r.doc_id, r.item_id) for r in decontaminate.contaminated(d, bench).collect()), key=str)
    assert got == sorted([(1, 1), (1, 1), (2, 1), (5, 2), (9, 1), (None, 1)], key=str)
    one = sorted(((r.doc_id, r.item_id) for r in decontaminate.contaminated(d, bench, block_words=6).collect()), key=str)
    assert one == got
    clean = decontaminate.remove_contaminated(d, bench)
    assert clean.schema == d.schema and sorted(r.doc_id for r in clean.collect()) == [3, 4, 6, 7, 8]
    assert decontaminate.contaminated(d.limit(0), bench).count() == 0
    assert decontaminate.remove_contaminated(d, bench.limit(0)).count() == len(rows)
