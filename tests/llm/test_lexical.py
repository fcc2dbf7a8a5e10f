import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from webloom.llm import lexical as L

DOCS, ITEMS = "doc_id long, text string, item_id string, score int", "item_id long, text string, rank string"


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(str.maketrans(
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def brute(docs, items, k):
    found = [(d[0], terms(d[1])) for d in docs]
    found = [(i, t) for i, t in found if t]
    n_docs, n_terms = len(found), sum(len(t) for _, t in found)
    df = Counter(x for _, t in found for x in set(t))
    texts = {}
    for i, text, *_ in items:
        texts[i] = min((x for x in (texts.get(i), text) if x is not None), default=None)
    out = []
    for item, text in texts.items():
        rows = []
        for doc, t in found:
            tf, m = Counter(t), 25 + 75 * len(t) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10 ** 9 * tf[x] // (1000 * tf[x] + 8 * m))
                    for x in terms(text) if x in tf)
            if s > 0:
                rows.append((-s, doc is None, doc))
        out += [(item, r + 1, doc, -s) for r, (s, _, doc) in enumerate(sorted(rows, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["Common", "common", "the", "Éa", "1.5", "x_y", "日本", "ß"] + [f"w{i}" for i in range(150)]
    text = lambda m: "".join(w + rng.choice(" \n,;-\x7f") for w in rng.choices(words, [30] * 8 + [1] * 150, k=m))
    docs = [(i, text(rng.randrange(80)), "mine", 3) for i in range(n)]
    docs += [(10_000 + i, docs[1][1], "copy", 1) for i in range(n // 2)]        # a third of the rows are one text
    docs += [(20_000, None, "", 0), (20_001, " .\x00", "", 0), (None, text(30), "", 0), (7, docs[7][1], "again", 0), (20_002, text(3000), "", 0)]
    items = [(i, text(12), "mine") for i in range(30)]
    items += [(90, None, ""), (91, "", ""), (92, "zzz unseen", ""), (None, "common w3", ""), (5, "w1 w1 w2", "again"), (93, docs[1][1], ""), (94, "common " * 40, "")]
    return docs, items


@pytest.mark.parametrize("n, k, item_bytes", [(60, 10, 1 << 24), (500, 3, 400), (9, 50, 1 << 24)])
def test_equals_brute_force(spark, monkeypatch, n, k, item_bytes):
    monkeypatch.setattr(L, "SEED_DOCS", 100)
    monkeypatch.setattr(L, "BATCH_DOCS", 200)
    docs, items = corpus(n, n)
    got = L.rank_documents(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), k, item_bytes)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, k)


def trees(rng, n_docs, n_items, n_terms=400):
    weight = rng.integers(1, 9000, n_terms)
    topic = lambda i, n: np.unique(np.append(rng.integers(0, 20, 4), 20 + 38 * (i % 10) + rng.integers(0, 38, n)))
    ids = [topic(rng.integers(0, 10), 25) for _ in range(n_docs)]
    flat = np.concatenate(ids)
    impacts = rng.integers(1, 10 ** 6, len(flat))
    items = []
    for i in range(n_items):
        at = topic(i, 9)
        items.append((at, weight[at] * rng.integers(1, 3, len(at))))
    dense = np.zeros((n_docs, n_terms), dtype=np.int64)
    dense[np.repeat(np.arange(n_docs), [len(x) for x in ids]), flat] = impacts
    tree = L.ItemTree(items)
    return L.DocTree(np.arange(n_docs), np.cumsum([len(x) for x in ids]), flat, impacts, tree.profile(n_terms)), tree, items, dense


@pytest.mark.parametrize("seed", range(4))
def test_traversal_is_exact_and_prunes(seed):
    rng = np.random.default_rng(seed)
    docs, tree, items, dense = trees(rng, 1500 + seed, 21)
    for level in range(1, len(docs.levels)):
        for node in range(len(docs.levels[level])):
            assert (docs.levels[level][node] == docs.levels[level - 1][docs.children(level, np.array([node]))].max(axis=0)).all()
    best = L.Best(len(items), 5, np.zeros(len(items), dtype=np.int64))
    L.traverse(tree, docs, best)
    for at, i in enumerate(tree.order):
        scores = sum(dense[:, t] * q for t, q in zip(*items[i]))
        order = np.lexsort((np.arange(len(scores)), -scores))[:5]
        assert best.ids[at].tolist() == order.tolist() and best.scores[at].tolist() == scores[order].tolist()
    # with the kth scores known, what is left to score is a part of all pairs
    again = L.Best(len(items), 5, best.scores[:, -1])
    assert L.traverse(tree, docs, again) < 0.3 * len(items) * 1500
    assert (again.ids == best.ids).all()
    # and a batch that cannot win is left out at its root
    assert L.traverse(tree, docs, L.Best(len(items), 5, np.full(len(items), 10 ** 15))) == 0


def test_sums_beyond_doubles_stay_exact():
    rng = np.random.default_rng(8)
    docs, _, items, dense = trees(rng, 90, 9)
    items = [(at, q * 10 ** 6 + 1) for at, q in items]
    tree = L.ItemTree(items)
    assert tree.exact is np.int64
    best = L.Best(len(items), 4, np.zeros(len(items), dtype=np.int64))
    L.traverse(tree, docs, best)
    for at, i in enumerate(tree.order):
        scores = sum(dense[:, t] * q for t, q in zip(*items[i]))
        assert best.scores[at].tolist() == sorted(scores.tolist(), reverse=True)[:4]


def test_long_texts_in_windows(monkeypatch):
    text = ("Ab1 ÿ-2 " * 50 + "x" * 300).encode()
    want = [w for x in L.terms(text) for w in x]
    monkeypatch.setattr(L, "WINDOW", 20)
    assert [w for x in L.terms(text) for w in x] == want and want[:3] == [b"ab1", "ÿ".encode(), b"2"]


def test_empty(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a b", None, None)], DOCS), spark.createDataFrame([(1, "b c", "")], ITEMS)
    assert L.rank_documents(docs, items).collect() == [] and L.rank_documents(docs, some[1]).collect() == []
    assert L.rank_documents(some[0], items).collect() == []
    assert [tuple(r) for r in L.rank_documents(*some).collect()] == brute([(1, "a b")], [(1, "b c")], 10)
