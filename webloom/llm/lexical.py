"""Ranked lexical search of many items at once, by dual-tree traversal.

A document scores the sum over an item's terms of weight x impact, an integer law
close to BM25 (``impact``, ``weights``).  Both sides are sparse vectors and both get a
hierarchy whose nodes hold the coordinate maxima of what is below:

* items: leaves of ``ITEM_LEAF`` items that share a heavy term, joined ``FAN`` at a time;
* documents: each scan task reads its documents a batch at a time, puts those that are like
  the same items side by side in leaves of ``DOC_LEAF``, and joins ``FAN`` nodes at a time
  up to the batch's root.

The product of two nodes' maxima is at least the score of any pair below them.  If it is
less than the weakest kth score of the node's items, the pair of nodes is left out with
all pairs below: a batch at its root, a leaf at the end.  Leaves that remain are scored
exactly, the most promising first, which raises the kth scores.  Documents of a sample
(``SEED_DOCS``, at least one in ``SEED_SHARE``) are searched first, since the kth scores
of any part of the documents are bounds for all.

Texts are read once per block of items (of ``ITEM_BYTES`` of text): documents become
vectors over the block's terms, a table in the shared folder.  Nothing is shuffled
before the last step but term counts; a task keeps ``k`` documents per item, so that at
most items x k rows leave it, and equal documents, however many, cost no more than others.

Defined results: null text has no term; an item_id that repeats is one item, with its
smallest text; repeated document rows rank each; a null doc_id ranks after
others of its score; equal scores by doc_id; an item without a match, an empty table of
either kind: no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm.common import Scratch, in_pieces, utf8

K = 10
ITEM_LEAF = 8
DOC_LEAF = 8
FAN = 8
#: Nodes of the items' tree that documents are sorted by.
PROFILES = 32
BATCH_DOCS = 4_096
#: Bytes of the maxima of a batch's leaves; batches are shorter if the block has many terms.
TREE_BYTES = 64 << 20
ITEM_BYTES = 16 << 20
SEED_DOCS = 20_000
SEED_SHARE = 64
WINDOW = 1 << 20
_NO_ID = 2 ** 63 - 1
_LAST = 2.0 ** 53
_TERM = set(range(48, 58)) | set(range(97, 123)) | set(range(128, 256))
#: A-Z become a-z; what is in no term becomes a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b in _TERM else 32 for b in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """Terms in order; long texts in several lists."""
    data, at = text.translate(_TABLE), 0
    while at < len(data):
        end = data.find(b" ", at + WINDOW)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)


def impact(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = 25 + (75 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _vectors(index: dict[bytes, int]):
    """Documents with a term: (doc_id, n, ids, tfs), over the terms of ``index``."""
    def run(batches):
        get = index.get
        for b in in_pieces(batches):
            keep, sizes, ids, tfs = [], [], [], []
            for i, text in enumerate(utf8(b.column("text"))):
                n, parts = 0, []
                for some in terms(text):
                    n += len(some)
                    parts.append(np.array([x for x in map(get, some) if x is not None], dtype=np.int32))
                if n:
                    at, tf = np.unique(np.concatenate(parts), return_counts=True)
                    keep.append(i)
                    sizes.append(n)
                    ids.append(at.tobytes())
                    tfs.append(tf.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(keep, pa.int64())), pa.array(sizes, pa.int64()),
                                              pa.array(ids, pa.binary()), pa.array(tfs, pa.binary())], ["doc_id", "n", "ids", "tfs"])
    return run


def _document_counts(n_terms: int):
    def run(batches):
        found = np.zeros(n_terms, dtype=np.int64)
        for b in batches:
            found += np.bincount(np.frombuffer(b"".join(b.column("ids").to_pylist()), dtype=np.int32), minlength=n_terms)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], ["term", "df"])
    return run


class ItemTree:
    """Items as sorted sparse vectors; nodes are (first item, end, terms, maxima, children)."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]]):
        shared: dict[int, int] = {}
        for ids, _ in vectors:
            for t in ids.tolist():
                shared[t] = shared.get(t, 0) + 1
        heavy = [max(((int(q), -t) for t, q in zip(ids.tolist(), qs) if shared[t] > 1), default=(0, 0))[1] for ids, qs in vectors]
        #: place in the tree -> place in ``vectors``
        self.order = sorted(range(len(vectors)), key=lambda i: (heavy[i], i))
        self.rows = [vectors[i] for i in self.order]
        nodes = self.outline = [self._node(lo, min(lo + ITEM_LEAF, len(self.rows)), self.rows[lo:lo + ITEM_LEAF], []) for lo in range(0, len(self.rows), ITEM_LEAF)]
        while len(nodes) > 1:
            nodes = [self._node(c[0][0], c[-1][1], [(x[2], x[3]) for x in c], c) for c in (nodes[i:i + FAN] for i in range(0, len(nodes), FAN))]
            if len(self.outline) > PROFILES:
                self.outline = nodes
        self.root = nodes[0]
        top = max(int(q.sum()) for _, q in self.rows) * 1_000_000
        self.exact = np.float64 if top < _LAST else np.int64

    def profile(self, n_terms: int) -> np.ndarray:
        """Share of each term (row) in the weight of each of some nodes that hold all items."""
        out = np.zeros((n_terms, len(self.outline)), dtype=np.float32)
        for j, (lo, hi, *_) in enumerate(self.outline):
            for ids, q in self.rows[lo:hi]:
                out[ids, j] += q
        return out / np.maximum(np.sqrt((out * out).sum(axis=0)), 1)

    @staticmethod
    def _node(lo, hi, below, children):
        at = np.unique(np.concatenate([ids for ids, _ in below]))
        most = np.zeros(len(at), dtype=np.int64)
        for ids, q in below:
            here = np.searchsorted(at, ids)
            most[here] = np.maximum(most[here], q)
        return lo, hi, at, most, children


class DocTree:
    """A batch of documents: rows in leaf order, and the maxima of every level (root last)."""

    def __init__(self, doc_ids, ends, ids, impacts, profile):
        n = len(ends)
        row = np.repeat(np.arange(n), np.diff(np.concatenate([[0], ends])))
        # documents that are like the same items lie together
        like = np.add.reduceat(impacts[:, None].astype(np.float32) * profile[ids], np.concatenate([[0], ends[:-1]]), axis=0)
        two = np.argsort(-like, axis=1, kind="stable")[:, :2]
        order = np.lexsort((doc_ids, -like.max(axis=1), two[:, -1], two[:, 0]))
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n)
        entry = np.argsort(place[row], kind="stable")
        self.doc_ids, self.ids, self.impacts = doc_ids[order], ids[entry], impacts[entry]
        self.row = place[row][entry]
        self.starts = np.searchsorted(self.row, np.arange(0, n + DOC_LEAF, DOC_LEAF))
        leaves = np.zeros((-(-n // DOC_LEAF), len(profile)), dtype=np.int32)
        np.maximum.at(leaves, (self.row // DOC_LEAF, self.ids), impacts[entry].astype(np.int32))
        self.levels = [leaves]
        while len(self.levels[-1]) > 1:
            self.levels.append(np.maximum.reduceat(self.levels[-1], np.arange(0, len(self.levels[-1]), FAN), axis=0))

    def children(self, level: int, nodes: np.ndarray) -> np.ndarray:
        below = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
        return below[below < len(self.levels[level - 1])]

    def dense(self, leaves: np.ndarray, at: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents of some leaves, and their impacts on the terms ``at`` (``place`` maps terms to columns)."""
        leaves = np.sort(leaves)
        spans = [np.arange(self.starts[x], self.starts[x + 1]) for x in leaves]
        entry = np.concatenate(spans)
        rows = np.concatenate([np.arange(x * DOC_LEAF, min((x + 1) * DOC_LEAF, len(self.doc_ids))) for x in leaves])
        column = place[self.ids[entry]]
        entry, column = entry[column >= 0], column[column >= 0]
        out = np.zeros((len(rows), len(at)), dtype=np.int64)
        out[np.searchsorted(rows, self.row[entry]), column] = self.impacts[entry]
        return rows, out


class Best:
    """The k best documents of each item so far, and the scores they must reach."""

    def __init__(self, n_items: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, np.maximum(floor, 1)
        self.scores = np.zeros((n_items, k), dtype=np.int64)
        self.ids = np.full((n_items, k), _NO_ID, dtype=np.int64)

    def needed(self, lo: int, hi: int) -> np.ndarray:
        return np.maximum(self.scores[lo:hi, -1], self.floor[lo:hi])

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[item], scores]), np.concatenate([self.ids[item], ids])
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores[item], self.ids[item] = scores[order], ids[order]


def traverse(items: ItemTree, docs: DocTree, best: Best) -> int:
    """Puts the batch's documents into ``best``; returns the number of (item, document) pairs scored."""
    place, scored = np.full(docs.levels[0].shape[1], -1, dtype=np.int64), 0
    todo = [(items.root, len(docs.levels) - 1, np.zeros(1, dtype=np.int64))]
    while todo:
        node, level, nodes = todo.pop()
        lo, hi, at, most, children = node
        # rounding may only raise the bound
        bound = (docs.levels[level][nodes][:, at].astype(np.float64) @ most.astype(np.float64)) * (1 + 1e-9)
        order = np.argsort(-bound, kind="stable")
        nodes, bound = nodes[order], bound[order]
        nodes = nodes[:np.searchsorted(-bound, -float(best.needed(lo, hi).min()), "right")]
        if not len(nodes):
            continue
        if children or level:
            below = docs.children(level, nodes) if level else nodes
            todo += [(c, max(0, level - 1), below) for c in children or [node]]
            continue
        place[at] = np.arange(len(at))
        q = np.zeros((len(at), hi - lo), dtype=items.exact)
        for j in range(lo, hi):
            q[place[items.rows[j][0]], j - lo] = items.rows[j][1]
        # the last step down the items' side: each item by itself
        bound = (docs.levels[0][nodes][:, at].astype(np.float64) @ q.astype(np.float64)) * (1 + 1e-9)
        order = np.argsort(-(bound - best.needed(lo, hi)).max(axis=1), kind="stable")
        nodes, bound = nodes[order], bound[order]
        for i in range(0, len(nodes), 4):
            needed = best.needed(lo, hi)
            some = nodes[i:i + 4][(bound[i:i + 4] >= needed).any(axis=1)]
            if not len(some):
                continue
            rows, dense = docs.dense(some, at, place)
            scores = (dense.astype(items.exact) @ q).astype(np.int64)
            scored += DOC_LEAF * int((bound[i:i + 4] >= needed).sum())
            good = scores >= needed
            for j in np.flatnonzero(good.any(axis=0)):
                best.add(lo + j, scores[good[:, j], j], docs.doc_ids[rows[good[:, j]]])
        place[at] = -1
    return scored


def _search(items: ItemTree, n_vocabulary: int, n_docs: int, n_terms: int, k: int, floor: np.ndarray):
    longest = max(1, min(BATCH_DOCS, TREE_BYTES // (4 * n_vocabulary) * DOC_LEAF))

    def run(batches):
        best, profile = Best(len(items.rows), k, floor), items.profile(n_vocabulary)
        for b in batches:
            for i in range(0, b.num_rows, longest):
                some = b.slice(i, longest)
                raw = some.column("ids").to_pylist()
                ids = np.frombuffer(b"".join(raw), dtype=np.int32)
                tf = np.frombuffer(b"".join(some.column("tfs").to_pylist()), dtype=np.int32).astype(np.int64)
                counts = np.array([len(x) // 4 for x in raw], dtype=np.int64)
                n = np.repeat(some.column("n").to_numpy(), counts)
                doc_ids = some.column("doc_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)
                traverse(items, DocTree(doc_ids, np.cumsum(counts), ids, impact(tf, n, n_docs, n_terms), profile), best)
        item, at = np.nonzero(best.scores)
        ids = best.ids[item, at]
        yield pa.RecordBatch.from_arrays([pa.array(np.array(items.order, dtype=np.int64)[item]), pa.array(ids, mask=ids == _NO_ID),
                                          pa.array(best.scores[item, at])], ["item", "doc_id", "score"])
    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _item_terms(batches):
    for b in batches:
        found = [np.unique(np.array([w for x in terms(t) for w in x], dtype=object), return_counts=True) for t in utf8(b.column("text"))]
        yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.array([list(x[0]) for x in found], pa.list_(pa.binary())),
                                          pa.array([list(x[1]) for x in found], pa.list_(pa.int64()))], ["item_id", "terms", "counts"])


def _rank_block(docs: DataFrame, items: list, k: int, scratch: Scratch) -> DataFrame:
    """(item, doc_id, score, rank) of one block of items; item is the place in ``items``."""
    spark = docs.sparkSession
    index = {t: i for i, t in enumerate(sorted({bytes(t) for r in items for t in r["terms"]}))}
    vectors = scratch.save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                           .mapInArrow(_vectors(index), "doc_id long, n long, ids binary, tfs binary"))
    n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    counted = vectors.mapInArrow(_document_counts(len(index)), "term long, df long").groupBy("term").agg(F.sum("df"))
    df = np.zeros(len(index), dtype=np.int64)
    for t, n in counted.collect():  # the terms of one block of items
        df[t] = n
    weight = weights(df, n_docs)
    sparse = []
    for r in items:
        ids = np.array([index[bytes(t)] for t in r["terms"]], dtype=np.int64)
        order = np.argsort(ids)
        sparse.append((ids[order], np.array(r["counts"], dtype=np.int64)[order] * weight[ids[order]]))
    tree = ItemTree(sparse)
    there = vectors.filter(F.octet_length("ids") > 0)

    def search(rows, floor):
        return rows.mapInArrow(_search(tree, len(index), n_docs, n_terms, k, floor[tree.order]), "item long, doc_id long, score long")
    floor = np.zeros(len(items), dtype=np.int64)
    if n_docs > SEED_DOCS:
        seeds = there.sample(max(SEED_DOCS / n_docs, 1 / SEED_SHARE), seed=7)
        for i, score in _top(search(seeds, floor), k).filter(F.col("rank") == k).select("item", "score").collect():  # one row an item
            floor[i] = score
    out = scratch.save(_top(search(there, floor), k))
    scratch.drop(vectors)
    return out


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best of ``docs`` (doc_id, text) for each of ``items`` (item_id, text)."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "lexical")
    items = scratch.save(items.groupBy("item_id").agg(F.min("text").alias("text")))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // item_bytes))
    kind = items.schema["item_id"].dataType.simpleString()
    split = items.mapInArrow(_item_terms, f"item_id {kind}, terms array<binary>, counts array<long>")
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in range(n_blocks):
        here = split.filter(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == block).filter(F.size("terms") > 0).collect()
        if not here:
            continue
        found = _rank_block(docs, here, k, scratch)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(here)], f"item long, item_id {kind}")
        out = out.unionByName(found.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))  # one block
    return out
