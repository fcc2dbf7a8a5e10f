"""Benchmark decontamination by spaced-seed hashing.

Words are runs of letters and digits, A-Z lower-cased (any byte outside ASCII
counts as a letter), so case, punctuation and white space don't hide a passage.  A
spaced seed hashes six word positions of a window of up to eleven and ignores
the others: words substituted there don't matter.  The four masks together hit
every stretch of ``MIN_WORDS`` words with two substitutions anywhere (tested
exhaustively), and longer stretches with more.

Seeds of the benchmark are joined with the seeds at every word of every
document; around each hit the two texts are compared word by word along the
hit's diagonal, and the longest stretch with at least ``SIMILARITY`` equal words
is kept.  It counts if it has ``MIN_WORDS`` words, or covers ``SIMILARITY`` of a
shorter item.  Items shorter than ``SHORT_ITEM`` have masks of weight four, which hit every
stretch that counts (tested exhaustively).  Items of fewer than ``MIN_ITEM`` words are in
many texts by chance: a document holds one only if it has the item's words and no others.

The benchmark is the stated query set: it is read in blocks of at most
``BLOCK_WORDS`` words (or one item), each block's seeds are a broadcast of
bounded size, and every block meets all documents.  Nothing about documents is
collected or shuffled.  Repetitive texts have many hits: diagonals are marked in an array and
compared as matrices, so a text costs at most its length times the item's.

Defined results: null and empty texts match nothing; repeated documents are
reported each; equal items are reported each; empty tables give no matches;
extra columns pass through ``remove_contaminated`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import cut_points, in_pieces, mix64, prepare, utf8, word_hashes

#: Positions that a mask looks at, of weight six (fixed values).
MASKS = ((0, 2, 3, 4, 8, 9), (0, 3, 6, 7, 9, 10), (0, 1, 3, 5, 8, 10), (0, 4, 5, 6, 7, 9))
#: For items so short that less than MIN_WORDS words count (fixed values).
SHORT_MASKS = ((0, 1, 2, 3), (0, 1, 3, 4), (0, 2, 3, 4), (0, 1, 2, 4))
MIN_WORDS = 13
SHORT_ITEM = 16
MIN_ITEM = 5
SIMILARITY = 0.8
BLOCK_WORDS = 500_000
_BITS = 22
_CELLS = 1 << 20  # words compared at a time

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> np.ndarray:
    return word_hashes(text.translate(_FOLD))


def seeds(words: np.ndarray, mask: tuple[int, ...], number: int) -> np.ndarray:
    """The mask's hash at every position where its window fits."""
    n = len(words) - mask[-1]
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, number, dtype=np.uint64)
    for j in mask:
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[j:j + n]
    return mix64(out)


class Block:
    """Items with the seed table of their words."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.ids = [i for i, _ in items]
        self.words = [words_of(t) for _, t in items]
        long_, short = list(enumerate(MASKS)), [(100 + i, m) for i, m in enumerate(SHORT_MASKS)]
        self.masks = (long_ if any(len(w) >= SHORT_ITEM for w in self.words) else []) + (
            short if any(MIN_ITEM <= len(w) < SHORT_ITEM for w in self.words) else [])
        self.tiny: dict[bytes, list[int]] = {}
        hashes, owners, places = [], [], []
        for at, w in enumerate(self.words):
            if 0 < len(w) < MIN_ITEM:
                self.tiny.setdefault(w.tobytes(), []).append(at)
                continue
            for number, mask in long_ if len(w) >= SHORT_ITEM else short:
                h = seeds(w, mask, number)
                hashes.append(h)
                owners.append(np.full(len(h), at))
                places.append(np.arange(len(h)))
        h = np.concatenate([np.zeros(0, np.uint64), *hashes])
        order = np.argsort(h, kind="stable")
        self.hashes = h[order]
        self.owners = np.concatenate([np.zeros(0, np.int64), *owners])[order]
        self.places = np.concatenate([np.zeros(0, np.int64), *places])[order]
        self.table = np.zeros(1 << _BITS, dtype=bool)
        self.table[self.hashes >> np.uint64(64 - _BITS)] = True

    def diagonals(self, words: np.ndarray) -> dict[int, np.ndarray]:
        """For each item that is hit, its offsets in the document at which it is."""
        marked: dict[int, np.ndarray] = {}
        for number, mask in self.masks:
            h = seeds(words, mask, number)
            at = np.flatnonzero(self.table[h >> np.uint64(64 - _BITS)])
            low = np.searchsorted(self.hashes, h[at], "left")
            hit = np.flatnonzero(self.hashes[np.minimum(low, len(self.hashes) - 1)] == h[at]) if len(at) else at
            if not len(hit):  # most texts and masks
                continue
            hit = hit[np.argsort(low[hit], kind="stable")]
            at, low = at[hit], low[hit]
            high = np.searchsorted(self.hashes, h[at], "right")
            cut = cut_points(low)
            for i, j in zip(cut[:-1], cut[1:]):  # the document's places of one seed, and the items'
                for k in range(low[i], high[i]):
                    item = int(self.owners[k])
                    if item not in marked:
                        marked[item] = np.zeros(len(words) + len(self.words[item]), dtype=bool)
                    marked[item][at[i:j] - self.places[k] + len(self.words[item])] = True
        return {item: np.flatnonzero(m) - len(self.words[item]) for item, m in marked.items()}

    def matches(self, words: np.ndarray, min_words: int, similarity: float) -> list[tuple[int, int, int, int]]:
        """(item, words matched, length, start in the document): each item's best verified stretch."""
        out = [(item, len(words), len(words), 0) for item in self.tiny.get(words.tobytes(), ())] if len(words) < MIN_ITEM else []
        for item, shifts in self.diagonals(words).items():
            w, best = self.words[item], (0, 0, 0)
            least = min(min_words, similarity * len(w))
            step = max(1, _CELLS // len(w))
            for i in range(0, len(shifts), step):
                if best[0] == len(w):
                    break
                place = shifts[i:i + step, None] + np.arange(len(w))
                inside = (place >= 0) & (place < len(words))
                same = inside & (words[np.clip(place, 0, len(words) - 1)] == w)
                for row in np.flatnonzero(same.sum(axis=1) >= max(best[0] + 1, similarity * least - 1e-9)):
                    on = np.flatnonzero(inside[row])
                    start, length, equal = stretch(same[row, on[0]:on[-1] + 1], similarity)
                    if length >= least and equal > best[0]:
                        best = (equal, length, int(place[row, on[0]]) + start)
                        if equal == len(w):
                            break
            if best[0]:
                out.append((item, *best))
        return sorted(out)


def stretch(same: np.ndarray, similarity: float) -> tuple[int, int, int]:
    """(start, length, equal words) of the longest stretch with at least
    ``similarity`` equal words; the first of several."""
    # equal words count 1 - similarity, others -similarity: the longest stretch whose sum is not negative
    total = np.concatenate([[0.0], np.cumsum(same - similarity)])
    least = np.minimum.accumulate(total)
    starts = np.flatnonzero(np.diff(least, prepend=np.inf) < 0)  # where the sum is lower than ever before
    first = starts[np.searchsorted(-total[starts], -total - 1e-9)]
    length = np.arange(len(total)) - first
    end = int(np.argmax(length))
    start = int(first[end])
    return start, end - start, int(same[start:end].sum())


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The benchmark in blocks; only one is on the driver at a time."""
    items: list[tuple[int, bytes]] = []
    n = 0
    for r in benchmark.filter("text IS NOT NULL").select("item_id", "text").toLocalIterator():
        text = r[1].encode("utf-8")
        size = len(text.split())
        if items and n + size > block_words:
            yield Block(items)
            items, n = [], 0
        items.append((r[0], text))
        n += size
    yield Block(items)


def contaminated(docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY,
                 block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, matched, length, start): a row for every document and
    item that overlap; clean documents have none."""
    spark = docs.sparkSession
    prepare(spark)
    schema = "doc_id long, item_id long, matched int, length int, start int"
    names = [f.split()[0] for f in schema.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]

    def matcher(shared):
        def run(batches):
            block = shared.value
            for b in in_pieces(batches):
                at, found = [], []
                for k, text in enumerate(utf8(b.column("text"))):
                    for item, equal, length, start in block.matches(words_of(text), min_words, similarity):
                        at.append(k)
                        found.append((block.ids[item], equal, length, start))
                cols = [b.column("doc_id").take(pa.array(at, pa.int64()))]
                cols += [pa.array([f[i] for f in found], t) for i, t in enumerate(types[1:])]
                yield pa.RecordBatch.from_arrays(cols, names)
        return run

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return reduce(DataFrame.unionByName, [rows.mapInArrow(matcher(spark.sparkContext.broadcast(b)), schema)
                                          for b in blocks(benchmark, block_words)])


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS,
                        similarity: float = SIMILARITY, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the documents that overlap an item."""
    spark = docs.sparkSession
    prepare(spark)

    def cleaner(shared):
        def run(batches):
            block = shared.value
            for b in in_pieces(batches):
                keep = [not block.matches(words_of(t), min_words, similarity) for t in utf8(b.column("text"))]
                yield b.filter(pa.array(keep, pa.bool_()))
        return run

    for block in blocks(benchmark, block_words):
        docs = docs.mapInArrow(cleaner(spark.sparkContext.broadcast(block)), docs.schema)
    return docs
