"""Phrase collocations from depth-truncated suffix subtrees, after ERA's vertical partitioning.

The suffix tree of all pieces, cut off below ``max_words`` words, holds every phrase
as a node; the node's count is the total of the leaves under it.  It is never built whole:

1. Words are counted per language.  A phrase is no more frequent than its rarest word,
   so a word below ``min_count`` ends every suffix, as a piece's end does.
2. The corpus is rewritten as word numbers (a table in the shared folder), which later
   steps scan.  Numbers differ between languages, so a suffix needs no language.
3. Vertical partitioning.  A word prefix that begins more than ``budget`` suffixes is
   extended by one word, level by level, until every prefix fits the memory budget;
   each level is one counting scan for the prefixes that did not.  Prefixes are then
   grouped up to the budget: neighbouring words, or the next words of a long prefix
   by hash.
4. Every scan task sorts its suffixes, adds up equal ones and sends each group one
   compressed block; a group's subtree is the sorted order of its suffixes, read level
   by level.  Counts of the prefixes that were too large are known from step 3.

Scores, cuts and the choice of phrases are joins over the frequent nodes.

The driver and the tasks hold the ``DICT_WORDS`` most frequent words at most; if more
words are frequent, all others go by a 62-bit hash that is checked to have no collision
(another salt is taken if it has), at more bytes a suffix but with the same result.
Prefixes over the budget number at most (words of the corpus) / budget.  A hot word,
a third of all words say, is split by the words that follow it; equal suffixes are
added up before they move.

Defined results: null text is empty, null lang is ``und``; repeated rows count each;
texts of any length are read in windows; an empty table gives no rows; extra columns
are not read; doc_id is not needed.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm.common import Scratch, cut_points, in_pieces, mix64, utf8
from webloom.session import shuffle_partitions

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2_000
NO_LANG = "und"
DICT_WORDS = 1 << 18
#: Suffixes of a group; a group of that many takes about 40 MB while it is sorted.
BUDGET = 1_500_000
#: Groups per shuffle partition at least, so that partitions come out even.
SPREAD = 4
BLOCK_WORDS = 1 << 20
WINDOW = 1 << 20
FLUSH_WORDS = 200_000
#: Characters that end a piece become full stops, which are in no word; tabs become spaces.
_TABLE = bytes.maketrans(bytes(range(65, 91)) + b",;:!?\n\x0b\x0c\r\t", bytes(range(97, 123)) + b"." * 9 + b" ")


def words(text: bytes) -> Iterator[list[bytes]]:
    """Lower-cased words in order, ``b"."`` at the borders of pieces; long texts in several lists."""
    data, at = text.translate(_TABLE), 0
    while at < len(data):
        end = at + WINDOW
        if end < len(data):
            end = min((x for x in (data.find(b" ", end), data.find(b".", end)) if x >= 0), default=len(data))
        yield data[at:end].replace(b".", b" . ").split()
        at = end


def _count_words(batches):
    found: dict[str, Counter] = defaultdict(Counter)

    def flush():
        rows = [(lang, w, n) for lang, c in found.items() for w, n in c.items() if w != b"."]
        found.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()),
                                           pa.array([r[2] for r in rows], pa.int64())], ["lang", "word", "n"])
    for b in in_pieces(batches):
        for lang, text in zip(b.column("lang").to_pylist(), utf8(b.column("text"))):
            for some in words(text):
                found[lang].update(some)
                if sum(map(len, found.values())) > FLUSH_WORDS:
                    yield flush()
    yield flush()


def _hashed(salt: int, lang: bytes, word: bytes) -> int:
    """A word's number if it is not in the dictionary: bit 62 and 62 bits of XXH64."""
    return xxhash.xxh64_intdigest(b"%d\x00%b\x00%b" % (salt, lang, word), seed=42) >> 2 | 1 << 62


def _hashed_column(salt: int) -> F.Column:
    return F.shiftrightunsigned(F.xxhash64(F.concat(F.lit(f"{salt}\0"), "lang", F.lit("\0"), "word")), 2).bitwiseOR(F.lit(1 << 62))


def _squeezed(ids: np.ndarray) -> np.ndarray:
    """Runs of two numbers or more, each behind a 0."""
    on = np.concatenate([[False], ids > 0, [False]])
    here, before, after = on[1:-1], on[:-2], on[2:]
    keep = here & (before | after)
    kept = ids[keep]
    return np.insert(kept, np.flatnonzero(~before[keep]), 0)


def _encode(index: dict[str, dict[bytes, int]], complete: bool, salt: int, dtype):
    def run(batches):
        parts, held = [], 0

        def block():
            ids = _squeezed(np.concatenate(parts))
            some = [ids] if len(ids) else []
            return pa.RecordBatch.from_arrays([pa.array([len(x) for x in some], pa.int64()), pa.array([_packed(x) for x in some], pa.binary())], ["n", "ids"])
        for b in in_pieces(batches):
            for lang, text in zip(b.column("lang").to_pylist(), utf8(b.column("text"))):
                get, name = index.get(lang, {}).get, lang.encode()
                for some in words(text):
                    if complete:
                        ids = [get(w, 0) for w in some]
                    else:
                        ids = [0 if w == b"." else get(w) or _hashed(salt, name, w) for w in some]
                    parts.append(np.array(ids, dtype=dtype))
                    held += len(ids)
                parts.append(np.zeros(1, dtype=dtype))
                if held >= BLOCK_WORDS:
                    yield block()
                    parts, held = [], 0
        if held:
            yield block()
    return run


def _packed(a: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(a), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int, dtype) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, n * np.dtype(dtype).itemsize, codec="zstd", asbytes=True), dtype=dtype)


class Prefixes:
    """The vertical partitioning: which group each suffix belongs to.

    ``levels[j]`` maps prefixes of j + 1 words that are over the budget: arrays of
    (number of the prefix's parent, last word), sorted, and each one's count and
    its groups (first, how many) for the words that may follow.
    """

    def __init__(self, dict_groups: np.ndarray, rest: tuple[int, int], groups: int):
        self.dict_groups, self.rest, self.groups = dict_groups, rest, groups
        self.depth = [1] * groups          # words of a group's prefixes
        self.levels: list[dict[str, np.ndarray]] = []

    def add_level(self, parent: np.ndarray, word: np.ndarray, count: np.ndarray, budget: int) -> None:
        order = np.lexsort((word, parent))
        parent, word, count = parent[order], word[order], count[order]
        bins = -(-count // budget)
        first = self.groups + np.cumsum(bins) - bins
        words_, nth = np.unique(word, return_inverse=True)
        self.levels.append({"parent": parent, "word": word, "count": count, "first": first, "bins": bins,
                            "words": words_, "key": parent * len(words_) + nth})
        self.groups += int(bins.sum())
        self.depth += [len(self.levels) + 1] * int(bins.sum())

    def phrases(self, level: int) -> np.ndarray:
        """The words of every prefix of a level, one row each."""
        x = self.levels[level]
        if not level:
            return x["word"][:, None]
        return np.concatenate([self.phrases(level - 1)[x["parent"]], x["word"][:, None]], axis=1)

    def _found(self, level: int, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The number of (parent, word) in a level, -1 if it is not over the budget."""
        x = self.levels[level]
        if not len(x["key"]):
            return np.full(len(word), -1, dtype=np.int64)
        nth = np.minimum(np.searchsorted(x["words"], word), len(x["words"]) - 1)
        key = parent * len(x["words"]) + nth
        at = np.minimum(np.searchsorted(x["key"], key), len(x["key"]) - 1)
        return np.where((x["words"][nth] == word) & (x["key"][at] == key), at, -1)

    def hot(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions whose prefix is in the last level, and its number there."""
        at = np.flatnonzero(ids[:-1] > 0)
        number = np.zeros(len(at), dtype=np.int64)
        for j in range(len(self.levels)):
            there = at + j < len(ids)
            at, number = at[there], number[there]
            number = self._found(j, number, ids[at + j])
            at, number = at[number >= 0], number[number >= 0]
        return at, number

    def place(self, ids: np.ndarray, max_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of suffixes that go to a group, and the group."""
        padded = np.concatenate([ids, np.zeros(max_words, dtype=ids.dtype)])
        at = np.flatnonzero((padded[:-1] > 0) & (padded[1:] > 0))
        first = padded[at]
        known = first < len(self.dict_groups)
        group = np.empty(len(at), dtype=np.int64)
        group[known] = self.dict_groups[first[known]]
        group[~known] = self.rest[0] + (mix64(first[~known].astype(np.uint64)) % np.uint64(max(1, self.rest[1]))).astype(np.int64)
        open_, number = np.arange(len(at)), np.zeros(len(at), dtype=np.int64)
        for j, x in enumerate(self.levels):
            word = padded[at[open_] + j]
            number = self._found(j, number, word)
            open_, number = open_[number >= 0], number[number >= 0]
            after = padded[at[open_] + j + 1] if j + 1 < max_words else np.zeros(len(open_), dtype=ids.dtype)
            spread = (mix64(after.astype(np.uint64)) % x["bins"][number].astype(np.uint64)).astype(np.int64)
            # all nodes of a suffix that ends with the prefix are counted already
            group[open_] = np.where(after > 0, x["first"][number] + spread, -1)
        return at[group >= 0], group[group >= 0]


def _extend(prefixes: Prefixes, dtype):
    """Counts (prefix of the last level, next word); only a word over the budget can bring a longer prefix over it."""
    def run(batches):
        j = len(prefixes.levels)
        for b in batches:
            for n, data in zip(b.column("n").to_pylist(), b.column("ids").to_pylist()):
                ids = _unpacked(data, n, dtype)
                at, number = prefixes.hot(ids)
                at, number = at[at + j < n], number[at + j < n]
                word = ids[at + j]
                large = prefixes._found(0, np.zeros(len(word), dtype=np.int64), word) >= 0
                number, word = number[large], word[large]
                order = np.lexsort((word, number))
                cut = cut_points(number[order], word[order])
                yield pa.RecordBatch.from_arrays([pa.array(number[order][cut[:-1]]), pa.array(word[order][cut[:-1]].astype(np.int64)),
                                                  pa.array(np.diff(cut).astype(np.int64))], ["parent", "word", "n"])
    return run


def _suffixes(prefixes: Prefixes, max_words: int, dtype):
    """One block per group: its suffixes, equal ones added up."""
    def run(batches):
        for b in batches:
            for n, data in zip(b.column("n").to_pylist(), b.column("ids").to_pylist()):
                ids = _unpacked(data, n, dtype)
                at, group = prefixes.place(ids, max_words)
                if not len(at):
                    continue
                padded = np.concatenate([ids, np.zeros(max_words, dtype=dtype)])
                cols = [padded[at]]
                for j in range(1, max_words):
                    cols.append(np.where(cols[-1] > 0, padded[at + j], 0).astype(dtype))
                order = np.lexsort((*cols[::-1], group))
                cols, group = [c[order] for c in cols], group[order]
                cut = cut_points(group, *cols)
                counts, first = np.diff(cut), cut[:-1]
                cols, group = [c[first] for c in cols], group[first]
                edge = cut_points(group)
                out = [(int(group[i]), j - i, _packed(np.stack([c[i:j] for c in cols])), _packed(counts[i:j].astype(np.int32)))
                       for i, j in zip(edge[:-1], edge[1:])]
                yield pa.RecordBatch.from_arrays([pa.array([int(x[0]) for x in out], pa.int64()), pa.array([int(x[1]) for x in out], pa.int64()),
                                                  pa.array([x[2] for x in out], pa.binary()), pa.array([x[3] for x in out], pa.binary())],
                                                 ["grp", "n", "ids", "counts"])
    return run


def subtree(cols: list[np.ndarray], counts: np.ndarray, depth: int, min_count: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Nodes of the subtree over some suffixes, level by level from ``depth`` (2 at least) on: their words and leaf totals."""
    order = np.lexsort(cols[::-1])
    cols, counts = [c[order] for c in cols], counts[order].astype(np.int64)
    for k in range(max(2, depth), len(cols) + 1):
        cut = cut_points(*cols[:k])
        total = np.add.reduceat(counts, cut[:-1])
        keep = (total >= min_count) & (cols[k - 1][cut[:-1]] > 0)
        yield [c[cut[:-1]][keep] for c in cols[:k]], total[keep]


def _nodes(prefixes: Prefixes, max_words: int, min_count: int, dtype):
    """Frequent nodes of every group; rows come sorted by group."""
    depth = prefixes.depth

    def read(group, blocks):
        cols = [np.concatenate(x) for x in zip(*(_unpacked(d, n * max_words, dtype).reshape(max_words, n) for n, d, _ in blocks))]
        counts = np.concatenate([_unpacked(c, n, np.int32) for n, _, c in blocks])
        for words_, total in subtree(cols, counts, depth[group], min_count):
            if len(total):
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(np.arange(0, len(words_) * len(total) + 1, len(words_), dtype=np.int32),
                                              pa.array(np.stack(words_, axis=1).ravel().astype(np.int64))), pa.array(total)], ["key", "f"])

    def run(batches):
        group, blocks = None, []
        for b in batches:
            for g, *block in zip(*(b.column(c).to_pylist() for c in ("grp", "n", "ids", "counts"))):
                if g != group and blocks:
                    yield from read(group, blocks)
                    blocks = []
                group = g
                blocks.append(block)
        if blocks:
            yield from read(group, blocks)
    return run


def phrase_counts(docs: DataFrame, scratch: Scratch, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
                  budget: int = BUDGET, dict_words: int = DICT_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(key, f) of every phrase of 2 to ``max_words`` words that occurs ``min_count`` times; the
    frequent words (id, lang, word, f); and the number of words (lang, n).  A key is an array of ids."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text")
    counted = texts.mapInArrow(_count_words, "lang string, word binary, n long")
    vocabulary = scratch.save(counted.groupBy("lang", F.col("word").cast("string").alias("word")).agg(F.sum("n").alias("f")))
    totals = vocabulary.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = vocabulary.filter(F.col("f") >= min_count)
    top = frequent.orderBy(F.desc("f"), "lang", "word").limit(dict_words + 1).collect()
    complete, top = len(top) <= dict_words, sorted((r[0], r[1], r[2]) for r in top[:dict_words])
    dtype, salt = (np.int32 if complete else np.int64), 0
    while not complete and vocabulary.groupBy(_hashed_column(salt)).count().filter("count > 1").take(1):
        salt += 1
    index: dict[str, dict[bytes, int]] = defaultdict(dict)
    for i, (lang, word, _) in enumerate(top):
        index[lang][word.encode()] = i + 1
    numbers = spark.createDataFrame([(i + 1, *r) for i, r in enumerate(top)], "id long, lang string, word string, f long")
    if not complete:
        listed = numbers.select("lang", "word")
        numbers = numbers.unionByName(frequent.join(listed, ["lang", "word"], "left_anti").withColumn("id", _hashed_column(salt)))
    numbers = scratch.save(numbers)
    encoded = scratch.save(texts.mapInArrow(_encode(dict(index), complete, salt, dtype), "n long, ids binary"))

    total = frequent.agg(F.sum("f")).first()[0] or 0
    budget = max(1, min(budget, total // (SPREAD * shuffle_partitions(spark))))
    # neighbouring words that fill the budget are a group; a word over it gets levels of its own
    f = np.array([0, *(r[2] for r in top)], dtype=np.int64)
    rest = int(total - f.sum()) if not complete else 0
    groups = (np.cumsum(np.where(f > budget, 0, f)) // budget).astype(np.int64)
    prefixes = Prefixes(groups, (int(groups[-1]) + 1, -(-rest // budget)), int(groups[-1]) + 1 + -(-rest // budget))
    hot = np.flatnonzero(f > budget)
    prefixes.add_level(np.zeros(len(hot), dtype=np.int64), hot, f[hot], budget)
    hot_phrases = []
    while len(prefixes.levels[-1]["word"]) and len(prefixes.levels) < max_words:
        longer = (encoded.mapInArrow(_extend(prefixes, dtype), "parent long, word long, n long")
                  .groupBy("parent", "word").agg(F.sum("n").alias("n")).filter(F.col("n") > budget)).collect()  # at most total / budget
        prefixes.add_level(*(np.array([r[i] for r in longer], dtype=np.int64) for i in range(3)), budget)
        hot_phrases += [([int(w) for w in p], int(c)) for p, c in zip(prefixes.phrases(len(prefixes.levels) - 1), prefixes.levels[-1]["count"])
                        if c >= min_count]
    blocks = encoded.mapInArrow(_suffixes(prefixes, max_words, dtype), "grp long, n long, ids binary, counts binary")
    nodes = blocks.repartition("grp").sortWithinPartitions("grp").mapInArrow(_nodes(prefixes, max_words, min_count, dtype), "key array<long>, f long")
    nodes = scratch.save(nodes.unionByName(spark.createDataFrame(hot_phrases, "key array<long>, f long")))
    scratch.drop(encoded)
    return nodes, numbers, scratch.save(totals)


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP, **how) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by the score of
    their weakest cut, floor(1000 a n / (l r)); phrases inside a longer one as frequent are left out."""
    scratch = Scratch(docs.sparkSession, "collocations")
    nodes, numbers, totals = phrase_counts(docs, scratch, max_words, min_count, **how)
    size = F.size("key")
    # a longer phrase as frequent implies one that is longer by one word
    ends = [F.slice("key", 1, size - 1), F.slice("key", 2, size - 1)]
    inside = (nodes.filter(size > 2).select(F.explode(F.array(*ends)).alias("key"), F.col("f").alias("longer"))
              .groupBy("key").agg(F.max("longer").alias("longer")))
    kept = scratch.save(nodes.join(inside, "key", "left").filter("longer IS NULL OR longer < f").select("key", F.col("f").alias("a")))
    parts = scratch.save(nodes.unionByName(numbers.select(F.array("id").alias("key"), "f")))
    cuts = (kept.select("key", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
            .withColumns({"head": F.slice("key", F.lit(1), F.col("k")), "tail": F.slice("key", F.col("k") + 1, size - F.col("k"))}))
    cuts = (cuts.join(parts.select(F.col("key").alias("head"), F.col("f").alias("l")), "head")
            .join(parts.select(F.col("key").alias("tail"), F.col("f").alias("r")), "tail"))
    named = kept.select("key", F.posexplode("key").alias("at", "id")).join(numbers.select("id", "lang", "word"), "id")
    named = named.groupBy("key").agg(F.max("lang").alias("lang"),
                                     F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    named = named.join(F.broadcast(totals) if totals.count() <= 10_000 else totals, "lang")
    # below 1000 x 1e17 x 1e17: exact in 38 digits
    score = F.expr("(CAST(1000 AS DECIMAL(4,0)) * (CAST(a AS DECIMAL(17,0)) * CAST(n AS DECIMAL(17,0)))) DIV (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))")
    cuts = cuts.join(named, "key").withColumn("score", score.cast("long"))
    best = cuts.groupBy("lang", "key", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    rows = best.select("lang", "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), "n", F.col("b.score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return (rows.withColumn("rank", rank).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
