"""Local alignments of query passages with corpus texts: seed, chain, extend.

Texts are aligned word by word, with the scores and statistics that sequence searches
report: one hit is a row of the 12-column table (``operators.hits``).

* Seeds.  Hashes of ``k`` consecutive words of the queries meet those of the corpus in a join.
  Both sides are reduced first: places count in cells of ``CELL`` words, so a word
  repeated a thousand times in a text is a few cells, not a million pairs.
* Chains.  The cells that a query and a text share are ordered along the text; a step of more than a
  query's length starts a new chain.  A chain is a band of diagonals (place in the text less place
  in the query), widened by ``GAP`` words; a band of over ``BAND`` diagonals, which only repetitive
  texts have, is cut into overlapping ones.
* Extension.  Each band is one row with the words of the query and of the part of the text that it
  covers.  The best local alignment inside the band is found exactly, with affine
  gap costs; so a gap of up to ``GAP`` words is bridged.  A shorter hit inside a better
  one is dropped.

Everything but the alignment of one band is a join, a window or an aggregation; the
part of a text that a band needs is cut out before it moves to Python.

Ids are taken to be unique on both sides.  Null texts have no words; queries of fewer than
``k`` words have no seeds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webloom.functions.text import tokenize
from webloom.operators.hits import HITS_SCHEMA
from webloom.session import Scratch

# Scores of a word pair and of gaps, and the published statistics that belong to them (fixed values).
MATCH, MISMATCH, GAP_OPEN, GAP_EXTEND = 2, -3, 5, 2
LAMBDA, KAPPA = 0.625, 0.41

SEED_WORDS = 5
MIN_SCORE = 20
CELL = 16
GAP = 64
BAND = 4096
_LOW = -(1 << 28)


def align(q: np.ndarray, d: np.ndarray, low: int, high: int) -> tuple[int, int, int, int, int, int, int, int]:
    """(score, length, mismatches, gap openings, q start, q end, d start, d end) of the best local
    alignment on the diagonals low .. high; ends are behind the last word.  Of equal ones, the one that
    ends first in ``q``, then in ``d``."""
    n, width = len(q), high - low + 1
    h = np.zeros((n + 1, width), dtype=np.int32)
    down = np.full((n + 1, width), _LOW, dtype=np.int32)
    right = np.full((n + 1, width), _LOW, dtype=np.int32)
    slope = GAP_EXTEND * np.arange(width, dtype=np.int32)
    for i in range(1, n + 1):
        j = i - 1 + low + np.arange(width)
        inside = (j >= 0) & (j < len(d))
        pair = np.where(d[np.clip(j, 0, len(d) - 1)] == q[i - 1], MATCH, MISMATCH)
        down[i, :-1] = np.maximum(h[i - 1, 1:] - GAP_OPEN, down[i - 1, 1:]) - GAP_EXTEND
        best = np.where(inside, np.maximum(np.maximum(h[i - 1] + pair, down[i]), 0), _LOW)
        right[i, 1:] = np.maximum.accumulate(best + slope)[:-1] - slope[1:] - GAP_OPEN
        h[i] = np.where(inside, np.maximum(best, right[i]), 0)
    i, at = (int(x) for x in np.unravel_index(np.argmax(h), h.shape))
    score, q_end, d_end = int(h[i, at]), i, i + low + at
    length = mismatches = gaps = 0
    while h[i, at] > 0:
        here = h[i, at]
        same = q[i - 1] == d[i - 1 + low + at]
        if here == h[i - 1, at] + (MATCH if same else MISMATCH):
            length, mismatches, i = length + 1, mismatches + (not same), i - 1
        elif here == down[i, at]:
            gaps += 1
            while True:
                opened = down[i, at] == h[i - 1, at + 1] - GAP_OPEN - GAP_EXTEND
                length, i, at = length + 1, i - 1, at + 1
                if opened:
                    break
        else:
            gaps, start = gaps + 1, at
            while here != h[i, at] - GAP_OPEN - GAP_EXTEND * (start - at) or at == start:
                length, at = length + 1, at - 1
    return score, length, mismatches, gaps, i, q_end, i + low + at, d_end


def _aligned(min_score: int, corpus_words: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.itertuples(index=False):
                number: dict[str, int] = {}
                q, d = (np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int32) for words in (r.q_words, r.d_words))
                score, length, wrong, gaps, qs, qe, ds, de = align(q, d, r.low - r.start, r.high - r.start)
                if score >= min_score:
                    bits = (LAMBDA * score - math.log(KAPPA)) / math.log(2)
                    rows.append((r.query_id, r.subject_id, 100.0 * (length - wrong - _gapped(length, qs, qe, ds, de)) / length, length, wrong, gaps,
                                 qs + 1, qe, ds + r.start + 1, de + r.start, len(q) * corpus_words * 2.0 ** -bits, bits, score, len(q)))
            yield pd.DataFrame(rows, columns=_COLUMNS)
    return run


def _gapped(length: int, qs: int, qe: int, ds: int, de: int) -> int:
    """Columns of an alignment in which one side has a gap."""
    return 2 * length - (qe - qs) - (de - ds)


_SCHEMA = HITS_SCHEMA + ", score int, query_words int"
_COLUMNS = [c.split()[0] for c in _SCHEMA.split(", ")]


def _cells(words: DataFrame, id_col: str, k: int) -> DataFrame:
    """(id, seed, cell): the cells in which a text's seeds begin, once for each place.

    A word is taken by its place (a slice would copy all words of the text for each seed), and repeats
    stay in (an array of structs is made distinct by comparing all pairs); callers drop them from the rows."""
    n = F.size("words") - k + 1
    seeds = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(
        F.concat_ws(" ", *[F.try_element_at("words", i + j) for j in range(1, k + 1)]))))
    return words.select(id_col, F.posexplode(seeds).alias("i", "seed")).select(
        id_col, "seed", F.floor(F.col("i") / CELL).cast("int").alias("cell"))


def _bands(shared: DataFrame, lengths: DataFrame) -> DataFrame:
    """(query_id, subject_id, low, high): bands of diagonals from cells that are shared."""
    pair = Window.partitionBy("query_id", "subject_id").orderBy("d_cell", "q_cell")
    steps = (shared.join(lengths, "query_id")
             .withColumn("far", (F.col("d_cell") - F.lag("d_cell").over(pair) > F.ceil(F.col("n") / CELL) + 1).cast("int"))
             .withColumn("chain", F.sum(F.coalesce("far", F.lit(0))).over(pair)))
    diagonal = (F.col("d_cell") - F.col("q_cell")) * CELL
    chains = steps.groupBy("query_id", "subject_id", "chain", "n").agg(
        (F.min(diagonal) - CELL + 1).alias("first"), (F.max(diagonal) + CELL - 1).alias("last"))
    room = F.least(F.col("n"), F.lit(GAP)).cast("int")
    # a band that is too wide is cut; the pieces overlap by what an alignment can drift
    piece = F.sequence(F.col("first"), F.col("last"), F.lit(BAND))
    return (chains.withColumn("at", F.explode(piece))
            .select("query_id", "subject_id", (F.col("at") - room).cast("int").alias("low"),
                    (F.least(F.col("at") + BAND, F.col("last")) + room).cast("int").alias("high")).distinct())


def passage_hits(queries: DataFrame, corpus: DataFrame, k: int = SEED_WORDS, min_score: int = MIN_SCORE,
                 q_id: str = "item_id", q_text: str = "text", d_id: str = "doc_id", d_text: str = "text") -> DataFrame:
    """The 12 columns of a hit (ids as text), then its score and the query's length in words."""
    scratch = Scratch(queries.sparkSession, "alignment")
    q = scratch.save(queries.select(F.col(q_id).cast("string").alias("query_id"), tokenize(q_text).alias("words")).filter(F.size("words") >= k))
    d = corpus.select(F.col(d_id).cast("string").alias("subject_id"), tokenize(d_text).alias("words"))
    seen = scratch.save(d.select("subject_id", F.size("words").alias("n")))
    corpus_words = seen.agg(F.sum(F.greatest("n", F.lit(0)))).first()[0] or 0
    q_cells = scratch.save(_cells(q, "query_id", k).distinct().withColumnRenamed("cell", "q_cell"))
    seeds = scratch.save(q_cells.select("seed").distinct())
    # only what occurs in a query goes on, each cell once; Spark broadcasts the seeds if they are few
    d_cells = scratch.save(_cells(d, "subject_id", k).join(seeds, "seed", "left_semi").distinct().withColumnRenamed("cell", "d_cell"))
    shared = d_cells.join(q_cells, "seed").select("query_id", "subject_id", "q_cell", "d_cell").distinct()
    bands = scratch.save(_bands(shared, q.select("query_id", F.size("words").alias("n"))))
    texts = d.join(bands.select("subject_id").distinct(), "subject_id", "left_semi").select("subject_id", F.col("words").alias("text_words"))
    start = F.greatest(F.col("low"), F.lit(0))
    work = (bands.join(q.select("query_id", F.col("words").alias("q_words")), "query_id").join(texts, "subject_id")
            .withColumn("start", start).filter(F.col("start") < F.size("text_words"))
            .withColumn("d_words", F.slice("text_words", F.col("start") + 1, F.greatest(F.lit(1), F.col("high") - F.col("start") + F.size("q_words")))))
    rows = work.select("query_id", "subject_id", "low", "high", "start", "q_words", "d_words").mapInPandas(_aligned(min_score, corpus_words), _SCHEMA)
    # overlapping bands find the same hit, or a part of it
    per = rows.distinct().groupBy("query_id", "subject_id").agg(F.collect_list(F.struct(*_COLUMNS[2:])).alias("hits"))
    inside = lambda x, o: (o["s_start"] <= x["s_start"]) & (o["s_end"] >= x["s_end"]) & (o["score"] > x["score"])
    kept = F.filter("hits", lambda x: ~F.exists("hits", lambda o: inside(x, o)))
    return per.select("query_id", "subject_id", F.explode(kept).alias("hit")).select("query_id", "subject_id", "hit.*")
