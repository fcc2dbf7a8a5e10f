"""Passage similarity: which corpus documents contain a query passage.

Both sides become sets of word shingles (k consecutive tokens).  A pair
(query, doc) is reported when the doc holds at least
c = max(min_shared, ceil(containment * |Q|)) of the query's shingles.

(never more than |Q|).  Shingles have k words, or all words of a query that
has fewer; the corpus is cut to shingles of every length that queries have.

The corpus side is first reduced to shingles that occur in some query.  Exact
prefix filtering then keeps the join away from hot shingles: shingles are
ordered by document frequency (rarest first); a doc sharing >= c shingles of
Q must share one of any |Q| - c + 1 of Q's shingles, so candidate pairs are
generated from a prefix of rare shingles only, then verified by an exact
count of the shingles that the pair really shares.  The result equals the
plain "join on every shingle, count, filter" (which the SQL oracle runs).
Intermediate tables lie in the shared folder; whether one is broadcast is
left to Spark, by its size in bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.functions.text import tokenize
from webloom.session import Scratch


def shingles(toks, k) -> Column:
    """array<string> of k-token shingles (space-joined) of a token array."""
    toks = F.col(toks) if isinstance(toks, str) else toks
    n = F.size(toks) - k + 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(toks, i, k), " "))) \
        .otherwise(F.array().cast("array<string>"))


def shingle_sets(df: DataFrame, id_col: str, text_col: str, lengths: list[int]) -> DataFrame:
    """(id, sh), each shingle of each length once per text.  De-duplicated inside
    the row (``array_distinct``), so no shuffle; tokens are projected first so
    the tokenizer runs once per text (inside the lambda it would rerun)."""
    toks = df.select(F.col(id_col).alias("id"), tokenize(text_col).alias("_toks"))
    each = F.flatten(F.array(*[shingles("_toks", k) for k in lengths]))
    return toks.select("id", F.explode(F.array_distinct(each)).alias("sh"))


def query_shingles(queries: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(id, sh, len): shingles of ``least(k, tokens)`` words; texts without tokens have none."""
    toks = queries.select(F.col(id_col).alias("id"), tokenize(text_col).alias("_toks")).filter(F.size("_toks") > 0)
    toks = toks.withColumn("len", F.least(F.lit(k), F.size("_toks")))
    return toks.select("id", "len", F.explode(F.array_distinct(shingles("_toks", F.col("len")))).alias("sh"))


def seed_similarity(queries: DataFrame, corpus: DataFrame, k: int = 5, containment: float = 0.5,
                    min_shared: int = 3, q_id: str = "item_id", q_text: str = "text",
                    d_id: str = "doc_id", d_text: str = "text") -> DataFrame:
    """(item_id, doc_id, shared, q_shingles) for every pair over the threshold."""
    scratch = Scratch(queries.sparkSession, "similarity")
    qs = scratch.save(query_shingles(queries, q_id, q_text, k).withColumnRenamed("id", "item_id"))
    lengths = sorted(r[0] for r in qs.select("len").distinct().collect()) or [k]   # at most k values
    qsize = scratch.save(qs.groupBy("item_id").agg(F.count(F.lit(1)).alias("q_shingles")))
    need = F.least(F.col("q_shingles"), F.greatest(F.lit(min_shared), F.ceil(F.col("q_shingles") * F.lit(containment)))).cast("long")

    # The corpus cut down to the query vocabulary: everything below only moves
    # corpus shingles that occur in some query.
    ds = scratch.save(shingle_sets(corpus, d_id, d_text, lengths).withColumnRenamed("id", "doc_id")
                      .join(qs.select("sh").distinct(), "sh", "left_semi"))
    dfreq = ds.groupBy("sh").agg(F.count(F.lit(1)).alias("dfreq"))
    # Prefix: a query's shingles in rarity order up to at least |Q| - c + 1 of
    # them.  Rarity is bucketed by log2(document frequency) (bucket -1: not in
    # the corpus), so the per-query cumulative count runs over at most 65
    # aggregated rows per query -- never over a query's shingles -- and ties
    # in the last bucket are all kept (a larger prefix stays exact).
    qd = scratch.save(qs.join(dfreq, "sh", "left").fillna(0, ["dfreq"])
                      .withColumn("b", F.when(F.col("dfreq") == 0, F.lit(-1))
                                  .otherwise(F.floor(F.log2(F.col("dfreq")))).cast("int")))
    hist = qd.groupBy("item_id", "b").agg(F.count(F.lit(1)).alias("cnt")).join(qsize, "item_id")
    cum = F.sum("cnt").over(Window.partitionBy("item_id").orderBy("b")
                            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last_b = (hist.withColumn("need", need).withColumn("cum", cum)
              .filter(F.col("cum") >= F.col("q_shingles") - F.col("need") + 1)
              .groupBy("item_id").agg(F.min("b").alias("b_max")))
    prefix = scratch.save(qd.join(last_b, "item_id").filter(F.col("b") <= F.col("b_max")).select("item_id", "sh"))

    cand = scratch.save(ds.join(prefix, "sh").select("item_id", "doc_id").distinct())
    # Of the candidate documents, the (item, shingle) pairs that are there: no
    # candidate is multiplied by all of a passage's shingles.
    shared = (ds.join(cand.select("doc_id").distinct(), "doc_id", "left_semi").join(qs.select("item_id", "sh"), "sh")
              .join(cand, ["item_id", "doc_id"], "left_semi"))
    counts = shared.groupBy("item_id", "doc_id").agg(F.count(F.lit(1)).alias("shared"))
    out = counts.join(qsize, "item_id").withColumn("need", need)
    return out.filter(F.col("shared") >= F.col("need")).select("item_id", "doc_id", "shared", "q_shingles")
