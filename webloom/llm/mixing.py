"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source gets a target in words (``targets``).  Its documents are put in a
seeded random order and read epoch by epoch until the target is reached, so
the words it gives are exact: at most one copy per source is cut, at a word
border.  That stream is cut into blocks of ``BLOCK_WORDS`` words.  A splitting tree
hands the block quotas of all sources to the output shards: every node draws, by
a multivariate hypergeometric law, which blocks go to its left half, so each
shard gets a random mix of exact size and all quotas are used up.  A shard
draws a run of each source's (randomly ordered) blocks, disjoint from all other
shards', and shuffles its documents locally.

The driver holds one row per source (at most ``MAX_SOURCES``) and the tree; the
running sums over documents are two-level: sums per bucket of the random order
(about ``BUCKET_ROWS`` rows each), then a window inside each bucket, so a
source with a third of all rows is spread over many tasks.

Defined results: null or empty text has size 0, takes 0 words and appears in
no shard; null source is a source of its own, last in order; repeated rows are
separate documents, and equal ones are interchangeable; an empty table gives no rows; extra columns
pass through ``mix``, but columns named ``shard`` and ``place`` are replaced by the mixture's.  Column
names that start with ``_mx_`` are reserved.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm.common import WORD, Scratch, hash60, n_words

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
SEED = 20_240
OUTPUT_SHARDS = 8
BLOCK_WORDS = 10_000
BUCKET_ROWS = 1_000
MAX_SOURCES = 100_000


def targets(sizes: dict, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> dict:
    """Target of each source: shares by weight, stopped at ``most`` x size, the
    excess reshared by weight until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    rest, open_, out = share * sum(sizes.values()), list(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if rest * weight[s] / total > most * sizes[s]]
        if not full:
            out |= {s: rest * weight[s] / total for s in open_}
            break
        out |= {s: most * sizes[s] for s in full}
        rest -= sum(out[s] for s in full)
        open_ = [s for s in open_ if s not in out]
    return {s: float(out[s]) for s in order}


def splitting_tree(blocks: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """Blocks of each source (columns) that each shard (rows) gets."""
    out = np.zeros((shards, len(blocks)), dtype=np.int64)

    def split(counts, low, high):
        if high - low == 1:
            out[low] = counts
            return
        mid, total = (low + high) // 2, int(counts.sum())
        left = total * (mid - low) // (high - low)
        rng = np.random.default_rng([seed, low, high])
        taken = rng.multivariate_hypergeometric(counts, left, method="marginals") if total else counts
        split(taken, low, mid)
        split(counts - taken, mid, high)

    split(np.asarray(blocks, dtype=np.int64), 0, shards)
    return out


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    return docs.withColumns({"_mx_size": n_words("text"),
                             "_mx_key": hash60(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                                                    F.md5(F.coalesce("text", F.lit("")).cast("binary"))))})


def _planned(rows: DataFrame, seed: int, shards: int, **law) -> DataFrame:
    """Sized documents with their source's figures and quotas, and their bucket."""
    spark = rows.sparkSession
    found = rows.groupBy("source").agg(F.sum("_mx_size"), F.count(F.lit(1))).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes, counts = {r[0]: r[1] for r in found}, {r[0]: r[2] for r in found}
    goal = targets(sizes, **law)
    order = list(goal)
    quota = [int(goal[s] + 0.5) for s in order]
    blocks = np.array([-(-q // BLOCK_WORDS) for q in quota], dtype=np.int64)
    drawn = splitting_tree(blocks, shards, seed)
    ends = np.cumsum(drawn, axis=0)
    # a bucket is a range of the random order: the top bits of the key
    bits = [max(0, int(np.ceil(np.log2(max(1, counts[s] / BUCKET_ROWS))))) for s in order]
    plan = spark.createDataFrame(
        [(s, i, int(sizes[s]), goal[s], quota[i], bits[i], [int(x) for x in ends[:, i]]) for i, s in enumerate(order)],
        "_mx_source string, _mx_sid int, _mx_source_size long, _mx_target double, _mx_quota long, _mx_bits int, _mx_ends array<long>")
    # bounded: one row per source, at most MAX_SOURCES
    rows = rows.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("_mx_source"))).drop("_mx_source")
    return rows.withColumn("_mx_bucket", F.expr("shiftright(_mx_key, 60 - _mx_bits)"))


def _taken(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds _mx_before (words of the source ahead of the document) and _mx_taken."""
    at = Window.partitionBy("_mx_sid").orderBy("_mx_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = scratch.save(
        rows.groupBy("_mx_sid", "_mx_bucket").agg(F.sum("_mx_size").alias("_mx_sum"))
        .withColumn("_mx_ahead", F.coalesce(F.sum("_mx_sum").over(at), F.lit(0))).drop("_mx_sum"))
    inside = Window.partitionBy("_mx_sid", "_mx_bucket").orderBy("_mx_key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.withColumn("_mx_in", F.coalesce(F.sum("_mx_size").over(inside), F.lit(0)))
            .join(ahead, ["_mx_sid", "_mx_bucket"]).withColumn("_mx_before", F.col("_mx_ahead") + F.col("_mx_in")))
    size, total, quota, before = (F.col(c) for c in ("_mx_size", "_mx_source_size", "_mx_quota", "_mx_before"))
    whole = F.when(total > 0, F.floor(quota / F.greatest(total, F.lit(1)))).otherwise(0).cast("long")
    part = F.least(F.greatest(quota - whole * total - before, F.lit(0)), size)
    return rows.withColumns({"_mx_whole": whole, "_mx_part": part})


def _drawn(shards: int) -> F.Column:
    """The document's copies that the shards draw, as (copy, words, shard): a copy belongs to the
    block it begins in, and a block to the shard whose run of the source's blocks holds it."""
    def copy(i):
        words = F.when(i < F.col("_mx_whole"), F.col("_mx_size")).otherwise(F.col("_mx_part"))
        block = F.floor((i * F.col("_mx_source_size") + F.col("_mx_before")) / BLOCK_WORDS)
        return F.struct(i.alias("copy"), words.alias("words"), F.size(F.filter("_mx_ends", lambda end: end <= block)).alias("shard"))
    return F.filter(F.transform(F.sequence(F.lit(0).cast("long"), F.col("_mx_whole")), copy), lambda c: (c["words"] > 0) & (c["shard"] < shards))


def quotas(docs: DataFrame, seed: int = SEED, shards: int = OUTPUT_SHARDS, **law) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``docs``; taken is the
    sum over the copies that the shards draw."""
    scratch = Scratch(docs.sparkSession, "mixing")
    sized = scratch.save(_sized(docs.select("doc_id", "text", "source"), seed).drop("text"))
    taken = F.aggregate(_drawn(shards), F.lit(0).cast("long"), lambda n, c: n + c["words"])
    return _taken(_planned(sized, seed, shards, **law), scratch).select(
        "doc_id", F.col("_mx_size").alias("size"), F.col("_mx_source_size").alias("source_size"),
        F.col("_mx_target").alias("target"), taken.alias("taken"))


def _first_words(text: str, n: F.Column) -> F.Column:
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), n.cast("int")), " ")


def mix(docs: DataFrame, shards: int = OUTPUT_SHARDS, seed: int = SEED, **law) -> DataFrame:
    """The mixture: one row per copy taken, with ``shard`` and ``place`` (the
    key of the local shuffle).  A copy that is cut holds its first words,
    joined by a space; every other copy is the row as it was."""
    scratch = Scratch(docs.sparkSession, "mixing")
    others = [c for c in docs.columns if c not in ("shard", "place")]
    rows = _planned(_sized(docs, seed), seed, shards, **law)
    slim = ["_mx_sid", "_mx_bucket", "_mx_size", "_mx_key", "_mx_source_size", "_mx_quota", "_mx_ends", *others]
    rows = _taken(rows.select(*slim), scratch)
    copies = rows.withColumn("_mx_copy", F.explode(_drawn(shards))).withColumn("_mx_words", F.col("_mx_copy.words"))
    copies = copies.withColumns({
        "text": F.when(F.col("_mx_words") < F.col("_mx_size"), _first_words("text", F.col("_mx_words"))).otherwise(F.col("text")),
        "_mx_shard": F.col("_mx_copy.shard"), "_mx_place": F.xxhash64(F.lit(seed + 1), "_mx_key", F.col("_mx_copy.copy").cast("int"))})
    if "n_chars" in others:
        copies = copies.withColumn("n_chars", F.when(F.col("_mx_words") < F.col("_mx_size"), F.length("text").cast("long"))
                                   .otherwise(F.col("n_chars")))
    return copies.select(*others, F.col("_mx_shard").alias("shard"), F.col("_mx_place").alias("place"))
