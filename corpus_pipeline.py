"""Corpus pipeline: quality, near-duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept.  All but the last return the columns of ``documents``.  Null text is empty in every
stage; an empty table gives an empty one; extra columns pass through, but the last stage
replaces columns named ``shard`` and ``slot``, and names that start with ``_mx_`` or ``_sh_`` are reserved.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from webloom.llm import decontaminate, mixing, quality, sharding, simhash
from webloom.llm.common import load, prepare
from webloom.session import scratch_path

SHARDS = 8


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the classifier scores below its threshold.

    It learns from the labelled rows of ``docs``; see ``quality``.  Repeated rows are
    scored alike, so all stay or all go; empty texts have a score too."""
    prepare(spark)
    return quality.keep_good(docs, quality.train(docs, load(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: the smallest doc_id.

    Empty texts are one group.  Rows without a doc_id stay; a doc_id that repeats keeps a row for
    each group it is the smallest of, chosen by the text."""
    prepare(spark)
    return simhash.keep_one(docs, shingle_words=simhash.SHINGLE_WORDS, distance=simhash.DISTANCE)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, repeated rows alike; null and empty items match nothing."""
    prepare(spark)
    return decontaminate.remove_contaminated(docs, load(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the shards of the mixture draw; a cut copy holds its first words.

    Null source is a source of its own.  Documents without words are not taken.  Ties of the random
    order go by doc_id; the shards and the local order are drawn anew by the sharding stage."""
    prepare(spark)
    return mixing.mix(docs, shards=SHARDS).select(*docs.columns)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot; repeated rows and copies are numbered each."""
    prepare(spark)
    return sharding.shard(docs, SHARDS)


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mixing_stage),
    ("sharding", sharding_stage),
]

#: SQL cannot express a trained classifier; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written and read again."""
    prepare(spark)
    base = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    docs = load(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{base}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
