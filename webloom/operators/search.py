"""Rank load, keyword search and page lookups over the page / index / rank tables.

Tables: ``pages(doc_id, uri, content)``, postings ``(term, doc_id, tf)`` and
``ranks(doc_id, page_rank float)``.

``write_ranked_index`` stores the postings that a search can return in the order in which it
returns them, by (term, page rank descending, doc_id), and a directory with the first and last
place of every ``BLOCK`` postings of a term.  ``search_ranked`` reads of the directory the k first
blocks of the keyword, and of the postings only those up to the place where k are reached: no
block behind it can win.  The place is a filter on stored columns, and the files are sorted by
them with short pages, so a word in a third of all pages costs about as much as a rare one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from webloom.functions.text import doc_key
from webloom.session import Scratch

# Postings of a block, and rows of a page of the stored file.
BLOCK = 1024


def doc_rank_load(id_map: DataFrame, node_ranks: DataFrame, order_col: str | None = None) -> DataFrame:
    """(doc_id, node_id, page_rank float): archive ids joined to node ranks.

    ``id_map(trec_id, node_id)``; ``node_ranks(node_id, rank)``.  A node
    without a rank gets 0.0.  If one archive id is mapped twice, the mapping
    with the greatest ``order_col`` (e.g. line number) wins.
    """
    m = id_map
    if order_col:
        m = m.groupBy("trec_id").agg(F.max_by("node_id", order_col).alias("node_id"))
    return (m.join(node_ranks.select("node_id", "rank"), "node_id", "left")
            .select(doc_key("trec_id").alias("doc_id"), "node_id",
                    F.coalesce(F.col("rank"), F.lit(0.0)).cast("float").alias("page_rank")))


def keyword_postings(postings: DataFrame, keyword: str) -> DataFrame:
    """Postings of one (lower-cased) keyword: (doc_id, term_freq)."""
    kw = F.lower(F.lit(keyword))
    return postings.filter(F.col("term") == kw).select("doc_id", F.col("tf").alias("term_freq"))


def search_eval_count(postings: DataFrame, keyword: str) -> DataFrame:
    """Number of pages evaluated for the keyword (its posting count)."""
    return keyword_postings(postings, keyword).agg(F.count(F.lit(1)).alias("pages_evaluated"))


def search_keyword(postings: DataFrame, pages: DataFrame, ranks: DataFrame,
                   keyword: str, k: int = 20) -> DataFrame:
    """Top-k pages containing ``keyword`` by page rank (ties by doc_id).

    (doc_id, uri, page_rank, term_freq).  Plan: the keyword filter reaches the
    postings scan; postings are semi-joined to the page keys and inner-joined
    to ranks (pages without a rank or a page row drop out, as a failed lookup
    would); the top-k is a bounded heap per task; only the k winners are
    joined back to the page table for their URI (broadcast of k rows).
    """
    hits = keyword_postings(postings, keyword)
    hits = hits.join(pages.select("doc_id"), "doc_id", "left_semi")
    scored = hits.join(ranks.select("doc_id", "page_rank"), "doc_id")
    top = scored.orderBy(F.desc("page_rank"), F.asc("doc_id")).limit(k)
    return (pages.select("doc_id", "uri").join(F.broadcast(top), "doc_id")
            .select("doc_id", "uri", "page_rank", "term_freq")
            .orderBy(F.desc("page_rank"), F.asc("doc_id")))


def ranked_postings(postings: DataFrame, pages: DataFrame, ranks: DataFrame) -> DataFrame:
    """(term, page_rank, doc_id, tf) of the postings whose page has a row and a rank.

    The ranks of the pages, a short row for each, meet the postings in one join, by a hash table and without a sort."""
    ranked = ranks.select("doc_id", "page_rank").join(pages.select("doc_id"), "doc_id", "left_semi")
    return postings.join(ranked.hint("shuffle_hash"), "doc_id").select("term", "page_rank", "doc_id", "tf")


def write_ranked_index(postings: DataFrame, pages: DataFrame, ranks: DataFrame, path: str,
                       block: int = BLOCK, row_group_bytes: int = 8 << 20) -> None:
    """Stores ``path``/postings (term, page_rank, doc_id, tf) and ``path``/directory (term, first, last, n).

    Pages without a rank or a page row are left out, as a failed lookup leaves them out of a search.
    Range bounds include rank and doc_id, so a hot term is spread over tasks."""
    spark = postings.sparkSession
    found = ranked_postings(postings, pages, ranks)
    found = Scratch(spark, "ranked-postings").save(found)  # range partitioning samples its input first
    (found.repartitionByRange("term", F.desc("page_rank"), "doc_id").sortWithinPartitions("term", F.desc("page_rank"), "doc_id")
     .write.mode("overwrite").option("parquet.block.size", row_group_bytes).option("parquet.page.row.count.limit", block).parquet(f"{path}/postings"))
    stored = spark.read.parquet(f"{path}/postings")
    place = F.struct((-F.col("page_rank")).alias("less"), "doc_id")
    blocks = (stored.withColumn("_file", F.col("_metadata.file_name")).withColumn("_block", F.floor(F.col("_metadata.row_index") / block))
              .groupBy("term", "_file", "_block").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("n")))
    (blocks.select("term", "first", "last", "n").repartitionByRange("term", "first").sortWithinPartitions("term", "first")
     .write.mode("overwrite").parquet(f"{path}/directory"))


def search_ranked(spark: SparkSession, path: str, pages: DataFrame, keyword: str, k: int = 20) -> DataFrame:
    """The rows of ``search_keyword``, from a ranked index."""
    top = ranked_hits(spark, path, keyword, k)
    return (pages.select("doc_id", "uri").join(F.broadcast(top), "doc_id")  # k rows
            .select("doc_id", "uri", "page_rank", "term_freq").orderBy(F.desc("page_rank"), F.asc("doc_id")))


def ranked_hits(spark: SparkSession, path: str, keyword: str, k: int) -> DataFrame:
    """(doc_id, page_rank, term_freq) of the k best pages of a keyword."""
    word = F.lower(F.lit(keyword))
    first = (spark.read.parquet(f"{path}/directory").filter(F.col("term") == word).orderBy("first").limit(k).collect())  # k blocks hold k rows
    hits, held = spark.read.parquet(f"{path}/postings").filter(F.col("term") == word), 0
    for b in first:
        held += b["n"]
        if held >= k:
            worst = F.lit(-b["last"]["less"]).cast("float")
            hits = hits.filter((F.col("page_rank") > worst) | ((F.col("page_rank") == worst) & (F.col("doc_id") <= F.lit(b["last"]["doc_id"]))))
            break
    return hits.select("doc_id", "page_rank", F.col("tf").alias("term_freq")).orderBy(F.desc("page_rank"), F.asc("doc_id")).limit(k)


def with_key_filter(writer: DataFrameWriter, key: str, row_group_bytes: int = 8 << 20) -> DataFrameWriter:
    """Parquet with a Bloom filter of the keys beside each row group, sized by the number of its keys.

    Keys of a crawl arrive in no order, so the least and greatest key of a row group say nothing; by the
    filter, a lookup (``get_page``) reads the row group that holds the key and about one in a hundred others."""
    options = {"enabled": "true", "adaptive.enabled": "true", "fpp": "0.01"}
    for name, value in options.items():
        writer = writer.option(f"parquet.bloom.filter.{name}#{key}", value)
    return writer.option("parquet.block.size", row_group_bytes)


def get_page(pages: DataFrame, doc_id) -> DataFrame:
    """Point lookup: (doc_id, uri, content) of one key (pushed to the scan)."""
    return pages.filter(F.col("doc_id") == F.lit(doc_id)).select("doc_id", "uri", "content")


def page_keyword_lines(pages: DataFrame, keyword: str, doc_id=None) -> DataFrame:
    """(doc_id, line_no, line): lines of the page(s) that contain ``keyword``."""
    p = pages if doc_id is None else get_page(pages, doc_id)
    lines = p.select("doc_id", F.posexplode(F.split("content", "\n")).alias("line_no", "line"))
    return lines.filter(F.col("line").contains(keyword)).select(
        "doc_id", (F.col("line_no") + 1).alias("line_no"), "line")
