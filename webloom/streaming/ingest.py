"""Incremental crawl ingest with Structured Streaming.

New archive files dropped into a folder are picked up by a ``binaryFile``
stream (paths only; a task streams each archive from storage); each
micro-batch is decoded, turned into page rows (response records, HTTP header
cut, text extracted, doc key from the archive id) and *appended* to a page
table and a postings table.  Nothing stored is read or rewritten by a batch,
so its cost follows the batch and an unreadable old file can lose nothing.

Both tables are partitioned by (stream, batch); a batch that is replayed after
a failure overwrites its own partition only, so replays are idempotent.  Rows
carry the time their batch was loaded, and readers take the latest version of a
page (``current_pages``) and the postings of that version
(``current_postings``).  ``compact`` writes the current rows to new folders.
With an ``index_path`` the postings go to a segmented index instead
(``operators.segments``), whose readers meet no versions.  Checkpoint and table folders must be on shared storage.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.functions.html import html_to_text
from webloom.functions.text import doc_key, strip_http_header
from webloom.operators.index import term_freqs
from webloom.operators.search import with_key_filter
from webloom.operators.segments import SegmentIndex
from webloom.sources.warc import RECORD_SCHEMA, _open_path, page_text, record_batches

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
PAGES_SCHEMA = "doc_id string, uri string, content string, loaded long, stream string, batch long"
POSTINGS_SCHEMA = "term string, doc_id string, tf int, loaded long, stream string, batch long"


def _decode(batches):
    for pdf in batches:
        for path in pdf["path"]:
            yield from record_batches(path, _open_path(path))


def page_rows(records: DataFrame) -> DataFrame:
    """(doc_id, uri, content) from decoded records (response records only)."""
    resp = records.filter((F.col("type") == "response") & F.col("content").isNotNull())
    html = strip_http_header(page_text("content"))
    rows = resp.select(doc_key(F.col("metadata")["WARC-TREC-ID"]).alias("doc_id"),
                       F.col("metadata")["WARC-Target-URI"].alias("uri"),
                       html_to_text(html).alias("content"), "file_name", "record_no")
    # Several records for one page in a batch: the last one (file, record order) wins.
    last = F.max_by(F.struct("uri", "content"), F.struct("file_name", "record_no"))
    return rows.groupBy("doc_id").agg(last.alias("_r")).select("doc_id", "_r.uri", "_r.content")


def _append(rows: DataFrame, path: str, stream: str, batch: int, loaded: int) -> None:
    """Writes the batch's own partition; no other is touched."""
    rows = rows.withColumns({"loaded": F.lit(loaded).cast("long"), "stream": F.lit(stream), "batch": F.lit(batch).cast("long")})
    out = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stream", "batch")
    with_key_filter(out, "doc_id").parquet(path)


def _versions(spark: SparkSession, pages_path: str) -> DataFrame:
    return spark.read.schema(PAGES_SCHEMA).parquet(pages_path)


def current_pages(spark: SparkSession, pages_path: str) -> DataFrame:
    """(doc_id, uri, content): the latest version of every page."""
    last = F.max_by(F.struct("uri", "content"), F.struct("loaded", "stream", "batch"))
    return _versions(spark, pages_path).groupBy("doc_id").agg(last.alias("_r")).select("doc_id", "_r.uri", "_r.content")


def current_postings(spark: SparkSession, postings_path: str, pages_path: str) -> DataFrame:
    """(term, doc_id, tf) of the latest version of every page, and of no earlier one."""
    at = ["loaded", "stream", "batch"]
    latest = _versions(spark, pages_path).groupBy("doc_id").agg(F.max(F.struct(*at)).alias("_v")).select("doc_id", "_v.*")
    posts = spark.read.schema(POSTINGS_SCHEMA).parquet(postings_path)
    return posts.join(latest, ["doc_id", *at]).select("term", "doc_id", "tf")


def get_page(spark: SparkSession, pages_path: str, doc_id: str) -> DataFrame:
    """The latest version of one page; row groups without the key are not read."""
    last = F.max_by(F.struct("uri", "content"), F.struct("loaded", "stream", "batch"))
    found = _versions(spark, pages_path).filter(F.col("doc_id") == F.lit(doc_id))
    return found.groupBy("doc_id").agg(last.alias("_r")).select("doc_id", "_r.uri", "_r.content")


def compact(spark: SparkSession, pages_path: str, postings_path: str, new_pages: str, new_postings: str) -> None:
    """Writes the current rows, as one version, to new folders; the old ones stay as they are."""
    loaded = time.time_ns() // 1000
    _append(current_pages(spark, pages_path), new_pages, "compacted", 0, loaded)
    _append(current_postings(spark, postings_path, pages_path), new_postings, "compacted", 0, loaded)


def start_ingest(spark: SparkSession, input_dir: str, pages_path: str, postings_path: str | None,
                 checkpoint: str, glob: str = "*.gz", trigger_once: bool = False,
                 max_files_per_trigger: int = 64, index_path: str | None = None):
    """Start the stream; returns the ``StreamingQuery``.  Postings go to ``postings_path``, to the
    segmented index in ``index_path``, or to both."""
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", glob)
             .option("maxFilesPerTrigger", max_files_per_trigger).load(input_dir).select("path"))
    recs = files.mapInPandas(_decode, RECORD_SCHEMA)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        # The query's id is kept in its checkpoint: the same after a restart.
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        loaded = time.time_ns() // 1000
        pages = page_rows(batch).persist()
        if not pages.isEmpty():
            if postings_path:
                _append(term_freqs(pages, text_col="content").select("term", "doc_id", "tf"), postings_path, stream, epoch_id, loaded)
            if index_path:
                SegmentIndex.open_or_create(batch.sparkSession, index_path).add(pages, text_col="content", stream=stream, batch=epoch_id)
            _append(pages, pages_path, stream, epoch_id, loaded)  # last: a page is current only with its postings
        pages.unpersist()

    w = recs.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="30 seconds")
    return w.start()
