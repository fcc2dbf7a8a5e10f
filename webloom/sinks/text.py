"""Text and table sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_key_value(df: DataFrame, key: str, value: str, path: str, mode: str = "overwrite") -> None:
    """``key<TAB>value`` part files."""
    df.select(F.col(key).cast("string"), F.col(value).cast("string")) \
        .write.mode(mode).option("sep", "\t").option("quote", "").csv(path)


def write_lines(df: DataFrame, col: str, path: str, mode: str = "overwrite",
                compression: str | None = None) -> None:
    w = df.select(F.col(col).cast("string").alias("value")).write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "gzip",
                partition_by: list[str] | None = None) -> None:
    """Parquet table (replaces the folder by default)."""
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# Schemas of the four crawl tables (page data, index, word count, rank).
TABLE_SCHEMAS = {
    "pages": "doc_id string, uri string, content string",
    "postings": "term string, doc_id string, tf int",
    "word_count": "word string, count long",
    "page_rank": "doc_id string, page_rank float",
}


def init_tables(spark: SparkSession, base: str, names: list[str] | None = None) -> list[str]:
    """Create-or-replace the crawl tables (all, or the named ones) as empty
    gzip parquet folders under ``base``; returns the paths."""
    out = []
    for name in names or list(TABLE_SCHEMAS):
        path = f"{base.rstrip('/')}/{name}"
        spark.createDataFrame([], TABLE_SCHEMAS[name]).write.mode("overwrite") \
            .option("compression", "gzip").parquet(path)
        out.append(path)
    return out


def write_archives(records: DataFrame, path: str, text_col: str = "value") -> int:
    """Writes each partition as one archive with a gzip member per record; returns the archives.

    A task writes under a name of its own and renames at its end, so a task that
    is lost or run twice leaves one whole archive per partition; other files under ``path``
    end in ``.tmp``.  Null texts are left out; empty partitions write nothing."""
    def archive(batches):
        import gzip
        import uuid

        import pyarrow as pa
        import pyarrow.fs as pfs
        from pyspark import TaskContext
        fs, folder = pfs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
        name = f"{folder}/part-{TaskContext.get().partitionId():05d}.warc.gz"
        out, trial = None, f"{folder}/{uuid.uuid4().hex}.tmp"
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text is None:
                    continue
                if out is None:
                    fs.create_dir(folder)
                    out = fs.open_output_stream(trial)
                out.write(gzip.compress(text.encode(), mtime=0))
        if out is not None:
            out.close()
            fs.move(trial, name)
            yield pa.RecordBatch.from_arrays([pa.array([name])], ["name"])
    return records.select(text_col).mapInArrow(archive, "name string").count()
