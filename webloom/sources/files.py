"""File-as-record scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from webloom.functions.text import base_name


def scan_files(spark: SparkSession, path: str, glob: str | None = None,
               recursive: bool = False, with_content: bool = False) -> DataFrame:
    """One row per file: (file_name, path, length[, content]).

    ``binaryFile`` lists and splits files across tasks; content is only read
    when selected (column pruning keeps the scan to metadata otherwise).
    """
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    df = r.load(path)
    cols = [base_name("path").alias("file_name"), "path", "length"]
    if with_content:
        cols.append("content")
    return df.select(*cols)
