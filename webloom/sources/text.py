"""Line-oriented text sources: numbers, adjacency lists, vectors, id maps,
rank pairs and tabular hits.  All are ``spark.read.text``/``csv`` scans
parsed with Column expressions (no Python per line)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webloom.operators.graph import edges_from_adjacency
from webloom.operators.hits import HITS_SCHEMA


def read_numbers(spark: SparkSession, path: str, lenient: bool = False) -> DataFrame:
    """(value double): one number per line.  A bad line fails the job (ANSI
    cast) like the reference's parser; ``lenient`` turns it into null."""
    v = F.col("value")
    num = F.expr("try_cast(value AS double)") if lenient else v.cast("double")
    return spark.read.text(path).select(num.alias("value"))


def read_adjacency(spark: SparkSession, path: str, sep: str = r"\s+"):
    """(nodes, edges) from adjacency lines ``src t1 t2 ...``."""
    return edges_from_adjacency(spark.read.text(path), "value", sep)


def parse_vectors(lines: DataFrame, id_col: str, col: str = "value") -> DataFrame:
    """(id, features array<double>) from comma-separated lines."""
    feats = F.transform(F.split(F.trim(F.col(col)), ","), lambda x: F.trim(x).cast("double"))
    return lines.filter(F.length(F.trim(F.col(col))) > 0).select(F.col(id_col).alias("id"), feats.alias("features"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value): the lines of every text file with their place.

    Spark gives no line numbers, but it names the file and the byte where each
    split of it starts; inside a split, lines keep their order.  (file, split
    start, order inside the split) therefore is the file order, whatever files
    or splits a task packs together; it is made dense per file by sums per split."""
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("_at"), "value")
    return rows.select("file", F.struct("start", "_at").alias("line_no"), "value")


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """(id, features): the id is a hash of (file, text, how many equal lines of
    the file come before), so it is the same however files are split."""
    rows = numbered_lines(spark, path).filter(F.length(F.trim("value")) > 0)
    again = F.row_number().over(Window.partitionBy("file", "value").orderBy("line_no"))
    return parse_vectors(rows.select(F.xxhash64("file", "value", again).alias("id"), "value"), "id")


def read_id_map(spark: SparkSession, path: str) -> DataFrame:
    """(trec_id, node_id, line_no): trimmed lines split at the first TAB;
    blank lines skipped.  ``line_no`` orders duplicate ids (last wins): by
    file path, then by place in the file."""
    lines = numbered_lines(spark, path).select(F.trim("value").alias("v"), F.struct("file", "line_no").alias("line_no"))
    parts = F.split(F.col("v"), "\t", 2)
    return lines.filter(F.col("v") != "").select(
        parts.getItem(0).alias("trec_id"), F.trim(parts.getItem(1)).cast("long").alias("node_id"), "line_no")


def read_rank_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(node_id, rank float): 'nodeId rank' lines; the count header line
    (no space) is skipped."""
    v = F.trim(F.col("value"))
    parts = F.split(v, " ", 2)
    return (spark.read.text(path).filter(F.instr(v, " ") > 0)
            .select(parts.getItem(0).cast("long").alias("node_id"),
                    F.trim(parts.getItem(1)).cast("float").alias("rank")))


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """12-column TAB-separated hits plus the file they came from."""
    return (spark.read.schema(HITS_SCHEMA).option("sep", "\t").csv(path)
            .withColumn("file_name", F.element_at(F.split(F.input_file_name(), "/"), -1)))
