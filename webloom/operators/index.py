"""Term statistics and the inverted index.

Postings are stored *long* -- one row per (term, doc_id) -- never as one wide
row per term: a hot term may be in a third of all documents, and a long table
splits it across tasks by doc_id.  The map view (``postings_map``) chunks hot
terms so no single row or group grows with the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions.text import is_number_string, is_stop_word, tokenize
from webloom.session import Scratch

# A run of equal lines; possessive, so that the engine does not recurse on a long one.
RUN_PATTERN = r"([^\n]++)(?:\n\1(?![^\n]))*+"


def token_counts(docs: DataFrame, text_col: str = "text", stage: str = "raw") -> DataFrame:
    """(token, n) corpus counts after a tokenizer stage.

    stage: 'raw' (tokenized), 'no_stop' (stop words removed), 'index' (stop
    words and numbers removed -- the index vocabulary).
    """
    toks = docs.select(F.explode(tokenize(text_col)).alias("token"))
    if stage in ("no_stop", "index"):
        toks = toks.filter(~is_stop_word("token"))
    if stage == "index":
        toks = toks.filter(~is_number_string("token"))
    return toks.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def number_flags(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(token, is_number) for every distinct token of the corpus."""
    toks = docs.select(F.explode(tokenize(text_col)).alias("token")).distinct()
    return toks.select("token", is_number_string("token").alias("is_number"))


def term_freqs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings (doc_id, term, tf): index terms counted per document.

    Map-only, like an in-mapper hash map per document: the document's tokens
    are sorted and joined by line ends, which no token holds, and each run of
    equal lines is one match, so no posting crosses a shuffle (a document is
    one row, in one task).  Stop words and numbers are dropped once per distinct
    term; only what does not begin with g..z, as no number does, is put to the
    number test's patterns.
    """
    lines = docs.select(F.col(id_col).alias("doc_id"), F.array_join(F.sort_array(tokenize(text_col)), "\n").alias("_lines"))
    runs = lines.select("doc_id", F.explode(F.regexp_extract_all("_lines", F.lit(RUN_PATTERN), 0)).alias("_run"))
    terms = runs.select("doc_id", F.substring_index("_run", "\n", 1).alias("term"), "_run")
    counted = terms.select("doc_id", "term", F.expr("(octet_length(_run) + 1) DIV (octet_length(term) + 1)").cast("int").alias("tf"))
    term = F.col("term")
    return counted.filter(~is_stop_word(term) & (((term >= "g") & (term < "{")) | ~is_number_string(term)))


def word_count(postings: DataFrame) -> DataFrame:
    """(word, count) corpus-wide occurrences from postings (sum of tf)."""
    return (postings.groupBy(F.col("term").alias("word"))
            .agg(F.sum("tf").cast("long").alias("count")))


def inverted_index(postings: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Postings laid out for lookup: range-partitioned and sorted by (term, doc_id).

    Written to parquet this gives row groups with tight min/max on ``term`` so
    a keyword filter skips almost every row group.  Range bounds include
    doc_id, so a hot term is split across several partitions.
    """
    # Range partitioning samples its input first: stored, the text is tokenized once.
    df = Scratch(postings.sparkSession, "postings").save(postings.select("term", "doc_id", "tf"))
    df = (df.repartitionByRange(num_partitions, "term", "doc_id") if num_partitions
          else df.repartitionByRange("term", "doc_id"))
    return df.sortWithinPartitions("term", "doc_id")


def index_scan(postings: DataFrame, start_term: str | None = None,
               stop_term: str | None = None) -> DataFrame:
    """Key-ordered scan (bytewise by term, then doc_id), optionally between a
    start term (inclusive) and a stop term (exclusive), like a table scan."""
    df = Scratch(postings.sparkSession, "postings").save(postings)  # the sort samples its input
    if start_term is not None:
        df = df.filter(F.col("term") >= start_term)
    if stop_term is not None:
        df = df.filter(F.col("term") < stop_term)
    return df.orderBy("term", "doc_id")


def postings_map(postings: DataFrame, max_entries: int = 100_000) -> DataFrame:
    """Wide view: (term, chunk, postings map<doc_id, tf>).

    A term with more than ``max_entries`` documents is spread over
    ceil(df / max_entries) chunks by a hash of doc_id, so no map (and no
    collect group) grows beyond about ``max_entries`` entries.
    """
    scratch = Scratch(postings.sparkSession, "postings-map")
    postings = scratch.save(postings.select("term", "doc_id", "tf"))
    # A plain table on either side, so that a hot term can be split in the join.
    chunks = scratch.save(postings.groupBy("term").agg(F.ceil(F.count(F.lit(1)) / F.lit(max_entries)).cast("long").alias("_n")))
    keyed = postings.join(chunks, "term").withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.col("_n")))
    return (keyed.groupBy("term", "chunk")
            .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("doc_id", "tf"))))
                 .alias("postings")))


def explode_postings_map(wide: DataFrame) -> DataFrame:
    """Back to the long form (term, doc_id, tf)."""
    return wide.select("term", F.explode("postings").alias("doc_id", "tf"))


def write_index(postings: DataFrame, path: str, num_partitions: int | None = None,
                row_group_bytes: int = 8 << 20) -> None:
    """Store postings as parquet laid out by (term, doc_id): range-partitioned
    and sorted, with modest row groups, so each file and row group covers a
    narrow term range and a keyword filter (pushed to the scan) skips the
    rest by min/max statistics."""
    (inverted_index(postings, num_partitions).write.mode("overwrite")
     .option("parquet.block.size", row_group_bytes).parquet(path))
