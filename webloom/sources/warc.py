"""Web-archive (WARC) ingest.

``binaryFile`` lists the archive files (path only -- the content column is
pruned, nothing is read) and hands each file to one task (an archive is a
single gzip stream, so it cannot be split).  The task streams the file from
storage through ``pyarrow.fs`` (local, HDFS, S3, GCS; '.gz' decompressed on
the fly), so memory follows a record, not a file, and files over 2 GB work;
a ``mapInPandas`` generator yields one row per record.  ``stream=False``
reads the file bytes through ``binaryFile`` instead (whole file in memory;
for URI schemes pyarrow cannot open, e.g. ``s3a://``).

Record rules (the public archive format, read tolerantly):

* a record starts at a line that begins with the version mark (``WARC/``);
* header lines run up to the first blank line, each split at its first ':' and
  trimmed; ``WARC-Type``, ``WARC-Date``, ``WARC-Record-ID`` and ``Content-Type``
  are lifted into columns, every other key goes to ``metadata`` (a line without
  ':' is a key with an empty value; ``Content-Length`` is not repeated there);
* ``Content-Length`` gives the body's bytes.  Where it is missing, no number or
  over ``MAX_BODY``, the record comes out with an ``error`` and no body, and reading
  goes on at the next version mark; a body cut off by the end of the file keeps
  what came and says so in ``error``;
* a file without any record yields one row that says so.

``read_warc_split`` reads archives of many gzip members by byte ranges, so that one
large archive is the work of many tasks (see ``gzip_members``); a record's place is then the
``offset`` of its member and its number from there.

The body is bytes; ``response_pages`` decodes it by the declared charset (UTF-8
without one, or where it is unknown), with replacement characters for what does
not fit, and gives the charset beside it.
"""

from __future__ import annotations

import gzip
import io

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.sources.gzip_members import runs

# Fixed values of the archive format.
WARC_MARK = b"WARC/"
LIFTED_KEYS = ("WARC-Type", "WARC-Date", "WARC-Record-ID", "Content-Type")

RECORD_SCHEMA = ("file_name string, record_no int, type string, date string, record_id string, "
                 "content_type string, metadata map<string,string>, content binary, content_length int, error string")

#: Rows, or bytes of content, that are handed on at a time.
BATCH_ROWS, BATCH_BYTES = 256, 16 << 20
#: Longer bodies don't fit a row (2 GB) and are reported instead.
MAX_BODY = 1 << 30
#: Bytes of an archive that one task reads.
SPLIT_BYTES = 128 << 20


_COLUMN = dict(zip(LIFTED_KEYS, ("type", "date", "record_id", "content_type")))


def _header(stream) -> tuple[dict, str | None]:
    """The record's columns from its header lines, and the length as written."""
    rec = {"type": None, "date": None, "record_id": None, "content_type": None, "metadata": {}, "content": None,
           "content_length": None, "error": None}
    length = None
    for raw in iter(stream.readline, b""):
        line = raw.decode("utf-8", errors="replace").strip()
        if not line:
            break
        key, colon, value = (x.strip() for x in line.partition(":"))
        if colon and key == "Content-Length":
            length = value if length is None else length
        elif colon and key in _COLUMN:
            rec[_COLUMN[key]] = value
        elif key not in _COLUMN:
            rec["metadata"][key] = value
    return rec, length


def _body(stream, length: int) -> bytes:
    """Up to ``length`` bytes; memory follows what comes, not what the header says."""
    body = bytearray()
    while len(body) < length and (part := stream.read(min(length - len(body), 1 << 20))):
        body += part
    return bytes(body)


def iter_warc_records(stream):
    """Yields a dict for each record of a binary stream (already decompressed)."""
    found = False
    for raw in iter(stream.readline, b""):
        if not raw.startswith(WARC_MARK):
            continue
        found = True
        rec, length = _header(stream)
        if length is None or not length.isascii() or not length.isdigit():
            rec["error"] = "no Content-Length" if length is None else f"bad Content-Length: {length}"
        elif len(length) > 18 or int(length) > MAX_BODY:
            rec["error"] = f"Content-Length over {MAX_BODY}: {length[:40]}"
        else:
            rec["content"] = _body(stream, int(length))
            rec["content_length"] = len(rec["content"])
            if len(rec["content"]) < int(length):
                rec["error"] = f"body ends after {len(rec['content'])} of {length} bytes"
        yield rec
    if not found:
        yield {"type": None, "date": None, "record_id": None, "content_type": None, "metadata": {}, "content": None,
               "content_length": None, "error": "no record"}


def record_batches(path: str, stream):
    """Frames of an archive's records, bounded in rows and bytes; closes the stream."""
    name, rows, size = path.rsplit("/", 1)[-1], [], 0
    try:
        for i, rec in enumerate(iter_warc_records(stream)):
            rows.append(rec | {"file_name": name, "record_no": i})
            size += len(rec["content"] or b"")
            if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                yield pd.DataFrame(rows)
                rows, size = [], 0
    finally:
        stream.close()
    if rows:
        yield pd.DataFrame(rows)


class _RawStream(io.RawIOBase):
    """File-like adapter over a pyarrow input stream (for BufferedReader)."""

    def __init__(self, native):
        self._s = native

    def readable(self):
        return True

    def readinto(self, buf):
        data = self._s.read(len(buf))
        n = len(data)
        buf[:n] = data
        return n

    def close(self):
        self._s.close()
        super().close()


def _open_path(path: str):
    import pyarrow.fs as pfs
    fs, p = pfs.FileSystem.from_uri(path)
    native = fs.open_input_stream(p, compression="detect")   # '.gz' -> gunzip on the fly
    return io.BufferedReader(_RawStream(native), buffer_size=1 << 20)


def _batched(rows):
    """Frames of rows, bounded in rows and bytes."""
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += len(row["content"] or b"")
        if len(some) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield pd.DataFrame(some)
            some, size = [], 0
    if some:
        yield pd.DataFrame(some)


def split_records(path: str, start: int, end: int):
    """Yields the records of the gzip members that begin in bytes [start, end) of an archive.
    An archive that is no gzip file is read whole by the range that begins at 0."""
    import pyarrow.fs as pfs
    fs, p = pfs.FileSystem.from_uri(path)
    name = path.rsplit("/", 1)[-1]
    with fs.open_input_file(p) as file:
        if file.read(2) != b"\x1f\x8b":
            if start == 0:
                file.seek(0)
                for i, rec in enumerate(iter_warc_records(io.BufferedReader(_RawStream(file), buffer_size=1 << 20))):
                    yield rec | {"file_name": name, "record_no": i, "offset": 0}
            return
        for run, stream in runs(file, start, end, WARC_MARK):
            i = -1
            for i, rec in enumerate(iter_warc_records(stream)):
                yield rec | {"file_name": name, "record_no": i, "offset": run.start}
            run.finish()
            if run.damage:
                yield dict.fromkeys(_COLUMN.values()) | {
                    "file_name": name, "record_no": i + 1, "offset": run.start, "metadata": {}, "content": None,
                    "content_length": None, "error": f"archive damaged at byte {run.at}: {run.damage}"}


def read_warc_split(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True,
                    split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of every archive under ``path``, each archive read by ranges of
    ``split_bytes`` (schema ``RECORD_SCHEMA`` and ``offset long``)."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    ranges = r.load(path).filter("length > 0").select(
        "path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    ranges = ranges.repartition(max(ranges.count(), 1))

    def parse(batches):
        for pdf in batches:
            for p, start in zip(pdf["path"], pdf["start"]):
                yield from _batched(split_records(p, int(start), int(start) + split_bytes))

    schema = RECORD_SCHEMA + ", offset long"
    return ranges.mapInPandas(parse, schema).select(*[c.split()[0] for c in schema.split(", ")])


def _open(path: str, content: bytes):
    raw = io.BytesIO(content)
    if path.endswith(".gz") or content[:2] == b"\x1f\x8b":
        return io.BufferedReader(gzip.GzipFile(fileobj=raw))
    return raw


def read_warc(spark: SparkSession, path: str, glob: str | None = None,
              recursive: bool = True, stream: bool = True) -> DataFrame:
    """Records of every archive under ``path`` (schema ``RECORD_SCHEMA``)."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    files = r.load(path).select("path", *([] if stream else ["content"]))

    def parse(batches):
        for pdf in batches:
            contents = pdf["content"] if "content" in pdf else [None] * len(pdf)
            for p, content in zip(pdf["path"], contents):
                yield from record_batches(p, _open_path(p) if content is None else _open(p, content))

    cols = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
    return files.mapInPandas(parse, RECORD_SCHEMA).select(*cols)


def manifest_paths(spark: SparkSession, path: str) -> DataFrame:
    """(path): the archive paths named by manifest files, one a line; blank lines skipped."""
    return spark.read.text(path).select(F.trim("value").alias("path")).filter("path <> ''")


def read_warc_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Records of every archive that the manifests under ``path`` name.  Each
    archive is one task's work, as with ``read_warc``."""
    paths = manifest_paths(spark, path)
    paths = paths.repartition(max(paths.count(), 1), "path")

    def parse(batches):
        for pdf in batches:
            for p in pdf["path"]:
                yield from record_batches(p, _open_path(p if "://" in p or p.startswith("file:") else f"file://{p}"))

    cols = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
    return paths.mapInPandas(parse, RECORD_SCHEMA).select(*cols)


def text_of(content) -> F.Column:
    """Bytes as UTF-8 text; what is not UTF-8 becomes replacement characters."""
    return F.make_valid_utf8(F.col(content).cast("string"))


def declared_charset(content) -> F.Column:
    """The charset a page names in its HTTP header or markup, lower-cased; null without one."""
    found = F.lower(F.regexp_extract(text_of(content), r"(?i)charset\s*=\s*[\"']?([a-z0-9_:.\-]+)", 1))
    return F.when(found != "", found)


# Labels that the web's encoding rules read as another charset (fixed values).
CHARSET_ALIASES = {"iso-8859-1": "cp1252", "latin1": "cp1252", "us-ascii": "cp1252", "ascii": "cp1252", "gb2312": "gbk",
                   "shift_jis": "cp932", "sjis": "cp932", "x-sjis": "cp932", "euc-kr": "cp949", "ks_c_5601-1987": "cp949"}


def _decode(content: pd.Series, charset: pd.Series) -> pd.Series:
    def one(body, name):
        if body is None or name is None:
            return None
        try:
            text = bytes(body).decode(CHARSET_ALIASES.get(name, name), errors="replace")
            return text.encode("utf-8", errors="replace").decode("utf-8")
        except (LookupError, ValueError):   # no such charset
            return None
    return pd.Series([one(b, c) for b, c in zip(content, charset)], dtype=object)


def page_text(content) -> F.Column:
    """Bytes as text by their declared charset; only bodies that declare another one than
    UTF-8 leave the JVM."""
    charset = declared_charset(content)
    foreign = charset.isNotNull() & ~charset.isin("utf-8", "utf8")
    decode = F.pandas_udf(_decode, "string")
    return F.coalesce(decode(F.when(foreign, F.col(content)), F.when(foreign, charset)), text_of(content))


def response_pages(records: DataFrame) -> DataFrame:
    """(trec_id, uri, html, charset) of response records (type equals 'response')."""
    return records.filter((F.col("type") == "response") & F.col("content").isNotNull()).select(
        F.col("metadata")["WARC-TREC-ID"].alias("trec_id"),
        F.col("metadata")["WARC-Target-URI"].alias("uri"),
        page_text("content").alias("html"), declared_charset("content").alias("charset"))
