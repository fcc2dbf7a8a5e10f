"""Archives of many gzip members, read by byte ranges."""

import gzip
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from webloom.sinks.text import write_archives
from webloom.sources import gzip_members as G
from webloom.sources import warc as W


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)


def _record(i, body):
    return f"WARC/1.0\r\nWARC-Type: response\r\nWARC-TREC-ID: t{i}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def _write(folder, name, parts):
    with open(os.path.join(folder, name), "wb") as fh:
        fh.write(b"".join(parts))


def _bodies(n, seed=1):
    r = random.Random(seed)
    return [r.randbytes(r.choice([0, 1, 30, 700, 5000])) for _ in range(n)]


def _split(data, size):
    """The runs of all ranges, as (offset, bytes)."""
    return [(run.start, reader.read()) for at in range(0, len(data), size)
            for run, reader in G.runs(io.BytesIO(data), at, at + size, b"WARC/")]


@pytest.mark.parametrize("size", [1, 7, 100, 1000, 10 ** 9])
def test_every_run_belongs_to_one_range(size):
    n = 12 if size < 100 else 60
    members = [gzip.compress(_record(i, b)) for i, b in enumerate(_bodies(n))]
    data = b"".join(members)
    got = _split(data, size)
    assert [g for _, g in got] == [gzip.decompress(m) for m in members]
    assert [at for at, _ in got] == [sum(map(len, members[:i])) for i in range(n)]


@pytest.mark.parametrize("size", [3, 64, 10 ** 9])
def test_members_that_continue_a_record(size):
    whole = _record(0, b"x" * 300) + _record(1, b"y" * 300)
    data = gzip.compress(whole[:100]) + gzip.compress(b"") + gzip.compress(whole[100:]) + b"\0" * 9 + gzip.compress(_record(2, b"z"))
    assert [g for _, g in _split(data, size)] == [whole, _record(2, b"z")]


def _rows(df):
    return [(r.metadata.get("WARC-TREC-ID"), r.content and bytes(r.content), r.error)
            for r in df.orderBy("file_name", "offset", "record_no").collect()]


def test_one_archive_is_read_by_many_tasks(spark, scratch):
    bodies = _bodies(400)
    _write(scratch, "a.warc.gz", [gzip.compress(_record(i, b)) for i, b in enumerate(bodies)])
    got = W.read_warc_split(spark, scratch, split_bytes=20_000)
    assert _rows(got) == [(f"t{i}", b, None) for i, b in enumerate(bodies)]
    assert got.select(F.spark_partition_id()).distinct().count() > 8
    whole = W.read_warc(spark, scratch)
    assert sorted(r.metadata["WARC-TREC-ID"] for r in whole.collect()) == sorted(f"t{i}" for i in range(400))


def test_one_member_plain_and_empty_files(spark, scratch):
    _write(scratch, "a.warc.gz", [gzip.compress(_record(0, b"one") + _record(1, b"two"))])
    _write(scratch, "b.warc", [_record(2, b"three")])
    _write(scratch, "c.warc.gz", [])
    _write(scratch, "d.warc.gz", [gzip.compress(b"no archive at all")])
    assert _rows(W.read_warc_split(spark, scratch, split_bytes=10)) == [
        ("t0", b"one", None), ("t1", b"two", None), ("t2", b"three", None), (None, None, "no record")]


@pytest.mark.parametrize("length", ["999999999999", "9" * 5000])
def test_an_absurd_length_is_bounded_and_reported(spark, scratch, length):
    bad = _record(1, b"lost").replace(b"Content-Length: 4", b"Content-Length: " + length.encode())
    members = [gzip.compress(m) for m in (_record(0, b"one"), bad, _record(2, b"two"))]
    _write(scratch, "a.warc.gz", members)
    want = [("t0", b"one", None), ("t1", None, f"Content-Length over {W.MAX_BODY}: {length[:40]}"), ("t2", b"two", None)]
    assert _rows(W.read_warc_split(spark, scratch, split_bytes=50)) == want
    whole = W.read_warc(spark, scratch).orderBy("record_no").collect()
    assert [(r.metadata["WARC-TREC-ID"], r.content and bytes(r.content), r.error) for r in whole] == want


def test_a_body_ends_with_its_member(spark, scratch):
    long = _record(0, b"one").replace(b"Content-Length: 3", b"Content-Length: 5000")
    _write(scratch, "a.warc.gz", [gzip.compress(long), gzip.compress(_record(1, b"two"))])
    assert _rows(W.read_warc_split(spark, scratch)) == [("t0", b"one\r\n\r\n", "body ends after 7 of 5000 bytes"), ("t1", b"two", None)]


def test_damage_costs_the_member_it_is_in(spark, scratch):
    members = [gzip.compress(_record(i, b"body %d " % i * 50)) for i in range(4)]
    broken = bytearray(members[1])
    broken[len(broken) // 2] ^= 0xFF
    _write(scratch, "a.warc.gz", [members[0], bytes(broken), members[2], b"junk", members[3][:-9]])
    rows = _rows(W.read_warc_split(spark, scratch, split_bytes=64))
    whole = [r[0] for r in rows if r[2] is None]
    assert "t0" in whole and "t2" in whole
    assert sum("archive damaged at byte" in (r[2] or "") for r in rows) == 3


@pytest.mark.parametrize("charset,codec", [("gb2312", "gbk"), ("Shift_JIS", "cp932"), ("windows-1251", "cp1251"), ("EUC-KR", "cp949"),
                                           ("no-such-charset", "utf-8"), ("utf-8", "utf-8"), ("rot13", "utf-8")])
def test_declared_charsets(spark, scratch, charset, codec):
    text = {"gbk": "中文", "cp932": "日本語", "cp1251": "Привет", "cp949": "한국어"}.get(codec, "é中")
    body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset={charset}\r\n\r\n<p>".encode() + text.encode(codec)
    _write(scratch, "a.warc.gz", [gzip.compress(_record(0, body))])
    (page,) = W.response_pages(W.read_warc_split(spark, scratch)).collect()
    assert page.html.endswith("<p>" + text) and page.charset == charset.lower()


def test_write_archives(spark, scratch):
    texts = [_record(i, b"b%d" % i).decode() for i in range(50)] + [None]
    path = os.path.join(scratch, "out")
    df = spark.createDataFrame([(t,) for t in texts], "value string").repartition(3)
    assert write_archives(df, path) == 3 and write_archives(df, path) == 3
    assert sorted(os.listdir(path)) == [f"part-0000{i}.warc.gz" for i in range(3)]
    assert W.read_warc_split(spark, path, split_bytes=100).count() == 50
    assert write_archives(df.limit(0), os.path.join(scratch, "none")) == 0
