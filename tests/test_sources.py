import gzip
import os

import pytest
from pyspark.sql import functions as F

from webloom.operators import external as EX
from webloom.operators import stats as ST
from webloom.sources import files as FS
from webloom.sources import text as SRC
from webloom.sources import warc as W


def write(path, text):
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_numbers_population_std(spark, scratch):
    p = write(os.path.join(scratch, "n.txt"), "1\n2\n3\n4")
    r = ST.stats_global(SRC.read_numbers(spark, p)).first()
    assert (r["max"], r["min"], r["avg"], r["n"]) == (4.0, 1.0, 2.5, 4)
    assert r["std_dev"] == pytest.approx(1.118033988749895)  # population, not 1.29 (sample)


def test_numbers_bad_line(spark, scratch):
    p = write(os.path.join(scratch, "bad.txt"), "1\nx\n3\n")
    with pytest.raises(Exception):
        SRC.read_numbers(spark, p).collect()
    assert SRC.read_numbers(spark, p, lenient=True).filter("value IS NULL").count() == 1


def test_empty_input_gives_one_null_row(spark):
    r = ST.stats_global(spark.createDataFrame([], "value double")).first()
    assert r["max"] is None and r["n"] == 0


def test_id_map_and_rank_pairs(spark, scratch):
    m = write(os.path.join(scratch, "map.txt"), "  clueweb09-en0000-01-00001\t7 \n\nclueweb09-en0000-01-00002\t8\n")
    r = write(os.path.join(scratch, "ranks.txt"), "2\n7 0.25\n8 0.5\n")
    assert sorted((x.trec_id, x.node_id) for x in SRC.read_id_map(spark, m).collect()) == [
        ("clueweb09-en0000-01-00001", 7), ("clueweb09-en0000-01-00002", 8)]
    assert sorted(map(tuple, SRC.read_rank_pairs(spark, r).collect())) == [(7, 0.25), (8, 0.5)]


def test_read_hits(spark, scratch):
    row = "BG3:2_30MNAAAXX:7:1:790:1361/1\tgi|297846028|ref|XP_002890895.1|\t100.00\t12\t0\t0\t37\t2\t61\t72\t0.31\t32.3\n"
    p = write(os.path.join(scratch, "celllines_1.fa"), row * 3)
    h = SRC.read_hits(spark, p).collect()
    assert len(h) == 3 and h[0].q_start == 37 and h[0].q_end == 2 and h[0].bit_score == 32.3
    assert h[0].file_name == "celllines_1.fa"


def _record(kind, uri, body):
    b = body.encode()
    return (f"WARC/0.18\nWARC-Type: {kind}\nWARC-Target-URI: {uri}\nWARC-TREC-ID: clueweb09-en0000-00-00001\n"
            f"NoColonLine\nContent-Length: {len(b)}\n\n").encode() + b + b"\n\n"


def test_read_warc(spark, scratch):
    body = "HTTP/1.1 200 OK\nContent-Length: 20\n\n<html><p>héllo</p></html>"
    data = (b"junk before\n" + _record("warcinfo", "", "info") + _record("response", "http://x.org/", body)
            + b"WARC/0.18\nWARC-Type: response\nContent-Length: oops\n\nlost")
    with gzip.open(os.path.join(scratch, "a.warc.gz"), "wb") as fh:
        fh.write(data)
    recs = W.read_warc(spark, scratch, glob="*.warc.gz").orderBy("record_no").collect()
    assert [r.type for r in recs] == ["warcinfo", "response", "response"]
    assert recs[2].error == "bad Content-Length: oops" and recs[2].content is None and recs[0].error is recs[1].error is None
    r = recs[1]
    assert r.metadata["WARC-Target-URI"] == "http://x.org/" and r.metadata["NoColonLine"] == ""
    assert "Content-Length" not in r.metadata and r.content_length == len(body.encode())
    pages = W.response_pages(W.read_warc(spark, scratch, glob="*.warc.gz")).collect()
    assert len(pages) == 1 and pages[0].html == body
    in_memory = W.read_warc(spark, scratch, glob="*.warc.gz", stream=False).orderBy("record_no").collect()
    assert [tuple(r) for r in in_memory] == [tuple(r) for r in recs]


def test_scan_and_pipe_files(spark, scratch):
    for i in range(3):
        write(os.path.join(scratch, f"in{i}.fa"), ">s\nACGT" * (i + 1))
    files = FS.scan_files(spark, scratch, glob="*.fa", with_content=True)
    assert sorted(r.file_name for r in files.select("file_name").collect()) == ["in0.fa", "in1.fa", "in2.fa"]
    res = {r.file_name: r for r in EX.pipe_files(files, "cat #_INPUTFILE_# > #_OUTPUTFILE_#").collect()}
    assert res["in1.fa"].exit_code == 0 and res["in1.fa"].output == ">s\nACGT" * 2
    bad = EX.pipe_files(files, "exit 3").collect()
    assert all(r.exit_code == 3 for r in bad)
    with pytest.raises(Exception):
        EX.pipe_files(files, "exit 3", fail_on_error=True).collect()


def test_stats_report_formats(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "value double")
    st = ST.stats_global(df)
    assert ST.stats_report(st).first()[0] == "Max: 4.0\tMin: 1.0\tAvg: 2.5\tStdDev: 1.118033988749895"
    assert ST.stats_report(st, leading_tab=True).first()[0].startswith("\tMax: 4.0\t")
    assert ST.stats_report(st, digits=2).first()[0] == "Max: 4.00\tMin: 1.00\tAvg: 2.50\tStdDev: 1.12"


def test_a_bad_record_does_not_end_the_archive(spark, scratch):
    bad = b"WARC/0.18\nWARC-Type: response\nWARC-TREC-ID: b\n\nlost body\n"
    data = _record("response", "http://x.org/1", "one") + bad + _record("response", "http://x.org/2", "two")
    cut = _record("response", "http://x.org/3", "three").replace(b"Content-Length: 5", b"Content-Length: 50")
    with gzip.open(os.path.join(scratch, "a.warc.gz"), "wb") as fh:
        fh.write(data + cut)
    with gzip.open(os.path.join(scratch, "b.warc.gz"), "wb") as fh:
        fh.write(b"no archive at all")
    recs = W.read_warc(spark, scratch).orderBy("file_name", "record_no").collect()
    assert [(r.content and bytes(r.content), r.error) for r in recs] == [
        (b"one", None), (None, "no Content-Length"), (b"two", None), (b"three\n\n", "body ends after 7 of 50 bytes"), (None, "no record")]


def test_other_versions_and_charsets(spark, scratch):
    body = "HTTP/1.1 200 OK\nContent-Type: text/html; charset=ISO-8859-1\n\n<p>caf\u00e9</p>".encode("latin-1")
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-TREC-ID: t\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    with open(os.path.join(scratch, "a.warc"), "wb") as fh:
        fh.write(head + body + b"\r\n\r\n")
    (page,) = W.response_pages(W.read_warc(spark, scratch)).collect()
    assert page.charset == "iso-8859-1" and page.html.endswith("<p>caf\u00e9</p>") and page.trec_id == "t"


def test_archives_by_manifest(spark, scratch):
    for i in range(3):
        with gzip.open(os.path.join(scratch, f"{i}.warc.gz"), "wb") as fh:
            fh.write(_record("response", f"http://x.org/{i}", "b"))
    write(os.path.join(scratch, "warcPaths_0.txt"), f"{scratch}/0.warc.gz\n\n file:{scratch}/2.warc.gz \n")
    recs = W.read_warc_manifests(spark, os.path.join(scratch, "warcPaths_0.txt")).collect()
    assert sorted(r.file_name for r in recs) == ["0.warc.gz", "2.warc.gz"]


def test_last_mapping_wins_over_files_and_splits(spark, scratch):
    # The earlier file is the larger one: packed first into a split, it must not win.
    write(os.path.join(scratch, "a.txt"), "k\t1\n" + "x\t5\n" * 5000)
    write(os.path.join(scratch, "b.txt"), "k\t2\nk\t3000000000\n")
    from webloom.operators.search import doc_rank_load
    none = spark.createDataFrame([], "node_id long, rank double")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("4096", old):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            m = SRC.read_id_map(spark, scratch).cache()
            got = {r.doc_id: r.node_id for r in doc_rank_load(m.withColumn("trec_id", F.concat(F.lit("en"), F.ascii("trec_id").cast("string"))),
                                                              none, "line_no").collect()}
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        assert got == {"107": 3000000000, "120": 5}


def test_vector_ids_do_not_depend_on_splits(spark, scratch):
    write(os.path.join(scratch, "v.csv"), "".join(f"{i % 50},{i % 3}.5\n" for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    one = sorted(map(str, SRC.read_vectors(spark, scratch).collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        many = sorted(map(str, SRC.read_vectors(spark, scratch).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert one == many and len(set(one)) == 3000


def test_keys_stay_unique_beyond_their_width(spark):
    from webloom.functions.text import doc_key
    from webloom.plans import inputs as I
    ids = [12345, 123450, 123451, 10 ** 8, 10 ** 8 + 1, 2345678912, 2 ** 63 - 1]
    d = spark.createDataFrame([(i, f"src{s}") for i in ids for s in (1, 11, 12345)], "doc_id long, source string")
    assert d.select(doc_key(I.trec_id(d))).distinct().count() == d.count()
    p = spark.range(200_000).select((F.col("id") * 7919).alias("page_id"))
    assert p.select(doc_key(I.page_trec_id(p))).distinct().count() == 200_000
