import gzip
import os

import pytest

from webloom.streaming.ingest import compact, current_pages, current_postings, get_page, start_ingest


def _record(trec, uri, html):
    body = f"HTTP/1.1 200 OK\nContent-Length: {len(html.encode())}\n\n{html}".encode()
    head = (f"WARC/0.18\nWARC-Type: response\nWARC-Target-URI: {uri}\nWARC-TREC-ID: {trec}\n"
            f"Content-Length: {len(body)}\n\n").encode()
    return head + body + b"\n\n"


def ingest(spark, tmp_path, name, records):
    src = tmp_path / "in"
    src.mkdir(exist_ok=True)
    with gzip.open(src / name, "wb") as fh:
        for r in records:
            fh.write(r)
    pages, post, ck = (str(tmp_path / n) for n in ("pages", "postings", "ck"))
    start_ingest(spark, str(src), pages, post, ck, trigger_once=True).awaitTermination(120)
    return pages, post


def trec(i):
    return f"clueweb09-en0000-00-{i:05d}"


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_latest_version_of_a_page_wins(spark, tmp_path):
    ingest(spark, tmp_path, "a.warc.gz", [_record(trec(1), "http://a.org/", "<p>alpha beta</p>"), _record(trec(2), "http://b.org/", "<p>gamma</p>")])
    pages, post = (str(tmp_path / n) for n in ("pages", "postings"))
    got = {r.doc_id: r.content for r in current_pages(spark, pages).collect()}
    assert got == {"00000000001": "alpha beta\n", "00000000002": "gamma\n"}
    before = files(pages) | files(post)
    # A re-crawl of both pages adds files and changes none.
    ingest(spark, tmp_path, "b.warc.gz", [_record(trec(1), "http://a.org/", "<p>delta</p>"), _record(trec(2), "http://b.org/", "<p></p>")])
    after = files(pages) | files(post)
    assert before.items() < after.items()
    got = {r.doc_id: r.content for r in current_pages(spark, pages).collect()}
    assert got == {"00000000001": "delta\n", "00000000002": ""}
    assert [r.content for r in get_page(spark, pages, "00000000001").collect()] == ["delta\n"]
    terms = sorted((r.doc_id, r.term) for r in current_postings(spark, post, pages).collect())
    assert terms == [("00000000001", "delta")]  # earlier terms of both pages are gone
    compact(spark, pages, post, str(tmp_path / "p2"), str(tmp_path / "i2"))
    assert {r.doc_id: r.content for r in current_pages(spark, str(tmp_path / "p2")).collect()} == got
    assert sorted((r.doc_id, r.term) for r in current_postings(spark, str(tmp_path / "i2"), str(tmp_path / "p2")).collect()) == terms


def test_unreadable_old_files_lose_nothing(spark, tmp_path):
    pages, _ = ingest(spark, tmp_path, "a.warc.gz", [_record(trec(i), f"http://p{i}.org/", f"<p>w{i}</p>") for i in range(5)])
    (broken,) = [f for f in files(pages)][:1]
    whole = open(broken, "rb").read()
    with open(broken, "wb") as fh:
        fh.write(b"not parquet")
    ingest(spark, tmp_path, "b.warc.gz", [_record(trec(3), "http://p3.org/", "<p>changed</p>")])
    with pytest.raises(Exception):
        current_pages(spark, pages).collect()  # told, not hidden
    with open(broken, "wb") as fh:
        fh.write(whole)
    crc = os.path.join(os.path.dirname(broken), f".{os.path.basename(broken)}.crc")
    if os.path.exists(crc):
        spark.catalog.refreshByPath(pages)
    got = {r.doc_id: r.content for r in current_pages(spark, pages).collect()}
    assert len(got) == 5 and got["00000000003"] == "changed\n" and got["00000000004"] == "w4\n"


def test_pages_that_are_not_utf8(spark, tmp_path):
    latin = "<p>caf\u00e9</p>".encode("latin-1")
    head = f"WARC/0.18\nWARC-Type: response\nWARC-Target-URI: http://l.org/\nWARC-TREC-ID: {trec(1)}\nContent-Length: {len(latin)}\n\n"
    pages, _ = ingest(spark, tmp_path, "a.warc.gz", [head.encode() + latin + b"\n\n", _record(trec(2), "http://b.org/", "<p>gamma</p>")])
    got = {r.doc_id: r.content for r in current_pages(spark, pages).collect()}
    assert got == {"00000000001": "caf\ufffd\n", "00000000002": "gamma\n"}
