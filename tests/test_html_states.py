"""Pages as literals, with the text nodes that the public HTML tokenizer's states give."""

import time

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from webloom.functions.html import html_to_text
from webloom.plans.oracle import html_text_sql

PAGES = [
    # quotes in tags
    ('<a title="1 > 0">x</a>', "x\n"), ("<a title='1 > 0'>x</a>", "x\n"), ('<a title = "a>b" href=c>x', "x\n"),
    ('<a title="it\'s > all">x', "x\n"), ('<a title=a"b>c', "c\n"), ('<img alt="a>b"/>x', "x\n"), ("<a b'c>d'>e", "d'>e\n"),
    ('<a href=/x/>y', "y\n"), ('<a b="c"d=">">x', "x\n"), ('<p a==">b">c', 'b">c\n'), ('</p a=">">x', "x\n"),
    # cut off by the end of the page
    ('x<a title="never closed>y', "x\n"), ("x<b", "x\n"), ("x<!-- never closed --y", "x\n"), ("x<!doctype", "x\n"), ("x</b", "x\n"),
    ("x<", "x\n<\n"), ("x</", "x\n<\n/\n"),
    # raw text and text without tags
    ('<script type="a>b">if (a < b) { "</p>" }</script>x', 'if (a < b) { "</p>" }\nx\n'), ("<SCRIPT>a</ScRiPt >x", "a\nx\n"),
    ("<script>a</scripty>b</script>x", "a</scripty>b\nx\n"), ("<scripty>a</scripty>x", "a\nx\n"), ("<script>&amp;</script>", "&amp;\n"),
    ("<title>a <b>c</b> &amp; d</title>x", "a <b>c</b> & d\nx\n"), ("<textarea><p>a</textarea>x", "<p>a\nx\n"),
    ("<iframe><b>a</b></iframe>x", "<b>a</b>\nx\n"), ("<script/>a</script>x", "a\nx\n"), ("<title>open", "open\n"),
    # comments and what is read as one
    ("<!-->a<!-- b --!>c<!-- d > e -->f", "a\nc\nf\n"), ("<!--->a", "a\n"), ("<!doctype html><p>a", "a\n"), ("<?xml a?>b", "b\n"),
    ("</ a>b</>c", "b\nc\n"), ("<![CDATA[a]]>b", "b\n"), ("a<3 b<c>d", "a\n<\n3 b\nd\n"),
    # references without semicolon
    ("&copy 2024 &ltb&gt &AMP&amp", "© 2024 <b> &&\n"), ("&notit; &notin; &ampx;", "¬it; ∉ &x;\n"), ("&hellip &euro", "&hellip &euro\n"),
    ("&#65 &#x42b &#67;", "A Ы C\n"), ("&#150;&#x93;&#129;|", "–“\x81|\n"), ("a&b &unknown; &", "a&b &unknown; &\n"),
]


@pytest.fixture(scope="module")
def got(spark):
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(PAGES)], "i int, h string")
    return {r[0]: r[1] for r in df.select("i", html_to_text("h")).collect()}


@pytest.mark.parametrize("i", range(len(PAGES)), ids=[repr(p[0]) for p in PAGES])
def test_pages(got, i):
    assert got[i] == PAGES[i][1]


PARTS = ["<", ">", "/", "</", "<a ", "<p>", "</p>", "=", '"', "'", " ", "\n", "-", "!", "<!--", "-->", "--!>", "<script>", "</script>",
         "<title>", "</title ", "<style ", "</style>", "x", "&amp", "&amp;", "&lt", ";", "?", "&#65", "<iframe/", "</iframe>"]


@settings(max_examples=50, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=25).map("".join), min_size=1, max_size=30))
def test_equals_sql(spark, pages):
    rows = spark.createDataFrame([(p,) for p in pages], "h string").select(html_to_text("h")).collect()
    want = duckdb.connect().execute(
        f"SELECT {html_text_sql('h')} FROM (SELECT unnest(?::VARCHAR[]) AS h, generate_subscripts(?::VARCHAR[], 1) AS i) ORDER BY i",
        [pages, pages]).fetchall()
    assert [r[0] for r in rows] == [r[0] for r in want]


@pytest.mark.parametrize("html", ["<a " * 100_000, '<a b="' + ">" * 300_000, "<a " + "b=c " * 100_000 + ">x", "<script>" + "</script" * 50_000,
                                  "<!--" + "-" * 300_000, "<" * 300_000, "<p>" + "x &amp " * 50_000, "</" * 100_000])
def test_very_long_pages_are_linear(spark, html):
    df = spark.createDataFrame([(html,)], "h string").select(html_to_text("h"))
    begin = time.monotonic()
    df.collect()
    assert time.monotonic() - begin < 30
