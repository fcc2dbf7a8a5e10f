"""Literal cases with expected values written by hand; no library pattern is imported."""

import pytest
from pyspark.sql import functions as F

from webloom.functions.html import html_to_text, resolve_url, unescape
from webloom.functions.text import tokenize
from webloom.operators.pages import outlinks


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{c} string" for c in cols))
    return df.select(expr).first()[0]


RESOLVE = [  # base, link, expected
    ("http://h/a.html", "x.html", "http://h/x.html"), ("http://h/a.html", "../x.html", "http://h/x.html"),
    ("http://h/a.html", "../../x", "http://h/x"), ("http://h/a/b/c/d/e.html", "../../../../x.html", "http://h/x.html"),
    ("http://h/a/b/c/d/e.html", "../../../../../../x.html", "http://h/x.html"), ("http://h/a/b/c.html", "./x", "http://h/a/b/x"),
    ("http://h/a/b/c.html", "./././x", "http://h/a/b/x"), ("http://h/a/b/c.html", "../x", "http://h/a/x"),
    ("http://h/a/b/c.html", "d/../x", "http://h/a/b/x"), ("http://h/a/b/c.html", "d/./e/../../x/y", "http://h/a/b/x/y"),
    ("http://h/a/b/c.html", "..", "http://h/a/"), ("http://h/a/b/c.html", ".", "http://h/a/b/"),
    ("http://h/a/b/", "x/", "http://h/a/b/x/"), ("http://h", "x", "http://h/x"), ("http://h", "../x", "http://h/x"),
    ("http://h/a/b", "/x", "http://h/x"), ("https://h/a/b", "//o/x", "https://o/x"), ("http://h/a/b", "https://o/x", "https://o/x"),
    ("http://h/a/b?q=1", "#f", "http://h/a/b?q=1#f"), ("http://h/a/b", "x?y=1", "http://h/a/x"), ("http://h/a/b?q=1", "?y", "http://h/a/b?y"),
    ("http://h:8080/a/b", "x", "http://h:8080/a/x"), ("http://h/a/b", "../x#f/../g", "http://h/x#f/../g"), ("http://h/a//b", "x", "http://h/a//x"),
    ("http://h/a/b", "x y", "x y")]


@pytest.mark.parametrize("base,link,want", RESOLVE)
def test_resolve(spark, base, link, want):
    assert one(spark, resolve_url("b", "l"), b=base, l=link) == want


@pytest.mark.parametrize("text,want", [
    ("caf&eacute; &uuml;ber &euro;5", "café über €5"), ("&#00000039;&#x0000000027;", "''"), ("&amp;lt; &#38;amp; &amp;#38;", "&lt; &amp; &#38;"),
    ("a & b &; &nosuch; &#; &#x;", "a & b &; &nosuch; &#; &#x;"), ("&#55296; &#1114112; &#99999999999;", "&#55296; &#1114112; &#99999999999;"),
    ("&#x1F600;&#8217;", "\U0001F600’"), ("&lt;&gt;&quot;&apos;", "<>\"'"), ("none", "none"), ("", "")])
def test_character_references(spark, text, want):
    assert one(spark, unescape("t"), t=text) == want


@pytest.mark.parametrize("html,keep,want", [
    ("<p>a</p><p>b &amp; c</p>", True, "a\nb & c\n"), ("<script>var x='</p>';</script>y", True, "var x='</p>';\ny\n"),
    ("<script>var x;</script>y", False, "y\n"), ("x<script>never closed <p>z", False, "x\n"), ("x<STYLE>never closed", False, "x\n"),
    ("x<script>never closed", True, "x\nnever closed\n"), ("<!-- c --><b> t </b>", True, "t\n"), ("", True, ""), ("a < b", True, "a\n<\nb\n")])
def test_html_text(spark, html, keep, want):
    assert one(spark, html_to_text("h", keep), h=html) == want


@pytest.mark.parametrize("text,want", [
    ("The quick_brown fox's U.S.A. 3.14 1,000 a:b", ["the", "quick_brown", "fox's", "u.s.a", "3.14", "1,000", "a:b"]),
    ("a-b a,b 1.a a.1 '' ___ _x", ["a", "b", "a", "b", "1", "a", "a", "1", "_x"]), ("", []), ("Ünïcode ÉTÉ", ["ünïcode", "été"])])
def test_tokens(spark, text, want):
    assert one(spark, tokenize("t"), t=text) == want


@pytest.mark.parametrize("joined", [",".join("7" * 100_000), ".".join("a" * 50_000), "x" * 200_000])
def test_very_long_tokens_stay_whole(spark, joined):
    assert one(spark, F.transform(tokenize("t"), F.length), t=f"go {joined} on") == [2, len(joined), 2]


def test_links_of_a_url_in_two_rows_are_distinct(spark):
    html = '<a href="x.html">x</a><a href="x.html">x</a><a href="../y">y</a>'
    pages = spark.createDataFrame([("http://h/a.html", html), ("http://h/a.html", html)], "url string, html string")
    assert sorted(r.out_url for r in outlinks(pages).collect()) == ["http://h/x.html", "http://h/y"]
