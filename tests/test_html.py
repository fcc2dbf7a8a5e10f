from webloom.functions import html as H
from webloom.operators import pages as P

PAGE = ('<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{margin:0}</style>'
        '<script>var t="</p>";go();</script></head><body><!-- hidden --><p>One<b>Two</b>\n  </p>'
        '<p>&copy; 2024 &middot; x</p><a href="/rel">l</a><area shape="r" href="http://o.org/a?q=1">'
        '<iframe src="https://f.net/z"></iframe><a href="mailto:x@y">m</a><a href="http://h.com/p/x">self</a>'
        '</body></html>')


def test_html_to_text(spark):
    df = spark.createDataFrame([(PAGE,), ("<p>   </p>",), (None,)], "html string")
    got = [r[0] for r in df.select(H.html_to_text("html")).collect()]
    assert got[0] == 'T & U\np{margin:0}\nvar t="</p>";go();\nOne\nTwo\n© 2024 · x\nl\nm\nself\n'
    assert got[1] == ""
    assert got[2] is None


def test_html_to_text_without_script(spark):
    df = spark.createDataFrame([(PAGE,)], "html string")
    got = df.select(H.html_to_text("html", keep_script=False)).first()[0]
    assert "go()" not in got and "margin" not in got and got.startswith("T & U\nOne\n")


def test_html_tags_per_line(spark):
    df = spark.createDataFrame([("<a x>t<b\ny>z<c>",)], "html string")
    assert df.select(H.html_tags("html")).first()[0] == ["a x", "c"]


def test_resolve_url(spark):
    base = "http://h.com/a/b/c?x=1#f"
    cases = {"/x": "http://h.com/x", "y": "http://h.com/a/b/y", "../z": "http://h.com/a/z",
             "#k": "http://h.com/a/b/c?x=1#k", "//o.com/p": "http://o.com/p",
             "https://e.com/a?b": "https://e.com/a", "a b": "a b", "./m": "http://h.com/a/b/m"}
    df = spark.createDataFrame([(base, k) for k in cases], "b string, l string")
    got = {r.l: r.r for r in df.select("l", H.resolve_url("b", "l").alias("r")).collect()}
    assert got == cases


def test_outlinks(spark):
    df = spark.createDataFrame([("http://h.com/p/x", PAGE)], "url string, html string")
    got = sorted(r.out_url for r in P.outlinks(df).collect())
    assert got == ["http://h.com/rel", "http://o.org/a", "https://f.net/z"]


def test_numeric_references(spark):
    df = spark.createDataFrame([("<p>it&#8217;s &#x27;q&#X27; &#38;lt; &amp;#65; &#0; &#65;&amp;</p>",)], "html string")
    got = df.select(H.html_to_text("html")).first()[0]
    assert got == "it\u2019s 'q' &lt; &#65; &#0; A&\n"
