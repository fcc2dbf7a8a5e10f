import html as H
import re

import numpy as np
import pytest

from webloom.llm import boosting, dom, html_extract
from webloom.llm.queries import op1_html_extract


def reference(html):
    """Text of the driver's pages: all of <article>, by their known layout."""
    body = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    body = re.sub(r"<[^>]+>", "", re.sub(r"</?(?:p|h1|br)[^>]*>", " ", body))
    return " ".join(H.unescape(body).split())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_on_driver_pages(spark, sf):
    path = f"/root/testdata/{sf}"
    want = {r.page_id: (r.url, reference(r.html)) for r in spark.read.parquet(f"{path}/pages.parquet").collect()}
    got = {r.page_id: r for r in op1_html_extract(spark, path).collect()}
    assert {i: (r.url, r.text) for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_unseen_sample_pages():
    model, right, n = html_extract.train(), 0, 150
    for i in range(90_000, 90_000 + n):
        page, label = html_extract.labelled(html_extract.sample_page(i))
        got = dom.main_text(page, dom.decode(page, model.log_odds(dom.features(page))))
        right += got == dom.main_text(page, label)
    assert right >= 0.97 * n


PAGE = """<html><body><header><h1>Site</h1></header><ul class="main-menu"><li><a href=/a>Home</a><li><a href=/b>News</a></ul>
<div class="cookie-consent">We use cookies to make this site work. Please accept them.<button>OK</button></div>
<div id="content"><h2>A title &amp; more</h2><p>First paragraph of the  article,\nwith <em>words</em> in it, long enough to be read as prose.
<p>Second &lt;one&gt; caf&eacute;&#33; It goes on, with commas, and a <a href="/x">link to a thing</a> in the middle of it.</p>
<div class="advert">Buy this now, it is cheap and good.</div><p>Third paragraph closes the story here, once and for all.</p></div>
<aside><h3>Related</h3><ul><li><a href=/c>One</a></li><li><a href=/d>Two</a></li></ul></aside>
<section class="comments"><h3>Comments</h3><div class="comment"><p>I liked this article a lot, thank you for it.</p></div></section>
<form action=/s><label>Search</label><input name=q></form><script>var x = "<p>no</p>";</script><footer>&copy; 2020 Site</footer></body></html>"""
TEXT = ("A title & more First paragraph of the article, with words in it, long enough to be read as prose. Second <one> café! It goes on, "
        "with commas, and a link to a thing in the middle of it. Third paragraph closes the story here, once and for all.")


def test_a_page_by_hand():
    assert html_extract.extract([PAGE], html_extract.train()) == [TEXT]


def runs(html):
    return list(dom.Page(html).text.values())


@pytest.mark.parametrize("html,want", [
    ("", []), ("a<b>b</b>c", ["abc"]), ("<p>a<p>b", ["a", "b"]), ("a &lt;b&gt; &amp;amp; &#x41;", ["a <b> &amp; A"]),
    ("a<br>b", ["a b"]), ("<!-- <p>x</p> -->y<!-- open <p>z", ["y"]), ("<script>a</p></script >b", ["b"]), ("<script>never closed <p>x", []),
    ('<script src="a.js"/>var x=1;</script>b', ["b"]), ("<style/>p{}</style>b<svg/>c", ["b c"]),
    ("a < b", ["a < b"]), ("<p title='a>b'>c</p>", ["c"]), ("<p title='open>c</p>", ["c"]), ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]),
    ("<td>a</td><td>b", ["a", "b"]), ("</p>a</div>b", ["ab"]), ("<STYLE>x</StyLe>y", ["y"]),
    ("<a href=x>l<a href=y>m</a>n", ["lmn"]), ("<p", []), ("<p>x</p", ["x"]), ("<?php x ?>y", ["y"]), ("\x00a\xa0 b", ["\x00a b"])])
def test_reader(html, want):
    assert runs(html) == want


def test_links_and_hints():
    page = dom.Page('<div class="mainMenu big"><a href=x>abc</a> de</div><nav>f</nav>')
    i = next(iter(page.text))
    assert page.text[i] == "abc de" and page.links[i] == 3
    bits = [list(dom.HINTS).index(x) for x in ("main", "nav")]
    assert page.hints[1] == sum(1 << b for b in bits) and page.hints[page.tag.index("nav")] == 1 << bits[1]


def test_decoding_is_the_best_consistent_labelling():
    rng = np.random.default_rng(0)
    for html in ("<div><p>a<p>b</div><p>c", "<div><div><p>a</div><hr></div>x<p>y", "<hr>", "<ul><li>a<li><p>b<p>c</ul>"):
        page = dom.Page(html)
        n = len(page.tag)
        for _ in range(30):
            odds = rng.normal(size=n)

            def fine(y):
                return all(not y[i] or (page.parent[i] < 0 or y[page.parent[i]]) and
                           (i in page.text or any(y[j] and page.parent[j] == i for j in range(n))) for i in range(n))
            best = max((odds @ y for k in range(2 ** n) if fine(y := np.array([k >> i & 1 for i in range(n)]))))
            got = dom.decode(page, odds)
            assert fine(got) and odds @ got == pytest.approx(best)


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    model = boosting.fit(x[:2000], y[:2000])
    assert ((model.log_odds(x[2000:]) > 0) == y[2000:]).mean() > 0.97


def test_edge_cases(spark):
    deep = "<div>" * 20_000 + "<p>deep text here</p>"
    rows = [(1, None, None), (1, "u", ""), (2, "u", PAGE), (2, "u", PAGE), (None, "u", PAGE), (3, "u", deep),
            (4, "u", "<article>" + "<p>" + "word, and more of it. " * 40_000 + "</article>"), (5, "u", "<" * 50_000), (6, "u", "<a '" * 20_000)]
    d = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, text string")
    got = html_extract.main_texts(d).collect()
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r.text)
    assert len(got) == len(rows) and by[1] == ["", ""] and by[2] == [TEXT] * 2 and by[None] == [TEXT]
    assert by[4] == [("word, and more of it. " * 40_000).strip()]
    assert html_extract.main_texts(d.limit(0)).count() == 0
