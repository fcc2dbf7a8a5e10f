"""Main-text extraction: gradient-boosted trees over DOM nodes, decoded as a hierarchy.

``dom`` reads a page into block-level nodes and describes each by text and link
density of its subtree, words of its tag, classes and ids and those around it,
depth, and its place and share among its siblings.  The trees estimate for
every node whether main text is in it; ``dom.decode`` then finds the likeliest
labels in which no node contradicts its ancestors or descendants.  The text is that of
the labelled runs.

No labelled pages come with the corpus, so the trees learn from ``TRAINING_PAGES``
pages that ``sample_page`` writes from random layouts with known main text
(semantic and bare markup, notices, comments, adverts, forms, related links ...).
Fitting takes seconds on the driver and does not depend on the input; pages
then need one pass without a shuffle.

Defined results: null and empty html give the empty text; text without markup
is judged like a body; repeated rows are extracted each; an empty table gives
no rows; extra columns are not read; very long and deep pages are read whole,
in time linear in their length.
"""

from __future__ import annotations

from functools import lru_cache
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm import boosting, dom
from webloom.llm.common import in_pieces, prepare, with_columns

TRAINING_PAGES = 400
SEED = 5
_MARK = "⁣"  # an invisible separator marks main text in sample pages


class _Writer:
    def __init__(self, rng):
        self.rng = rng
        self.words = ["".join(rng.choice(list("abcdefghijklmnoprstuvéüß"), rng.integers(2, 9))) for _ in range(300)]

    def pick(self, *options):
        return options[self.rng.integers(len(options))]

    def chance(self, p):
        return self.rng.random() < p

    def line(self, low, high, stop=True):
        w = [self.words[i] for i in self.rng.integers(0, len(self.words), self.rng.integers(low, high + 1))]
        for i in range(len(w)):
            if self.chance(0.08):
                w[i] += self.pick(",", ".", ",", "!", " |", "&")
        return escape(" ".join(w).capitalize() + ("." if stop else ""), quote=False)

    def links(self, n, item):
        href = lambda: f'<a href="/{self.line(1, 1, False)}">{self.line(1, 4, False)}</a>'
        if item == "li":
            return "<ul>" + "".join(f"<li>{href()}</li>" for _ in range(n)) + "</ul>"
        return self.pick(" ", " | ", "").join(f"<{item}>{href()}</{item}>" if item else href() for _ in range(n))


def _attrs(w: _Writer, names: str) -> str:
    if not names:
        return ""
    name = w.pick(*names.split())
    return f' {w.pick("class", "class", "id")}="{name}{w.pick("", "", " clearfix", "-wrap", " box col")}"'


def _boiler(w: _Writer, kind: str) -> str:
    tag, names, body = {
        "nav": (w.pick("nav", "nav", "div", "ul"), "nav menu main-nav topmenu breadcrumbs pagination", lambda: w.links(w.rng.integers(1, 12), w.pick("li", "li", "", "span"))),
        "header": (w.pick("header", "div"), "header site-header masthead top", lambda: w.pick("", f"<h1>{w.line(1, 5, False)}</h1>", f"<p>{w.line(2, 8)}</p>") + w.links(w.rng.integers(0, 4), "")),
        "footer": (w.pick("footer", "footer", "div"), "footer site-footer copyright", lambda: w.pick("&copy; ", "") + w.line(2, 30) + w.pick("", "<br>" + w.line(3, 20), w.links(4, "li"))),
        "side": (w.pick("aside", "aside", "div"), "sidebar side widget related right-rail", lambda: w.pick("", f"<h3>{w.line(1, 3, False)}</h3>") + w.pick(w.links(w.rng.integers(2, 8), "li"), f"<p>{w.line(5, 60)}</p>")),
        "ad": (w.pick("div", "div", "section", "aside"), "ad ads advert sponsored promo banner-ad", lambda: w.pick(w.line(3, 40), f"<p>{w.line(5, 40)}</p>", f'<a href="#">{w.line(2, 10)}</a>')),
        "notice": (w.pick("div", "div", "section"), "cookie cookie-notice consent alert notice popup", lambda: w.pick("", "<p>") + w.line(5, 60) + w.pick("", "<button>OK</button>")),
        "comment": (w.pick("section", "div", "ol"), "comments comment-list discussion reply", lambda: w.pick("", f"<h2>{w.line(1, 3, False)}</h2>") + "".join(
            f'<{t}{_attrs(w, "comment reply")}><p>{w.line(3, 60)}</p></{t}>' for t in [w.pick("div", "article", "li")] * w.rng.integers(1, 7))),
        "form": ("form", "search newsletter login subscribe contact", lambda: f"<label>{w.line(1, 4, False)}</label><input type=text>" + w.pick("", f"<p>{w.line(3, 20)}</p>") + "<button>Go</button>"),
        "social": (w.pick("div", "p", "ul"), "share social byline author meta", lambda: w.pick(w.links(4, ""), w.line(2, 6, False))),
        "code": (w.pick("script", "style"), "", lambda: f'var t="</p>";f({w.line(1, 4)})'),
    }[kind]
    if tag not in ("nav", "header", "footer", "aside", "form", "script", "style") or w.chance(0.3):
        attrs = _attrs(w, names) if tag not in ("script", "style") else ""
    else:
        attrs = ""
    return f"<{tag}{attrs}>{body()}</{tag}>"


def sample_page(seed: int) -> str:
    """A page of random layout; runs of main text begin with _MARK."""
    w = _Writer(np.random.default_rng([SEED, seed]))
    m = lambda low, high, stop=True: _MARK + w.line(low, high, stop)

    def paragraph():
        if w.chance(0.08):
            return w.pick(f"<ul>{''.join(f'<li>{m(2, 25)}</li>' for _ in range(w.rng.integers(2, 6)))}</ul>", f"<blockquote><p>{m(5, 50)}</p></blockquote>",
                          f"<h2>{m(1, 6, False)}</h2>", f"<table><tr><td>{m(1, 6)}</td><td>{m(1, 6)}</td></tr></table>", f"<pre>{m(4, 30)}</pre>")
        size = (1, 4) if w.chance(0.25) else (5, 120)
        text = m(*size)
        if w.chance(0.2):
            text = _MARK + f'{w.line(2, 9, False)} <a href="/{w.line(1, 1, False)}">{w.line(1, 4, False)}</a> ' + w.line(*size)
        if w.chance(0.2):
            text = f"<b>{text}" + w.pick("</b>", "", "<br>" + w.line(2, 20))
        return w.pick(f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<p>{text}</p>") if not w.chance(0.06) else f"<div>{text}</div>"

    parts = [paragraph() for _ in range(w.rng.integers(1, 5) if w.chance(0.4) else w.rng.integers(2, 18))]
    if w.chance(0.7):
        parts.insert(0, f"<h1>{m(1, 12, False)}</h1>")
    for kind, p in (("ad", 0.25), ("social", 0.2), ("side", 0.15), ("form", 0.1), ("notice", 0.08), ("code", 0.15), ("header", 0.08)):
        if w.chance(p):
            parts.insert(w.rng.integers(1, len(parts) + 1), _boiler(w, kind))
    tail = "".join(_boiler(w, k) for k, p in (("social", 0.15), ("comment", 0.2), ("footer", 0.08), ("nav", 0.08)) if w.chance(p))
    tag = w.pick("article", "article", "article", "main", "div", "div", "section", "td")
    attrs = _attrs(w, "content post entry article-body story main text prose") if tag in ("div", "section") and w.chance(0.85) or w.chance(0.2) else ""
    body = f"<{tag}{attrs}>{''.join(parts)}{tail}</{tag}>"
    if tag == "td":
        body = f"<table><tr><td>{_boiler(w, 'nav')}</td>{body}</tr></table>"
    for _ in range(w.rng.integers(0, 3)):
        body = f"<{(t := w.pick('div', 'main', 'section'))}{_attrs(w, w.pick('', 'wrapper container page layout content'))}>{body}</{t}>"
    before = [_boiler(w, k) for k, p in (("header", 0.5), ("nav", 0.8), ("notice", 0.25), ("ad", 0.5), ("form", 0.2), ("side", 0.2), ("code", 0.1)) if w.chance(p)]
    after = [_boiler(w, k) for k, p in (("side", 0.3), ("comment", 0.3), ("ad", 0.3), ("nav", 0.2), ("form", 0.2), ("notice", 0.15), ("footer", 0.85), ("code", 0.1)) if w.chance(p)]
    w.rng.shuffle(before)
    if w.chance(0.3):
        before.append("<!-- " + w.line(2, 6) + " -->")
    end = w.pick("</body></html>", "</body></html>", "")
    return (f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>{w.line(2, 8, False)}</title><style>p{{margin:0}}</style></head><body>'
            + "".join(before) + body + "".join(after) + end)


def labelled(html: str) -> tuple[dom.Page, np.ndarray]:
    """A sample page without its marks, and its true labels."""
    page = dom.Page(html)
    label = np.zeros(len(page.tag), dtype=bool)
    for i in reversed(range(len(page.tag))):
        if i in page.text:
            label[i] = _MARK in page.text[i]
            page.text[i] = page.text[i].replace(_MARK, "")
        if label[i] and page.parent[i] >= 0:
            label[page.parent[i]] = True
    return page, label


@lru_cache(maxsize=2)
def train(pages: int = TRAINING_PAGES) -> boosting.Boosted:
    some = [labelled(sample_page(i)) for i in range(pages)]
    return boosting.fit(np.concatenate([dom.features(p) for p, _ in some]), np.concatenate([y for _, y in some]).astype(float))


def extract(htmls: list[str], model: boosting.Boosted) -> list[str]:
    pages = [dom.Page(h) for h in htmls]
    if not pages:
        return []
    cuts = np.cumsum([len(p.tag) for p in pages])[:-1]
    odds = np.split(model.log_odds(np.concatenate([dom.features(p) for p in pages])), cuts)
    return [dom.main_text(p, dom.decode(p, o)) for p, o in zip(pages, odds)]


def main_texts(pages: DataFrame, model: boosting.Boosted | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    spark = pages.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model or train())

    def run(batches):
        for b in in_pieces(batches):
            htmls = [h or "" for h in b.column("html").to_pylist()]
            texts = [t for i in range(0, len(htmls), 256) for t in extract(htmls[i:i + 256], shared.value)]
            yield with_columns(b, ["page_id", "url"], text=pa.array(texts, pa.string()), n_chars=pa.array([len(t) for t in texts], pa.int64()))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
