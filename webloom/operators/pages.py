"""Page-level jobs: text extraction, tags, outlinks and the web graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions.html import (LINK_PATTERNS, cut_query, html_tags, html_to_text,
                                    is_http_link, resolve_parts, url_parts)
from webloom.functions.text import strip_http_header
from webloom.operators import graph as G
from webloom.operators.keyed import dense_index
from webloom.session import Scratch


def pages_text(pages: DataFrame, html_col: str = "html", keep_script: bool = True,
               has_http_header: bool = False) -> DataFrame:
    """Pages with their extracted text in ``text``; pages whose text is null
    (no HTML) are dropped.  ``has_http_header`` first cuts a leading HTTP
    header (from 'Content-Length' to the next '<')."""
    html = F.col(html_col)
    if has_http_header:
        html = strip_http_header(html)
    # The text is null exactly when the HTML is null, so the filter tests the
    # input column (a filter on the derived text would be pushed below the
    # projection and run the extractor twice).
    return pages.filter(F.col(html_col).isNotNull()).withColumn("text", html_to_text(html, keep_script))


def page_tags(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page id, tag_no, tag): every tag body of every page."""
    return pages.select(id_col, F.posexplode(html_tags(html_col)).alias("tag_no", "tag"))


def outlinks(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Distinct (page_url, out_url): absolute http(s) links of each page,
    resolved against the page URL, query cut, the page itself excluded.

    Per tag the link patterns (a, area, frame, iframe) are tried in order and
    the first one giving a valid link wins.  A page is one row: the tag array
    is carried through successive ``transform`` stages (raw candidates, query
    cut, resolution, first valid link) and repeats inside the row go before
    the one shuffle that makes pairs distinct over rows with the same URL.
    """
    parts = url_parts(url_col)
    n = len(LINK_PATTERNS)
    # Every link pattern needs 'href=' or 'src=': tags without '=' are skipped
    # before any pattern runs (exact, and most tags are <p>, <li>, </a> ...).
    tags = F.filter(html_tags(html_col), lambda t: t.contains("="))
    base = pages.select(F.col(url_col).alias("page_url"), *[v.alias(k) for k, v in parts.items()],
                        tags.alias("_tags"))
    raws = F.transform("_tags", lambda t: F.struct(*[
        F.when(t.rlike(p), F.regexp_extract(t, p, 1)).alias(f"r{k}") for k, p in enumerate(LINK_PATTERNS)]))
    lks = F.transform(raws, lambda x: F.struct(*[cut_query(x[f"r{k}"]).alias(f"l{k}") for k in range(n)]))
    cands = F.transform(lks, lambda x: F.struct(*[
        resolve_parts(x[f"l{k}"], F.col("sch"), F.col("auth"), F.col("path"), F.col("qry")).alias(f"c{k}")
        for k in range(n)]))
    firsts = F.transform(cands, lambda x: F.coalesce(*[
        F.when(is_http_link(x[f"c{k}"], F.col("page_url")), x[f"c{k}"]) for k in range(n)]))
    links = F.array_distinct(F.filter(firsts, lambda u: u.isNotNull()))
    return base.select("page_url", F.explode(links).alias("out_url")).dropDuplicates(["page_url", "out_url"])


def web_graph(links: DataFrame, pages: DataFrame | None = None, url_col: str = "url"):
    """(nodes(id), edges(src, dst)) keyed by URL: pages and link targets are nodes."""
    edges = links.select(F.col("page_url").alias("src"), F.col("out_url").alias("dst"))
    nodes = None if pages is None else pages.select(F.col(url_col).alias("id"))
    return G.all_nodes(nodes, edges), edges


def web_graph_ids(links: DataFrame, pages: DataFrame | None = None, url_col: str = "url"):
    """(ids(url, id long), edges(src long, dst long)): every page and link
    target gets a dense id once (range sort + per-partition offsets, no
    single-partition window), so iterative jobs shuffle 8-byte keys instead
    of URLs.  The two lookups are shuffle joins on the URL; a target with a
    third of all links is split by AQE's skew join on the link side."""
    urls = links.select(F.col("page_url").alias("url")).union(links.select(F.col("out_url").alias("url")))
    if pages is not None:
        urls = urls.union(pages.select(F.col(url_col).alias("url")))
    ids = dense_index(urls.distinct(), ["url"], "id")
    edges = (links.join(ids.select(F.col("url").alias("page_url"), F.col("id").alias("src")), "page_url")
             .join(ids.select(F.col("url").alias("out_url"), F.col("id").alias("dst")), "out_url")
             .select("src", "dst"))
    return ids, edges


def web_pagerank(pages: DataFrame, iterations: int = 5, url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """PageRank over the outlink graph of the pages: (id = url, rank).
    Ranked on dense long ids; URLs are joined back once at the end."""
    links = Scratch(pages.sparkSession, "links").save(outlinks(pages, url_col, html_col))  # read three times below
    ids, edges = web_graph_ids(links, pages, url_col)
    ranks = G.pagerank(edges, ids.select("id"), iterations=iterations)
    return ranks.join(ids, "id").select(F.col("url").alias("id"), "rank")
