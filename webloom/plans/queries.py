"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables (or data Spark derives from them) in
full.  Computed columns carry the same aliases as the SQL in ``oracle.py``;
doubles are rounded to ``ROUND`` digits on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.functions.text import doc_key
from webloom.operators import graph as G
from webloom.operators import index as IX
from webloom.operators import search as S
from webloom.operators import stats as ST
from webloom.plans import inputs as I
from webloom.session import Scratch
from webloom.sources.tables import table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _r(c, digits: int = I.ROUND):
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


# ------------------------------------------------------------------ statistics
@query("stats_global")
def q_stats_global(spark, sf):
    st = ST.stats_global(table(spark, sf, "lineitem"), "l_extendedprice")
    return st.select(_r("max", 6).alias("max"), _r("min", 6).alias("min"), _r("avg", 6).alias("avg"),
                     _r("std_dev", 6).alias("std_dev"), "n")


@query("stats_report")
def q_stats_report(spark, sf):
    return ST.stats_report(ST.stats_global(table(spark, sf, "lineitem"), "l_extendedprice"), 4)


# ------------------------------------------------------------- text and index
def _docs(spark, sf):
    return table(spark, sf, "documents", spread_out=True).select("doc_id", "text")


@query("tokens")
def q_tokens(spark, sf):
    return IX.token_counts(_docs(spark, sf), stage="raw")


@query("tokens_no_stop")
def q_tokens_no_stop(spark, sf):
    return IX.token_counts(_docs(spark, sf), stage="no_stop")


@query("tokens_non_numeric")
def q_tokens_non_numeric(spark, sf):
    return IX.token_counts(_docs(spark, sf), stage="index")


@query("is_number_string")
def q_is_number_string(spark, sf):
    return IX.number_flags(_docs(spark, sf))


@query("term_freqs")
def q_term_freqs(spark, sf):
    return IX.term_freqs(_docs(spark, sf))


@query("word_count")
def q_word_count(spark, sf):
    return IX.word_count(IX.term_freqs(_docs(spark, sf)))


def _page_postings(spark, sf):
    return IX.term_freqs(I.page_table(spark, sf), text_col="content")


@query("inverted_index")
def q_inverted_index(spark, sf):
    return IX.inverted_index(_page_postings(spark, sf))


@query("inverted_index_map")
def q_inverted_index_map(spark, sf):
    return IX.explode_postings_map(IX.postings_map(_page_postings(spark, sf)))


@query("index_scan")
def q_index_scan(spark, sf):
    return IX.index_scan(_page_postings(spark, sf))


# ------------------------------------------------------------------- graphs
def _graph_b(spark, sf):
    return I.part_nodes(spark, sf), I.part_chain_edges(spark, sf)


@query("out_degree")
def q_out_degree(spark, sf):
    return G.out_degree(_graph_b(spark, sf)[1])


@query("dangling_nodes")
def q_dangling_nodes(spark, sf):
    nodes, edges = _graph_b(spark, sf)
    more = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))  # customers have no links
    return G.dangling_nodes(nodes.union(more).distinct(), edges)


@query("adjacency_lists")
def q_adjacency_lists(spark, sf):
    nodes, edges = _graph_b(spark, sf)
    return G.adjacency_lines(edges, nodes).select("src", "line")


@query("edges_from_adjacency")
def q_edges_from_adjacency(spark, sf):
    nodes, edges = _graph_b(spark, sf)
    lines = G.adjacency_lines(edges, nodes).select(F.col("line").alias("value"))
    n2, e2 = G.edges_from_adjacency(lines)
    return e2


def _stored_graph_b(spark, sf):
    """All ids and the links of graph B, stored: they are read several times, and the join that makes the links runs once."""
    nodes, edges = _graph_b(spark, sf)
    scratch = Scratch(spark, "graph-b")
    edges = scratch.save(edges)
    return scratch.save(G.all_nodes(nodes, edges)), edges


@query("pagerank_init")
def q_pagerank_init(spark, sf):
    ids, _ = _stored_graph_b(spark, sf)
    return G.pagerank_init(ids).select("id", _r("rank").alias("rank"))


@query("pagerank_contrib")
def q_pagerank_contrib(spark, sf):
    ids, edges = _stored_graph_b(spark, sf)
    c = G.pagerank_contrib(G.pagerank_init(ids), edges)
    return c.groupBy("dst").agg(_r(F.sum("contrib")).alias("contrib"))


@query("pagerank_step")
def q_pagerank_step(spark, sf):
    ids, edges = _stored_graph_b(spark, sf)
    n = ids.count()
    r = G.pagerank_step(G.pagerank_init(ids, n), edges, n)
    return r.select("id", _r("rank").alias("rank"))


def _pagerank_b(spark, sf):
    nodes, edges = _graph_b(spark, sf)
    return G.pagerank(edges, nodes, iterations=I.PAGERANK_ITERATIONS)


@query("pagerank")
def q_pagerank(spark, sf):
    return _pagerank_b(spark, sf).select("id", _r("rank").alias("rank"))


@query("pagerank_ranked")
def q_pagerank_ranked(spark, sf):
    return G.ranked(_pagerank_b(spark, sf)).select("id", _r("rank").alias("rank"))


@query("pagerank_top10")
def q_pagerank_top10(spark, sf):
    return G.top_ranked(_pagerank_b(spark, sf), 10).select("id", _r("rank").alias("rank"))


# ------------------------------------------------------------------- search
@query("doc_key")
def q_doc_key(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", I.trec_id(d).alias("trec_id"), doc_key(I.trec_id(d)).alias("doc_key"))


@query("doc_rank_load")
def q_doc_rank_load(spark, sf):
    """Ranks of the pages' link graph, loaded by archive id."""
    r = S.doc_rank_load(*I.page_ranks(spark, sf))
    return r.select("doc_id", "node_id", _r(F.col("page_rank").cast("double")).alias("page_rank"))


@query("search_keyword")
def q_search_keyword(spark, sf):
    """Lookup in the stored ranked index and pages; filters reach their scans."""
    t = I.search_tables(spark, sf)
    res = S.search_ranked(spark, t["ranked"], t["pages"], I.SEARCH_KEYWORD, 20)
    return res.select("doc_id", "uri", _r(F.col("page_rank").cast("double")).alias("page_rank"),
                      F.col("term_freq").cast("long").alias("term_freq"))


@query("search_eval_count")
def q_search_eval_count(spark, sf):
    return S.search_eval_count(I.search_tables(spark, sf, ranks=False)["postings"], I.SEARCH_KEYWORD)


@query("get_page_snapshot")
def q_get_page_snapshot(spark, sf):
    """The page with the most keyword occurrences (ties: smallest key), by its key."""
    t = I.search_tables(spark, sf, ranks=False)
    hit = S.keyword_postings(t["postings"], I.PAGE_KEYWORD).orderBy(F.desc("term_freq"), F.asc("doc_id")).first()
    return S.get_page(t["pages"], hit["doc_id"] if hit else "")


@query("get_page_by_filter")
def q_get_page_by_filter(spark, sf):
    """As ``get_page_snapshot``, from a page table in the order of its arrival, by the filters of its row groups."""
    t = I.search_tables(spark, sf, ranks=False)
    hit = S.keyword_postings(t["postings"], I.PAGE_KEYWORD).orderBy(F.desc("term_freq"), F.asc("doc_id")).first()
    path = scratch_path(spark, f"arrivals-{uuid.uuid4().hex}")
    S.with_key_filter(I.search_pages(spark, sf).write, "doc_id").parquet(path)
    return S.get_page(spark.read.parquet(path), hit["doc_id"] if hit else "")


@query("page_keyword_lines")
def q_page_keyword_lines(spark, sf):
    return S.page_keyword_lines(I.page_table(spark, sf), I.PAGE_KEYWORD)


# -------------------------------------------------------------------- pages
from webloom.operators import pages as P  # noqa: E402


@query("html_tags")
def q_html_tags(spark, sf):
    return P.page_tags(table(spark, sf, "pages", spread_out=True))


@query("pages_text")
def q_pages_text(spark, sf):
    return P.pages_text(table(spark, sf, "pages", spread_out=True)).select("page_id", "url", "text")


@query("outlinks")
def q_outlinks(spark, sf):
    return P.outlinks(table(spark, sf, "pages", spread_out=True))


@query("web_pagerank")
def q_web_pagerank(spark, sf):
    r = P.web_pagerank(table(spark, sf, "pages", spread_out=True), iterations=I.PAGERANK_ITERATIONS)
    return r.select("id", _r("rank").alias("rank"))


# --------------------------------------------------------------- clustering
from webloom.operators import cluster as C  # noqa: E402
from webloom.operators import sampling as SM  # noqa: E402
from pyspark.sql import Window  # noqa: E402


def _init(spark, sf):
    return C.init_centroids(I.points(spark, sf), I.KMEANS_K, I.KMEANS_SEED)


def _final(spark, sf):
    return C.kmeans_minibatch(I.points(spark, sf), I.KMEANS_K, I.KMEANS_BATCH,
                              I.KMEANS_ITERATIONS, I.KMEANS_SEED)


def _long(spark, cents):
    df = cents.to_df(spark)
    return df.select("cid", F.posexplode("features").alias("pos", "value")) \
        .select("cid", "pos", _r("value").alias("value"))


@query("sample_fixed")
def q_sample_fixed(spark, sf):
    return SM.sample_fixed(I.points(spark, sf), I.SAMPLE_SIZE, I.KMEANS_SEED).select("id")


@query("kmeans_init")
def q_kmeans_init(spark, sf):
    pick = SM.sample_fixed(I.points(spark, sf), I.KMEANS_K, I.KMEANS_SEED).select("id")
    w = Window.orderBy(SM.seeded_hash("id", I.KMEANS_SEED), "id")  # K rows only
    return pick.select((F.row_number().over(w) - 1).cast("int").alias("cid"), "id")


@query("euclidean")
def q_euclidean(spark, sf):
    p = I.points(spark, sf)
    first = _init(spark, sf)
    return p.select("id", _r(C.euclidean("features", F.array(*[F.lit(float(x)) for x in first.vectors[0]])))
                    .alias("dist"))


@query("vector_add")
def q_vector_add(spark, sf):
    p = I.points(spark, sf)
    v = C.vector_add("features", F.transform("features", lambda x: x * 2.0))
    return p.select("id", F.posexplode(v).alias("pos", "value")).select("id", "pos", _r("value").alias("value"))


@query("nearest_centroid")
def q_nearest_centroid(spark, sf):
    a = C.assign(I.points(spark, sf), _init(spark, sf))
    return a.select("id", "cid", _r("dist").alias("dist"))


@query("nearest_of_many")
def q_nearest_of_many(spark, sf):
    """The nearest of many centroids, most of the distances passed over."""
    pts = I.points(spark, sf)
    a = C.assign(pts, C.init_centroids(pts, I.MANY_CENTROIDS, I.KMEANS_SEED))
    return a.select("id", "cid", _r("dist").alias("dist"))


@query("cluster_sums")
def q_cluster_sums(spark, sf):
    s = C.cluster_sums(C.assign(I.points(spark, sf), _init(spark, sf)))
    return s.select("cid", "n", F.posexplode("sum").alias("pos", "total")) \
        .select("cid", "n", "pos", _r("total").alias("total"))


@query("kmeans_error")
def q_kmeans_error(spark, sf):
    e = C.clustering_error(C.assign(I.points(spark, sf), _init(spark, sf)))
    return e.select(_r("error", 6).alias("error"))


@query("kmeans_step")
def q_kmeans_step(spark, sf):
    pts = I.points(spark, sf)
    c1 = C.kmeans_step(pts, _init(spark, sf), I.KMEANS_BATCH, I.KMEANS_SEED + 1)
    return _long(spark, c1)


@query("kmeans_minibatch")
def q_kmeans_minibatch(spark, sf):
    return _long(spark, _final(spark, sf))


@query("cluster_assign")
def q_cluster_assign(spark, sf):
    return C.assign(I.points(spark, sf), _final(spark, sf)).select("id", "cid")


@query("kmeans_centroids_text")
def q_kmeans_centroids_text(spark, sf):
    return C.centroid_lines(_final(spark, sf).to_df(spark), digits=6)


# ------------------------------------------------------- keyed tables, misc
import uuid  # noqa: E402

from webloom.functions import dates as D  # noqa: E402
from webloom.functions import text as TX  # noqa: E402
from webloom.operators import hits as HT  # noqa: E402
from webloom.operators import keyed as K  # noqa: E402
from webloom.operators import similarity as SIM  # noqa: E402
from webloom.session import scratch_path  # noqa: E402
from webloom.sources import text as SRC  # noqa: E402


@query("first_per_key")
def q_first_per_key(spark, sf):
    li = table(spark, sf, "lineitem")
    r = K.first_per_key(li, "l_orderkey", "l_extendedprice", ["l_linenumber", "l_partkey", "l_extendedprice"])
    return r.select("l_orderkey", _r("l_extendedprice").alias("l_extendedprice"))


def _event_out(df):
    return df.select("user_id", "event_id", "event_type", _r("value").alias("value"), "props",
                     D.epoch_units("ts", "MICROSECOND").alias("ts_us"))


@query("upsert_latest")
def q_upsert_latest(spark, sf):
    ev = table(spark, sf, "events")
    base = ev.filter(F.col("event_type").isin("signup", "click", "view"))
    upd = ev.filter(~F.col("event_type").isin("signup", "click", "view"))
    return _event_out(K.upsert_latest(base, upd, "user_id", ["ts", "event_id"]))


@query("delete_by_key")
def q_delete_by_key(spark, sf):
    ev = table(spark, sf, "events")
    gone = ev.filter((F.col("event_type") == "error") & (F.col("value") >= 99.0)).select("user_id")
    return K.delete_by_key(ev, gone, "user_id").select("event_id", "user_id")


@query("table_peek")
def q_table_peek(spark, sf):
    return K.table_peek(table(spark, sf, "supplier"), "s_suppkey", I.PEEK_ROWS)


@query("manifest_pack")
def q_manifest_pack(spark, sf):
    return K.pack_paths(table(spark, sf, "pages"), I.MANIFEST_SIZE, path_col="url")


_HEADER_LINES = [
    lambda p: F.lit("WARC-Type: response"),
    lambda p: F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
    lambda p: F.concat(F.lit("WARC-TREC-ID: "), I.page_trec_id(p)),
    lambda p: F.concat(F.lit("Content-Length: "), F.octet_length("html").cast("string")),
    lambda p: F.lit("X-No-Colon-Flag"),
]


@query("header_map")
def q_header_map(spark, sf):
    p = table(spark, sf, "pages")
    lines = F.array(*[f(p) for f in _HEADER_LINES])
    kv = F.map_from_entries(F.transform(lines, lambda ln: F.struct(TX.header_key(ln), TX.header_value(ln))))
    return p.select("page_id", F.explode(kv).alias("key", "value"))


@query("strip_http_header")
def q_strip_http_header(spark, sf):
    p = table(spark, sf, "pages")
    body = TX.strip_http_header(I.http_body(p))
    return p.select("page_id", F.length(body).alias("n_chars"), F.md5(body).alias("md5"))


@query("command_lines")
def q_command_lines(spark, sf):
    p = table(spark, sf, "pages")
    inp = F.concat(F.lit("data/"), F.col("page_id").cast("string"), F.lit(".fa"))
    out = F.concat(F.lit("out/"), F.col("page_id").cast("string"), F.lit(".tab"))
    return p.select("page_id", TX.fill_command(F.lit(I.COMMAND_TEMPLATE), inp, out).alias("command"))


@query("parse_datetime")
def q_parse_datetime(spark, sf):
    ev = table(spark, sf, "events")
    txt = D.format_datetime("ts")
    return ev.select("event_id", txt.alias("text"), D.epoch_units(D.parse_datetime_ntz(txt), "SECOND").alias("epoch_s"))


@query("seconds_between")
def q_seconds_between(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    od = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return li.join(od, "l_orderkey").select("l_orderkey", "l_linenumber",
                                             D.seconds_between("o_orderdate", "l_shipdate").alias("secs"))


@query("vectors_from_csv")
def q_vectors_from_csv(spark, sf):
    e = table(spark, sf, "embeddings")
    lines = e.select("vec_id", F.array_join(F.transform("embedding", lambda x: x.cast("double").cast("string")),
                                            ",").alias("value"))
    v = SRC.parse_vectors(lines, id_col="vec_id")
    return v.select("id", F.posexplode("features").alias("pos", "value")).select("id", "pos", _r("value").alias("value"))


def _hits(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(F.col("l_orderkey").cast("string").alias("query_id"),
                     F.col("l_partkey").cast("string").alias("subject_id"),
                     F.col("l_extendedprice").alias("bit_score"), F.col("l_discount").alias("evalue"))


@query("hits_best")
def q_hits_best(spark, sf):
    b = HT.hits_best(_hits(spark, sf))
    return b.select("query_id", "best_subject", _r("best_bit_score").alias("best_bit_score"),
                    _r("best_evalue").alias("best_evalue"), "n_hits")


@query("numbers_stats")
def q_numbers_stats(spark, sf):
    path = scratch_path(spark, f"numbers-{uuid.uuid4().hex}")
    table(spark, sf, "lineitem").select(F.col("l_extendedprice").cast("string").alias("value")) \
        .write.text(path)
    st = ST.stats_global(SRC.read_numbers(spark, path), "value")
    return st.select(_r("max", 6).alias("max"), _r("min", 6).alias("min"), _r("avg", 6).alias("avg"),
                     _r("std_dev", 6).alias("std_dev"), "n")


@query("seed_similarity")
def q_seed_similarity(spark, sf):
    return SIM.seed_similarity(table(spark, sf, "benchmark"), table(spark, sf, "documents", spread_out=True),
                               I.SHINGLE_K, I.CONTAINMENT, I.MIN_SHARED)


# ----------------------------------------------------- archives and files
from webloom.operators import external as EX  # noqa: E402
from webloom.sources import files as FS  # noqa: E402
from webloom.sources import warc as W  # noqa: E402


@query("warc_records")
def q_warc_records(spark, sf):
    recs = W.read_warc(spark, I.write_pages_as_warc(spark, sf))
    resp = recs.filter(F.col("type") == "response")
    return resp.select(F.col("metadata")["WARC-TREC-ID"].alias("trec_id"),
                       F.col("metadata")["WARC-Target-URI"].alias("uri"), "content_length")


@query("warc_split_records")
def q_warc_split_records(spark, sf):
    """The pages as a few archives of many gzip members, each read by several tasks."""
    from webloom.sinks.text import write_archives
    path = scratch_path(spark, f"members-{uuid.uuid4().hex}")
    pages = table(spark, sf, "pages")
    write_archives(pages.select(I.warc_record_text(pages).alias("value")), path)
    recs = W.read_warc_split(spark, path, glob="*.warc.gz", split_bytes=I.ARCHIVE_SPLIT).filter(F.col("type") == "response")
    return recs.select(F.col("metadata")["WARC-TREC-ID"].alias("trec_id"),
                       F.col("metadata")["WARC-Target-URI"].alias("uri"), "content_length")


@query("pages_from_warc")
def q_pages_from_warc(spark, sf):
    recs = W.read_warc(spark, I.write_pages_as_warc(spark, sf))
    pages = W.response_pages(recs)
    out = P.pages_text(pages, has_http_header=True)
    return out.select(doc_key("trec_id").alias("doc_id"), "uri", F.col("text").alias("content"))


@query("file_inventory")
def q_file_inventory(spark, sf):
    """Files and bytes per folder of a table written in files of a thousand pages' range each."""
    path = scratch_path(spark, f"inventory-{uuid.uuid4().hex}")
    p = table(spark, sf, "pages").select((F.col("page_id") % 7).alias("bucket"), F.expr("page_id DIV 1000").alias("chunk"), F.col("html").alias("value"))
    p.repartition("bucket", "chunk").write.partitionBy("bucket", "chunk").text(path)
    files = FS.scan_files(spark, path, recursive=True).filter(F.col("file_name").startswith("part-"))
    folder = F.element_at(F.split("path", "/"), -3)
    return files.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


@query("read_manifests")
def q_read_manifests(spark, sf):
    """Archives through manifests: the paths are packed into manifest files, written, and read by them."""
    archives = FS.scan_files(spark, I.write_pages_as_warc(spark, sf), glob="*.gz").select("path")
    path = scratch_path(spark, f"manifests-{uuid.uuid4().hex}")
    K.pack_paths(archives, I.MANIFEST_SIZE, path_col="path").select("path", "manifest") \
        .write.partitionBy("manifest").text(path)
    recs = W.read_warc_manifests(spark, path).filter(F.col("type") == "response")
    return recs.select(F.col("metadata")["WARC-TREC-ID"].alias("trec_id"),
                       F.col("metadata")["WARC-Target-URI"].alias("uri"), "content_length")


@query("load_tables")
def q_load_tables(spark, sf):
    """The four crawl tables created empty, then loaded with pages, index, word counts and ranks; rows of each."""
    from webloom.sinks.text import TABLE_SCHEMAS, init_tables
    base = scratch_path(spark, f"tables-{uuid.uuid4().hex}")
    paths = dict(zip(TABLE_SCHEMAS, init_tables(spark, base)))
    t = I.search_tables(spark, sf)
    for name, rows in {"pages": t["pages"], "postings": t["postings"], "word_count": IX.word_count(t["postings"]), "page_rank": t["ranks"]}.items():
        rows.select(*(f.split()[0] for f in TABLE_SCHEMAS[name].split(", "))).write.mode("append").option("compression", "gzip").parquet(paths[name])
    counts = [spark.read.schema(TABLE_SCHEMAS[n]).parquet(p).agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n"))
              for n, p in paths.items()]
    return reduce(DataFrame.unionByName, counts)


@query("outputs_by_input")
def q_outputs_by_input(spark, sf):
    """A result per input name through the per-input sink, read back."""
    path = scratch_path(spark, f"outputs-{uuid.uuid4().hex}")
    n = table(spark, sf, "documents").groupBy(F.col("source").alias("file_name")).agg(
        F.concat(F.lit("documents "), F.count(F.lit(1)).cast("string")).alias("output"))
    EX.write_outputs(n.withColumn("stdout", F.lit(None).cast("string")), path)
    return spark.read.text(path).select("file_name", F.col("value").alias("line"))


@query("vectors_from_files")
def q_vectors_from_files(spark, sf):
    """Vectors through comma-separated files (ids are by file and place there)."""
    path = scratch_path(spark, f"vectors-{uuid.uuid4().hex}")
    table(spark, sf, "embeddings").select(F.array_join(F.transform("embedding", lambda x: x.cast("double").cast("string")), ",")
                                          .alias("value")).write.text(path)
    v = SRC.read_vectors(spark, path)
    return v.select(F.posexplode("features").alias("pos", "value")).select("pos", _r("value").alias("value"))


@query("doc_rank_from_files")
def q_doc_rank_from_files(spark, sf):
    """Rank load through the reference's text formats: an id map file
    ('trecId<TAB>nodeId') and a rank file (count line, then 'nodeId rank'),
    both written by Spark from the tables, read back and joined."""
    ids, ranks = I.page_ranks(spark, sf)
    base = scratch_path(spark, f"rankload-{uuid.uuid4().hex}")
    ids.select(F.concat_ws("\t", "trec_id", F.col("node_id").cast("string")).alias("value")) \
        .write.text(f"{base}/idmap")
    header = ranks.agg(F.count(F.lit(1)).cast("string").alias("value"))
    pairs = ranks.select(F.concat_ws(" ", F.col("node_id").cast("string"), F.col("rank").cast("string")).alias("value"))
    header.unionByName(pairs).write.text(f"{base}/ranks")
    id_map = SRC.read_id_map(spark, f"{base}/idmap")
    node_ranks = SRC.read_rank_pairs(spark, f"{base}/ranks")
    r = S.doc_rank_load(id_map, node_ranks, order_col="line_no")
    return r.select("doc_id", F.col("node_id").cast("long").alias("node_id"),
                    _r(F.col("page_rank").cast("double")).alias("page_rank"))


@query("kmeans_error_trace")
def q_kmeans_error_trace(spark, sf):
    """Clustering error of each iteration's batch (the reference's per-iteration print)."""
    errs = _final(spark, sf).errors
    return spark.createDataFrame([(i + 1, float(e)) for i, e in enumerate(errs)], "iteration int, error double") \
        .select("iteration", _r("error", 6).alias("error"))


@query("pagerank_kv_text")
def q_pagerank_kv_text(spark, sf):
    """PageRank output through the key<TAB>value text sink and back."""
    from webloom.sinks.text import write_key_value
    path = scratch_path(spark, f"ranks-kv-{uuid.uuid4().hex}")
    write_key_value(_pagerank_b(spark, sf), "id", "rank", path)
    back = spark.read.schema("id long, rank double").option("sep", "\t").csv(path)
    return back.select("id", _r("rank").alias("rank"))


@query("hits_from_files")
def q_hits_from_files(spark, sf):
    """Best hit per query through the tool's 12-column TAB files (written by
    Spark from lineitem, read back with ``read_hits``)."""
    li = table(spark, sf, "lineitem")
    path = scratch_path(spark, f"hits-{uuid.uuid4().hex}")
    li.select(F.col("l_orderkey").cast("string").alias("query_id"),
              F.col("l_partkey").cast("string").alias("subject_id"),
              (F.col("l_quantity") * 2).alias("pct_identity"),
              F.col("l_linenumber").alias("aln_length"), F.lit(0).alias("mismatches"),
              F.lit(0).alias("gap_opens"), F.col("l_linenumber").alias("q_start"),
              F.lit(1).alias("q_end"), F.lit(1).alias("s_start"), F.col("l_linenumber").alias("s_end"),
              F.col("l_discount").alias("evalue"), F.col("l_extendedprice").alias("bit_score")) \
        .write.option("sep", "\t").csv(path)
    b = HT.hits_best(SRC.read_hits(spark, path))
    return b.select("query_id", "best_subject", _r("best_bit_score").alias("best_bit_score"),
                    _r("best_evalue").alias("best_evalue"), "n_hits")


@query("edges_from_adjacency_files")
def q_edges_from_adjacency_files(spark, sf):
    """Graph B through adjacency text files ('src t1 t2 ...'), read back with
    ``read_adjacency`` (single-space separator, as the reference's parser)."""
    nodes, edges = _graph_b(spark, sf)
    path = scratch_path(spark, f"adjacency-{uuid.uuid4().hex}")
    G.adjacency_lines(edges, nodes).select(F.col("line").alias("value")).write.text(path)
    return SRC.read_adjacency(spark, path, sep=" ")[1]


# ------------------------------------------------- keyed table with deltas
def _event_store(spark, sf):
    """The latest event of each user in a keyed table: two batches of puts, the first one compacted."""
    from webloom.operators.keyed_store import KeyedTable
    ev = table(spark, sf, "events")
    store = KeyedTable.create(spark, scratch_path(spark, f"events-{uuid.uuid4().hex}"), ev.schema, ["user_id"], ["ts", "event_id"], 16)
    early = F.col("event_type").isin("signup", "click", "view")
    store.put(ev.filter(early))
    store.compact(1)
    store.put(ev.filter(~early))
    return ev, store


@query("keyed_store_put")
def q_keyed_store_put(spark, sf):
    return _event_out(_event_store(spark, sf)[1].read())


@query("keyed_store_delete")
def q_keyed_store_delete(spark, sf):
    ev, store = _event_store(spark, sf)
    store.delete(ev.filter((F.col("event_type") == "error") & (F.col("value") >= 99.0)).select("user_id"))
    return _event_out(store.read())


# ------------------------------------------------- segmented index
@query("segment_postings")
def q_segment_postings(spark, sf):
    """Postings of ``documents`` from an index in segments: those labelled good have been crawled twice and hold
    their text twice, those labelled toxic have been deleted."""
    from webloom.operators.segments import SegmentIndex
    docs, labels = _docs(spark, sf), table(spark, sf, "labels")
    index = SegmentIndex.create(spark, scratch_path(spark, f"segments-{uuid.uuid4().hex}"), fanout=2)
    index.add(docs)
    good = docs.join(labels.filter("quality = 1").select("doc_id"), "doc_id", "left_semi")
    index.add(good.select("doc_id", F.concat("text", F.lit(" "), "text").alias("text")))
    index.delete(labels.filter("toxic = 1"))
    return index.postings().select(F.col("doc_id").cast("long").alias("doc_id"), "term", "tf")


# ------------------------------------------------- alignments of passages
from webloom.operators import alignment as AL  # noqa: E402


def _passage_hits(spark, sf):
    return AL.passage_hits(table(spark, sf, "benchmark"), table(spark, sf, "documents", spread_out=True))


@query("passage_hits")
def q_passage_hits(spark, sf):
    """Gapped local alignments of the benchmark passages with the documents, in the 12 columns of a hit."""
    h = _passage_hits(spark, sf)
    return h.drop("query_words").withColumns({c: _r(c, 6) for c in ("pct_identity", "evalue", "bit_score")})


@query("passage_hits_whole")
def q_passage_hits_whole(spark, sf):
    """The hits that hold a whole passage word for word."""
    h = _passage_hits(spark, sf).filter((F.col("mismatches") == 0) & (F.col("gap_opens") == 0) & (F.col("aln_length") == F.col("query_words")))
    return h.select(F.col("query_id").cast("long").alias("item_id"), F.col("subject_id").cast("long").alias("doc_id"),
                    "aln_length", "q_start", "q_end", "score").distinct()


@query("passage_hits_best")
def q_passage_hits_best(spark, sf):
    """Best hit of each passage, from hits stored in the tool's TAB format and read back."""
    path = scratch_path(spark, f"passage-hits-{uuid.uuid4().hex}")
    _passage_hits(spark, sf).drop("score", "query_words").write.option("sep", "\t").csv(path)
    b = HT.hits_best(SRC.read_hits(spark, path))
    return b.select("query_id", "best_subject", _r("best_bit_score", 6).alias("best_bit_score"), "n_hits")
