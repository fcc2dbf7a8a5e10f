"""DuckDB SQL for each registered query (the correctness oracle).

The driver registers the parquet tables as views; each string here must give
the same rows, column names and (rounded) values as the Spark query of the
same name.  Fragments are assembled from the same constants the Spark side
uses, so a parameter changes in one place.
"""

from __future__ import annotations

from webloom.functions import text as T
from webloom.operators import alignment as ALIGN
from webloom.plans import inputs as I

ORACLE: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    ORACLE[name] = text.strip()


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


R = I.ROUND
STOP_LIST = "[" + ", ".join(q(w) for w in T.STOP_WORDS) + "]"


def tokens_expr(col: str) -> str:
    return (f"list_filter(regexp_extract_all(lower({col}), {q(T.TOKEN_PATTERN)}, 0), "
            f"lambda t: regexp_matches(t, {q(T.WORDISH_PATTERN)}))")


def is_number_expr(t: str) -> str:
    return (f"(CASE WHEN starts_with(lower({t}), '0x') THEN regexp_matches(lower({t}), {q(T.HEX_PATTERN)}) "
            f"ELSE regexp_matches(lower({t}), {q(T.NUMBER_PATTERN)}) END)")


def index_terms_expr(col: str) -> str:
    return (f"list_filter({tokens_expr(col)}, lambda w: NOT list_contains({STOP_LIST}, w) "
            f"AND NOT {is_number_expr('w')})")


def doc_key_expr(s: str) -> str:
    return f"regexp_replace(substring({s}, greatest(instr({s}, 'en'), 1)), '[^\\p{{Nd}}]', '', 'g')"


TREC_ID = ("('clueweb09-en' || repeat('0', greatest(0, 4 - CAST(length(substring(source, 4, 100)) AS INTEGER))) || "
           "substring(source, 4, 100) || '-' || printf('%019d', doc_id))")

PAGE_TREC = "('clueweb09-en0000-00-' || printf('%019d', page_id))"

PAGES_CTE = f"""pages_t AS (
  SELECT {doc_key_expr('tid')} AS doc_id,
         'http://' || source || '.example.org/doc/' || CAST(doc_id AS VARCHAR) AS uri,
         text AS content
  FROM (SELECT *, {TREC_ID} AS tid FROM documents))"""

POSTINGS_CTE = f"""post AS (
  SELECT doc_id, term, CAST(count(*) AS INTEGER) AS tf
  FROM (SELECT doc_id, unnest({index_terms_expr('content')}) AS term FROM pages_t)
  GROUP BY doc_id, term)"""

GRAPH_B_CTE = """nodes AS (SELECT p_partkey AS id FROM part),
edges AS (SELECT a.l_partkey AS src, b.l_partkey AS dst
          FROM lineitem a JOIN lineitem b
            ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1)"""

def pagerank_ctes(nodes: str, edges: str, iterations: int, p: str = "pr") -> str:
    """CTE chain ``{p}_ids, {p}_deg, {p}_n, {p}0 .. {p}{iterations}`` (unrolled loop)."""
    parts = [
        f"{p}_ids AS (SELECT id FROM {nodes} UNION SELECT src FROM {edges} UNION SELECT dst FROM {edges})",
        f"{p}_deg AS (SELECT src, count(*) AS out_degree FROM {edges} GROUP BY src)",
        f"{p}_n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM {p}_ids)",
        f"{p}0 AS (SELECT id, 1.0::DOUBLE / (SELECT n FROM {p}_n) AS rank FROM {p}_ids)",
    ]
    for i in range(1, iterations + 1):
        prev = f"{p}{i - 1}"
        parts.append(f"""{p}{i} AS (
  SELECT x.id, 0.15::DOUBLE / (SELECT n FROM {p}_n) + 0.85::DOUBLE * (coalesce(c.s, 0.0)
         + (SELECT coalesce(sum(r.rank), 0.0) FROM {prev} r LEFT JOIN {p}_deg d ON r.id = d.src
            WHERE d.src IS NULL) / (SELECT n FROM {p}_n)) AS rank
  FROM {p}_ids x LEFT JOIN (
    SELECT e.dst, sum(r.rank / d.out_degree) AS s
    FROM {edges} e JOIN {prev} r ON e.src = r.id JOIN {p}_deg d ON d.src = e.src
    GROUP BY e.dst) c ON x.id = c.dst)""")
    return ",\n".join(parts)


# ------------------------------------------------------------------ statistics
sql("stats_global", """
SELECT round(max(l_extendedprice), 6) AS max, round(min(l_extendedprice), 6) AS min,
       round(avg(l_extendedprice), 6) AS avg, round(stddev_pop(l_extendedprice), 6) AS std_dev,
       count(l_extendedprice) AS n
FROM lineitem""")

sql("stats_report", """
SELECT 'Max: ' || printf('%.4f', max(x)) || chr(9) || 'Min: ' || printf('%.4f', min(x)) || chr(9) ||
       'Avg: ' || printf('%.4f', avg(x)) || chr(9) || 'StdDev: ' || printf('%.4f', stddev_pop(x)) AS report
FROM (SELECT CAST(l_extendedprice AS DOUBLE) AS x FROM lineitem)""")

# ------------------------------------------------------------- text and index
_TOKS = f"(SELECT unnest({tokens_expr('text')}) AS token FROM documents)"
sql("tokens", f"SELECT token, count(*) AS n FROM {_TOKS} GROUP BY token")
sql("tokens_no_stop", f"""
SELECT token, count(*) AS n FROM {_TOKS} WHERE NOT list_contains({STOP_LIST}, token) GROUP BY token""")
sql("tokens_non_numeric", f"""
SELECT token, count(*) AS n FROM {_TOKS}
WHERE NOT list_contains({STOP_LIST}, token) AND NOT {is_number_expr('token')} GROUP BY token""")
sql("is_number_string", f"""
SELECT token, {is_number_expr('token')} AS is_number FROM (SELECT DISTINCT token FROM {_TOKS})""")

_DOC_POST = f"""(SELECT doc_id, term, CAST(count(*) AS INTEGER) AS tf
  FROM (SELECT doc_id, unnest({index_terms_expr('text')}) AS term FROM documents) GROUP BY doc_id, term)"""
sql("term_freqs", f"SELECT doc_id, term, tf FROM {_DOC_POST}")
sql("word_count", f"SELECT term AS word, CAST(sum(tf) AS BIGINT) AS count FROM {_DOC_POST} GROUP BY term")

_PAGE_POST = f"WITH {PAGES_CTE},\n{POSTINGS_CTE}\n"
sql("inverted_index", _PAGE_POST + "SELECT term, doc_id, tf FROM post")
sql("inverted_index_map", _PAGE_POST + "SELECT term, doc_id, tf FROM post")
sql("index_scan", _PAGE_POST + "SELECT term, doc_id, tf FROM post ORDER BY term, doc_id")

# ------------------------------------------------------------------- graphs
sql("out_degree", f"WITH {GRAPH_B_CTE}\nSELECT src, count(*) AS out_degree FROM edges GROUP BY src")
# Nodes of another given table too (customers), which have no links: the check is not 0 rows = 0 rows.
sql("dangling_nodes", f"""WITH {GRAPH_B_CTE}
SELECT id FROM (SELECT id FROM nodes UNION SELECT c_custkey AS id FROM customer) WHERE id NOT IN (SELECT src FROM edges)""")
sql("adjacency_lists", f"""WITH {GRAPH_B_CTE}
SELECT src, array_to_string(list_prepend(src, list_sort(list(dst))), ' ') AS line
FROM edges GROUP BY src
UNION ALL
SELECT id AS src, CAST(id AS VARCHAR) AS line FROM nodes WHERE id NOT IN (SELECT src FROM edges)""")
sql("edges_from_adjacency", f"WITH {GRAPH_B_CTE}\nSELECT src, dst FROM edges")

_PR_B = f"WITH {GRAPH_B_CTE},\n{pagerank_ctes('nodes', 'edges', I.PAGERANK_ITERATIONS)}\n"
sql("pagerank_init", f"WITH {GRAPH_B_CTE},\n{pagerank_ctes('nodes', 'edges', 0)}\n"
    f"SELECT id, round(rank, {R}) AS rank FROM pr0")
sql("pagerank_contrib", f"""WITH {GRAPH_B_CTE},
{pagerank_ctes('nodes', 'edges', 0)}
SELECT e.dst, round(sum(r.rank / d.out_degree), {R}) AS contrib
FROM edges e JOIN pr0 r ON e.src = r.id JOIN pr_deg d ON d.src = e.src GROUP BY e.dst""")
sql("pagerank_step", f"WITH {GRAPH_B_CTE},\n{pagerank_ctes('nodes', 'edges', 1)}\n"
    f"SELECT id, round(rank, {R}) AS rank FROM pr1")
_LAST = f"pr{I.PAGERANK_ITERATIONS}"
sql("pagerank", _PR_B + f"SELECT id, round(rank, {R}) AS rank FROM {_LAST}")
sql("pagerank_ranked", _PR_B + f"SELECT id, round(rank, {R}) AS rank FROM {_LAST} ORDER BY rank DESC, id")
sql("pagerank_top10", _PR_B + f"SELECT id, round(rank, {R}) AS rank FROM {_LAST} ORDER BY rank DESC, id LIMIT 10")

# ------------------------------------------------------------------- search
sql("doc_key", f"SELECT doc_id, {TREC_ID} AS trec_id, {doc_key_expr(TREC_ID)} AS doc_key FROM documents")
sql("page_keyword_lines", f"""WITH {PAGES_CTE}
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM (
  SELECT doc_id, generate_subscripts(string_split(content, chr(10)), 1) AS line_no,
         unnest(string_split(content, chr(10))) AS line FROM pages_t)
WHERE contains(line, {q(I.PAGE_KEYWORD)})""")

# -------------------------------------------------------------------- pages
from webloom.functions import html as H  # noqa: E402


# Named references that the given pages use, written out here on purpose: the
# library takes the whole standard table from elsewhere.
NAMED = (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "\'"), ("nbsp", "\u00a0"), ("copy", "©"), ("reg", "®"),
         ("middot", "·"), ("hellip", "…"), ("ndash", "–"), ("mdash", "—"), ("laquo", "«"), ("raquo", "»"), ("amp", "&"))


# Those of them that need no semicolon, the longest first.
BARE = ("middot", "laquo", "raquo", "quot", "nbsp", "copy", "reg", "amp", "lt", "gt")


def unescape_sql(s: str) -> str:
    pieces = f"regexp_extract_all({s}, '&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*;?)|[^&]+|&', 0)"
    digits = "regexp_extract(r, '^&#[xX]?0*([0-9a-fA-F]*);?$', 1)"
    cp = (f"(CASE WHEN length({digits}) NOT BETWEEN 1 AND 7 THEN 0 WHEN r[3] IN ('x', 'X') THEN ('0x' || {digits})::INTEGER "
          f"ELSE {digits}::INTEGER END)")
    named = " ".join(f"WHEN r = '&{n};' THEN {q(c)}" for n, c in NAMED)
    bare = " ".join(f"WHEN starts_with(r, '&{n}') THEN {q(dict(NAMED)[n])} || substring(r, {len(n) + 2})" for n in BARE)
    one = (f"CASE WHEN NOT starts_with(r, '&') OR r = '&' THEN r {named} WHEN starts_with(r, '&#') THEN "
           f"CASE WHEN {cp} BETWEEN 1 AND 1114111 AND NOT {cp} BETWEEN 55296 AND 57343 THEN chr({cp}) ELSE r END {bare} ELSE r END")
    return f"array_to_string(list_transform({pieces}, lambda r: {one}), '')"


def html_text_sql(html: str) -> str:
    body = f"regexp_extract(p, {q(H.RAW_BODY)}, 1)"
    node = (f"lambda p: CASE WHEN regexp_matches(p, {q(H.RAW_OPEN)}) THEN {body} "
            f"WHEN regexp_matches(p, {q(H.TEXT_OPEN)}) THEN {unescape_sql(body)} "
            f"WHEN starts_with(p, '<') AND length(p) > 1 THEN NULL ELSE {unescape_sql('p')} END")
    nodes = (f"list_filter(list_transform(list_transform(regexp_extract_all({html}, {q(H.PIECE_PATTERN)}, 0), "
             f"{node}), lambda t: regexp_replace(t, {q(H.TRIM_PATTERN)}, '', 'g')), "
             f"lambda t: t IS NOT NULL AND length(t) > 0 AND NOT (starts_with(t, '<!--') AND ends_with(t, '-->')) "
             f"AND NOT (starts_with(t, '/*') AND ends_with(t, '*/')))")
    return (f"(CASE WHEN {html} IS NULL THEN NULL WHEN len({nodes}) = 0 THEN '' "
            f"ELSE array_to_string({nodes}, chr(10)) || chr(10) END)")


def _merged_sql() -> str:
    base = "regexp_replace(path, '[^/]*$', '')"
    rel = "(CASE WHEN instr(lk, '#') > 0 THEN substring(lk, 1, instr(lk, '#') - 1) ELSE lk END)"
    rest = "(CASE WHEN instr(lk, '#') > 0 THEN substring(lk, instr(lk, '#')) ELSE '' END)"
    whole = f"((CASE WHEN {base} = '' THEN '/' ELSE {base} END) || {rel})"
    fold = (f"list_reduce(string_split(substring({whole}, 2), '/'), lambda acc, x: CASE WHEN x = '.' THEN acc "
            f"WHEN x = '..' THEN regexp_replace(acc, '/[^/]*$', '') ELSE acc || '/' || x END, '')")
    end = f"(CASE WHEN regexp_matches({whole}, '/[.]{{1,2}}$') THEN '/' ELSE '' END)"
    return f"sch || '://' || auth || {fold} || {end} || {rest}"


_CANDS = "\nUNION ALL\n".join(
    f"SELECT page_url, tag, {k} AS k, regexp_extract(tag, {q(p)}, 1) AS raw FROM tags "
    f"WHERE regexp_matches(tag, {q(p)})" for k, p in enumerate(H.LINK_PATTERNS))

OUTLINKS_CTE = f"""tags AS (SELECT url AS page_url, unnest(regexp_extract_all(html, {q(H.TAG_PATTERN)}, 1)) AS tag FROM pages),
cands AS ({_CANDS}),
lks AS (SELECT page_url, tag, k,
          CASE WHEN instr(raw, '?') > 1 THEN substring(raw, 1, instr(raw, '?') - 1) ELSE raw END AS lk,
          regexp_extract(page_url, {q(H.SCHEME_RE)}, 1) AS sch,
          regexp_extract(page_url, {q(H.AUTHORITY_RE)}, 1) AS auth,
          regexp_extract(page_url, {q(H.PATH_RE)}, 1) AS path,
          regexp_extract(page_url, {q(H.QUERY_RE)}, 1) AS qry
        FROM cands),
res AS (SELECT page_url, tag, k, CASE
          WHEN regexp_matches(lk, {q(H.ILLEGAL_URI)}) THEN lk
          WHEN regexp_matches(lk, {q(H.SCHEME_RE)}) THEN lk
          WHEN starts_with(lk, '//') THEN sch || ':' || lk
          WHEN starts_with(lk, '/') THEN sch || '://' || auth || lk
          WHEN starts_with(lk, '#') THEN sch || '://' || auth || path || qry || lk
          WHEN starts_with(lk, '?') THEN sch || '://' || auth || path || lk
          WHEN lk = '' THEN sch || '://' || auth || regexp_replace(path, '[^/]*$', '')
          ELSE {_merged_sql()} END AS cand
        FROM lks),
firsts AS (SELECT page_url, tag, arg_min(cand, k) AS out_url FROM res
           WHERE regexp_matches(cand, {q(H.HTTP_PATTERN)}) AND cand <> page_url GROUP BY page_url, tag),
links AS (SELECT DISTINCT page_url, out_url FROM firsts)"""

sql("html_tags", f"""
SELECT page_id, CAST(generate_subscripts(regexp_extract_all(html, {q(H.TAG_PATTERN)}, 1), 1) - 1 AS INTEGER) AS tag_no,
       unnest(regexp_extract_all(html, {q(H.TAG_PATTERN)}, 1)) AS tag
FROM pages""")
sql("pages_text", f"SELECT page_id, url, {html_text_sql('html')} AS text FROM pages WHERE {html_text_sql('html')} IS NOT NULL")
sql("outlinks", f"WITH {OUTLINKS_CTE}\nSELECT page_url, out_url FROM links")
sql("web_pagerank", f"""WITH {OUTLINKS_CTE},
wnodes AS (SELECT url AS id FROM pages),
wedges AS (SELECT page_url AS src, out_url AS dst FROM links),
{pagerank_ctes('wnodes', 'wedges', I.PAGERANK_ITERATIONS, 'wr')}
SELECT id, round(rank, {R}) AS rank FROM wr{I.PAGERANK_ITERATIONS}""")

# ------------------------------------------------------------------- search
# The page table, its index and its ranks, all from ``pages``.
SEARCH_CTE = f"""{OUTLINKS_CTE},
wnodes AS (SELECT url AS id FROM pages),
wedges AS (SELECT page_url AS src, out_url AS dst FROM links),
{pagerank_ctes('wnodes', 'wedges', I.PAGERANK_ITERATIONS, 'wr')},
urls AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS node_id FROM wr0),
pages_t AS (SELECT {doc_key_expr(PAGE_TREC)} AS doc_id, url AS uri, {html_text_sql('html')} AS content
            FROM pages WHERE html IS NOT NULL),
doc_ranks AS (SELECT {doc_key_expr(PAGE_TREC)} AS doc_id, u.node_id, CAST(coalesce(r.rank, 0.0) AS FLOAT) AS page_rank
              FROM pages p JOIN urls u ON p.url = u.id LEFT JOIN wr{I.PAGERANK_ITERATIONS} r ON r.id = u.id),
{POSTINGS_CTE}"""
sql("doc_rank_load", f"""WITH {SEARCH_CTE}
SELECT doc_id, node_id, round(CAST(page_rank AS DOUBLE), {R}) AS page_rank FROM doc_ranks""")
sql("doc_rank_from_files", ORACLE["doc_rank_load"])
sql("search_keyword", f"""WITH {SEARCH_CTE}
SELECT h.doc_id, p.uri, round(CAST(r.page_rank AS DOUBLE), {R}) AS page_rank, CAST(h.tf AS BIGINT) AS term_freq
FROM post h JOIN doc_ranks r ON h.doc_id = r.doc_id JOIN pages_t p ON p.doc_id = h.doc_id
WHERE h.term = lower({q(I.SEARCH_KEYWORD)})
ORDER BY r.page_rank DESC, h.doc_id ASC LIMIT 20""")
sql("search_eval_count", f"""WITH {SEARCH_CTE}
SELECT count(*) AS pages_evaluated FROM post WHERE term = lower({q(I.SEARCH_KEYWORD)})""")
sql("get_page_snapshot", f"""WITH {SEARCH_CTE},
snap AS (SELECT doc_id FROM post WHERE term = lower({q(I.PAGE_KEYWORD)}) ORDER BY tf DESC, doc_id ASC LIMIT 1)
SELECT p.doc_id, p.uri, p.content FROM pages_t p JOIN snap s ON p.doc_id = s.doc_id""")

sql("get_page_by_filter", ORACLE["get_page_snapshot"])

# --------------------------------------------------------------- clustering
from webloom.operators.sampling import seeded_hash_sql  # noqa: E402

PTS = "pts AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings)"


def dist_sql(a: str, b: str) -> str:
    return (f"sqrt(list_reduce(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) * (z[1] - z[2])), "
            f"lambda x, y: x + y))")


def init_cte(name: str = "c0", k: int = I.KMEANS_K) -> str:
    h = seeded_hash_sql("id", I.KMEANS_SEED)
    return (f"{name} AS (SELECT CAST(row_number() OVER (ORDER BY h, id) - 1 AS INTEGER) AS cid, id, f FROM "
            f"(SELECT id, f, {h} AS h FROM pts ORDER BY h, id LIMIT {k}))")


def assign_cte(name: str, points: str, cents: str) -> str:
    return (f"{name} AS (SELECT id, list(cid ORDER BY d, cid)[1] AS cid, min(d) AS dist FROM "
            f"(SELECT p.id, c.cid, {dist_sql('p.f', 'c.f')} AS d FROM {points} p, {cents} c) GROUP BY id)")


def kmeans_ctes(iterations: int) -> str:
    """c0 .. c{iterations}: the reset-count mini-batch update, unrolled."""
    parts = [PTS, init_cte("c0")]
    for i in range(1, iterations + 1):
        h = seeded_hash_sql("id", I.KMEANS_SEED + i)
        parts.append(f"b{i} AS (SELECT id, f FROM pts ORDER BY {h}, id LIMIT {I.KMEANS_BATCH})")
        parts.append(assign_cte(f"a{i}", f"b{i}", f"c{i - 1}"))
        parts.append(f"""s{i} AS (SELECT cid, pos, sum(v) AS s FROM (
  SELECT a.cid, unnest(b.f) AS v, generate_subscripts(b.f, 1) AS pos FROM a{i} a JOIN b{i} b ON a.id = b.id)
  GROUP BY cid, pos)""")
        parts.append(f"n{i} AS (SELECT cid, count(*) AS n FROM a{i} GROUP BY cid)")
        parts.append(f"""c{i} AS (
  SELECT s.cid, NULL AS id, list(s.s / n.n ORDER BY s.pos) AS f FROM s{i} s JOIN n{i} n ON s.cid = n.cid GROUP BY s.cid
  UNION ALL
  SELECT cid, id, f FROM c{i - 1} WHERE cid NOT IN (SELECT cid FROM n{i}))""")
    return ",\n".join(parts)


def centroid_long(name: str) -> str:
    return (f"SELECT cid, CAST(pos - 1 AS INTEGER) AS pos, round(v, {R}) AS value FROM "
            f"(SELECT cid, unnest(f) AS v, generate_subscripts(f, 1) AS pos FROM {name})")


sql("sample_fixed", f"WITH {PTS}\nSELECT id FROM pts ORDER BY {seeded_hash_sql('id', I.KMEANS_SEED)}, id "
    f"LIMIT {I.SAMPLE_SIZE}")
sql("kmeans_init", f"WITH {PTS},\n{init_cte()}\nSELECT cid, id FROM c0")
sql("euclidean", f"WITH {PTS},\n{init_cte()}\nSELECT p.id, round({dist_sql('p.f', 'c.f')}, {R}) AS dist "
    "FROM pts p, (SELECT f FROM c0 WHERE cid = 0) c")
sql("vector_add", f"""WITH {PTS}
SELECT id, CAST(pos - 1 AS INTEGER) AS pos, round(v, {R}) AS value FROM (
  SELECT id, unnest(list_transform(list_zip(f, list_transform(f, lambda x: x * 2.0)), lambda z: z[1] + z[2])) AS v,
         generate_subscripts(f, 1) AS pos FROM pts)""")
sql("nearest_centroid", f"WITH {PTS},\n{init_cte()},\n{assign_cte('a0', 'pts', 'c0')}\n"
    f"SELECT id, cid, round(dist, {R}) AS dist FROM a0")
sql("nearest_of_many", f"WITH {PTS},\n{init_cte(k=I.MANY_CENTROIDS)},\n{assign_cte('a0', 'pts', 'c0')}\n"
    f"SELECT id, cid, round(dist, {R}) AS dist FROM a0")
sql("cluster_sums", f"""WITH {PTS},
{init_cte()},
{assign_cte('a0', 'pts', 'c0')}
SELECT s.cid, n.n, CAST(s.pos - 1 AS INTEGER) AS pos, round(s.total, {R}) AS total FROM
  (SELECT cid, pos, sum(v) AS total FROM (
     SELECT a.cid, unnest(p.f) AS v, generate_subscripts(p.f, 1) AS pos FROM a0 a JOIN pts p ON a.id = p.id)
   GROUP BY cid, pos) s
JOIN (SELECT cid, count(*) AS n FROM a0 GROUP BY cid) n ON s.cid = n.cid""")
sql("kmeans_error", f"WITH {PTS},\n{init_cte()},\n{assign_cte('a0', 'pts', 'c0')}\n"
    "SELECT round(sum(dist), 6) AS error FROM a0")
sql("kmeans_step", f"WITH {kmeans_ctes(1)}\n{centroid_long('c1')}")
_KL = f"c{I.KMEANS_ITERATIONS}"
sql("kmeans_minibatch", f"WITH {kmeans_ctes(I.KMEANS_ITERATIONS)}\n{centroid_long(_KL)}")
sql("cluster_assign", f"WITH {kmeans_ctes(I.KMEANS_ITERATIONS)},\n{assign_cte('fa', 'pts', _KL)}\n"
    "SELECT id, cid FROM fa")
sql("kmeans_centroids_text", f"WITH {kmeans_ctes(I.KMEANS_ITERATIONS)}\n"
    f"SELECT cid, array_to_string(list_transform(f, lambda x: printf('%.6f', x)), chr(9)) || chr(9) AS line FROM {_KL}")

# ------------------------------------------------------- keyed tables, misc
sql("first_per_key", f"""
SELECT l_orderkey, round(list(l_extendedprice ORDER BY l_linenumber, l_partkey, l_extendedprice)[1], {R}) AS l_extendedprice
FROM lineitem GROUP BY l_orderkey""")
sql("upsert_latest", f"""
SELECT user_id, event_id, event_type, round(value, {R}) AS value, props, epoch_us(ts) AS ts_us FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
sql("delete_by_key", """
SELECT event_id, user_id FROM events
WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value >= 99.0)""")
sql("table_peek", f"""WITH top AS (SELECT * FROM supplier ORDER BY s_suppkey LIMIT {I.PEEK_ROWS})
SELECT CAST(s_suppkey AS VARCHAR) AS row_key, 's_name' AS qualifier, CAST(s_name AS VARCHAR) AS value FROM top
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 's_nationkey', CAST(s_nationkey AS VARCHAR) FROM top
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 's_acctbal', CAST(s_acctbal AS VARCHAR) FROM top""")
sql("manifest_pack", f"""
SELECT 'warcPaths_' || CAST(CAST(floor((row_number() OVER (ORDER BY url) - 1) / {I.MANIFEST_SIZE}) AS BIGINT) AS VARCHAR)
       || '.txt' AS manifest, url FROM pages""")

_PAGE_TREC = PAGE_TREC
_HDR_LINES = ["'WARC-Type: response'", "'WARC-Target-URI: ' || url", f"'WARC-TREC-ID: ' || {_PAGE_TREC}",
              "'Content-Length: ' || CAST(strlen(html) AS VARCHAR)", "'X-No-Colon-Flag'"]


def _hkey(ln: str) -> str:
    return f"trim(split_part({ln}, ':', 1))"


def _hval(ln: str) -> str:
    return f"(CASE WHEN instr({ln}, ':') > 0 THEN trim(substring({ln}, instr({ln}, ':') + 1)) ELSE '' END)"


sql("header_map", "\nUNION ALL\n".join(
    f"SELECT page_id, {_hkey(ln)} AS key, {_hval(ln)} AS value FROM pages" for ln in _HDR_LINES))

_HTTP_BODY = (f"({q(I.HTTP_PREFIX)} || CAST(strlen(html) AS VARCHAR) || chr(10) || chr(10) || html)")
sql("strip_http_header", f"""
SELECT page_id, length(b) AS n_chars, md5(b) AS md5 FROM (
  SELECT page_id, CASE WHEN instr(s, 'Content-Length') = 0 THEN s
                       WHEN instr(substring(s, instr(s, 'Content-Length')), '<') = 0 THEN ''
                       ELSE substring(s, instr(s, 'Content-Length') + instr(substring(s, instr(s, 'Content-Length')), '<') - 1)
                  END AS b
  FROM (SELECT page_id, {_HTTP_BODY} AS s FROM pages))""")
sql("command_lines", f"""
SELECT page_id, replace(replace({q(I.COMMAND_TEMPLATE)}, '#_INPUTFILE_#', 'data/' || CAST(page_id AS VARCHAR) || '.fa'),
                        '#_OUTPUTFILE_#', 'out/' || CAST(page_id AS VARCHAR) || '.tab') AS command FROM pages""")
sql("parse_datetime", """
SELECT event_id, text, CAST(epoch(strptime(text, '%Y-%m-%dT%H:%M:%S')) AS BIGINT) AS epoch_s
FROM (SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS text FROM events)""")
sql("seconds_between", """
SELECT l.l_orderkey, l.l_linenumber,
       CAST(trunc((epoch_ms(l.l_shipdate) - epoch_ms(o.o_orderdate)) / 1000.0) AS BIGINT) AS secs
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
sql("vectors_from_csv", f"""
SELECT vec_id AS id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
       round(CAST(unnest(embedding) AS DOUBLE), {R}) AS value FROM embeddings""")
sql("hits_best", f"""
SELECT CAST(l_orderkey AS VARCHAR) AS query_id,
       list(CAST(l_partkey AS VARCHAR) ORDER BY l_extendedprice DESC, l_discount, CAST(l_partkey AS VARCHAR))[1] AS best_subject,
       round(max(l_extendedprice), {R}) AS best_bit_score,
       round(list(l_discount ORDER BY l_extendedprice DESC, l_discount, CAST(l_partkey AS VARCHAR))[1], {R}) AS best_evalue,
       count(*) AS n_hits
FROM lineitem GROUP BY l_orderkey""")
sql("numbers_stats", ORACLE["stats_global"])


def shingle_rows(id_col: str, text_col: str, table: str) -> str:
    k = I.SHINGLE_K
    return (f"SELECT DISTINCT {id_col} AS id, array_to_string(t[i:i + {k - 1}], ' ') AS sh FROM ("
            f"SELECT {id_col}, t, unnest(range(1, len(t) - {k - 2})) AS i FROM ("
            f"SELECT {id_col}, {tokens_expr(text_col)} AS t FROM {table}))")


sql("seed_similarity", f"""WITH qs AS ({shingle_rows('item_id', 'text', 'benchmark')}),
ds AS ({shingle_rows('doc_id', 'text', 'documents')}),
qsz AS (SELECT id, count(*) AS q_shingles FROM qs GROUP BY id)
SELECT q.id AS item_id, d.id AS doc_id, count(*) AS shared, z.q_shingles
FROM qs q JOIN ds d ON q.sh = d.sh JOIN qsz z ON z.id = q.id
GROUP BY q.id, d.id, z.q_shingles
HAVING count(*) >= least(z.q_shingles, greatest({I.MIN_SHARED}, CAST(ceil(z.q_shingles * {I.CONTAINMENT}) AS BIGINT)))""")

# --------------------------------------------------------- archives and files
_BODY = (f"({q(I.HTTP_PREFIX)} || CAST(strlen(html) AS VARCHAR) || chr(10) || chr(10) || html)")
sql("warc_records", f"""
SELECT {_PAGE_TREC} AS trec_id, url AS uri, CAST(strlen({_BODY}) AS INTEGER) AS content_length
FROM pages""")
sql("pages_from_warc", f"""
SELECT {doc_key_expr(_PAGE_TREC)} AS doc_id, url AS uri, {html_text_sql('html')} AS content FROM pages
WHERE {html_text_sql('html')} IS NOT NULL""")

sql("kmeans_error_trace", f"WITH {kmeans_ctes(I.KMEANS_ITERATIONS)}\n" + "\nUNION ALL\n".join(
    f"SELECT CAST({i} AS INTEGER) AS iteration, round(sum(dist), 6) AS error FROM a{i}"
    for i in range(1, I.KMEANS_ITERATIONS + 1)))

sql("pagerank_kv_text", ORACLE["pagerank"])

sql("hits_from_files", ORACLE["hits_best"])

sql("edges_from_adjacency_files", ORACLE["edges_from_adjacency"])

sql("read_manifests", ORACLE["warc_records"])
sql("warc_split_records", ORACLE["warc_records"])
sql("file_inventory", """
SELECT 'bucket=' || CAST(page_id % 7 AS VARCHAR) AS folder, count(DISTINCT page_id // 1000) AS files,
       CAST(sum(strlen(html) + 1) AS BIGINT) AS bytes FROM pages GROUP BY page_id % 7""")
sql("load_tables", f"""WITH {SEARCH_CTE}
SELECT 'pages' AS name, count(*) AS n FROM pages_t UNION ALL SELECT 'page_rank', count(*) FROM doc_ranks
UNION ALL SELECT 'postings', count(*) FROM post UNION ALL SELECT 'word_count', count(DISTINCT term) FROM post""")
sql("keyed_store_put", ORACLE["upsert_latest"])
sql("keyed_store_delete", ORACLE["upsert_latest"].replace("FROM events", "FROM (SELECT * FROM events WHERE user_id NOT IN "
    "(SELECT user_id FROM events WHERE event_type = 'error' AND value >= 99.0 AND user_id IS NOT NULL)) AS left_over"))
sql("segment_postings", f"""WITH crawled AS (
  SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) THEN text || ' ' || text ELSE text END AS text
  FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL))
SELECT doc_id, term, tf FROM {_DOC_POST.replace('FROM documents', 'FROM crawled')}""")
sql("outputs_by_input", """
SELECT source AS file_name, 'documents ' || CAST(count(*) AS VARCHAR) AS line FROM documents GROUP BY source""")
sql("vectors_from_files", f"""
SELECT CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, round(CAST(unnest(embedding) AS DOUBLE), {R}) AS value
FROM embeddings""")


# A passage of at least MIN_SCORE / MATCH words that lies whole in a document: its words joined by a
# character that is in no token, looked up in the document's.
def _joined(col: str) -> str:
    return f"(' ' || array_to_string({tokens_expr(col)}, ' ') || ' ')"


sql("passage_hits_whole", f"""
SELECT DISTINCT b.item_id, d.doc_id, CAST(b.n AS INTEGER) AS aln_length, 1 AS q_start, CAST(b.n AS INTEGER) AS q_end,
       CAST({ALIGN.MATCH} * b.n AS INTEGER) AS score
FROM (SELECT item_id, {_joined('text')} AS s, len({tokens_expr('text')}) AS n FROM benchmark) b
JOIN (SELECT doc_id, {_joined('text')} AS s FROM documents) d ON contains(d.s, b.s)
WHERE b.n >= {max(ALIGN.SEED_WORDS, -(-ALIGN.MIN_SCORE // ALIGN.MATCH))}""")
