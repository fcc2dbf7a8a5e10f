"""DuckDB SQL for the queries that SQL can express, written without the operators' code."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"

# Control strings of the chat template (fixed values); each occurrence and each backslash adds one character.
_CONTROL = ("<</SYS>>", "<<SYS>>", "[/INST]", "[INST]", "</s>", "<s>", "<|", "|>")


def _escaped_length(x: str) -> str:
    one = [f"(length({x}) - length(replace({x}, '{c}', ''))) // {len(c)}" for c in (*_CONTROL, chr(92))]
    return f"(length({x}) + {' + '.join(one)})"


OP7 = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
per AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum({_escaped_length('role')} + {_escaped_length('text')} + 10) AS formatted_chars
  FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM per"""

OP5 = f"""
WITH docs AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
windows AS (
  SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM docs WHERE len(w) >= 50)),
first AS (SELECT h, min(doc_id) AS d FROM windows GROUP BY h),
gone AS (
  SELECT doc_id, list(DISTINCT q) AS qs
  FROM (SELECT x.doc_id, unnest(range(x.p, x.p + 50)) AS q FROM windows x JOIN first f ON x.h = f.h WHERE f.d < x.doc_id)
  GROUP BY doc_id),
marked AS (
  SELECT d.doc_id, d.w, coalesce(g.qs, []) AS qs FROM docs d LEFT JOIN gone g ON d.doc_id = g.doc_id),
kept AS (SELECT doc_id, w, len(qs) AS n, CASE WHEN len(qs) = 0 THEN w ELSE
           list_filter(w, lambda x, i: NOT list_contains(qs, i)) END AS k FROM marked)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n AS BIGINT) AS n_removed,
       sha256(array_to_string(k, ' ')) AS kept_sha256
FROM kept"""

ORACLE = {"op5_substring_dedup": OP5, "op7_chat_format": OP7}


def _op10(steps: int = 120) -> str:
    """Rules by hand, links by RE2; trust and distrust and what full seeds everywhere would give by a recursive
    power iteration, one row per direction and host."""
    link = r"""(?i)\bhref\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.\-]{0,20}:)?//([^/?#"''\s<>]+)"""
    lower = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    under = lambda h: f"(host = '{h}' OR ends_with(host, '.{h}'))"
    return f"""
WITH RECURSIVE pg AS (
  SELECT page_id, {lower.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path, html FROM pages),
judged AS (SELECT page_id, host, path, html,
  CASE WHEN {under('www.example.com')} AND starts_with(path, '/en/') THEN 'www.example.com/en/'
       WHEN {under('example.com')} AND starts_with(path, '/en/') THEN 'example.com/en/'
       WHEN {under('net')} AND starts_with(path, '/es/') THEN 'net/es/'
       WHEN {under('net')} AND starts_with(path, '/fr/') THEN 'net/fr/'
       WHEN {under('com')} AND starts_with(path, '/') THEN 'com/' END AS rule FROM pg),
said AS (SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS by_rule FROM judged),
links AS (SELECT src, {lower.format('dst')} AS dst, count(*) AS n FROM (
  SELECT host AS src, unnest(regexp_extract_all(html, '{link}', 1)) AS dst FROM pg)
  WHERE src <> {lower.format('dst')} AND src <> '' GROUP BY 1, 2),
shares AS (SELECT host, avg((by_rule IS NOT DISTINCT FROM 'allow')::INT) AS t0, avg((by_rule IS NOT DISTINCT FROM 'block')::INT) AS d0
           FROM said GROUP BY host UNION ALL SELECT DISTINCT dst, 0.0, 0.0 FROM links),
seeds AS (SELECT unnest([{{'dir': 't', 'seed': max(t0)}}, {{'dir': 'd', 'seed': max(d0)}}], recursive := true), host FROM shares GROUP BY host),
arcs AS MATERIALIZED (
  SELECT 't' AS dir, src AS a, dst AS b, n / sum(n) OVER (PARTITION BY src) AS w FROM links
  UNION ALL SELECT 'd', dst, src, n / sum(n) OVER (PARTITION BY dst) FROM links
  -- a host without arcs keeps its own mass; the zeros keep every host in the sums
  UNION ALL SELECT s.dir, host, host, (NOT EXISTS (SELECT 1 FROM links l WHERE host = CASE s.dir WHEN 't' THEN l.src ELSE l.dst END))::INT FROM seeds s),
steps AS (
  SELECT 0 AS i, dir, host, seed AS x, 1.0::DOUBLE AS most FROM seeds
  UNION ALL
  SELECT p.i + 1, a.dir, a.b, 0.15 * max(s.seed) + 0.85 * sum(a.w * p.x), 0.15 + 0.85 * sum(a.w * p.most)
  FROM steps p JOIN arcs a ON a.dir = p.dir AND a.a = p.host JOIN seeds s ON s.dir = a.dir AND s.host = a.b
  WHERE p.i < {steps} GROUP BY p.i, a.dir, a.b),
final AS (SELECT p.dir, p.host, greatest(s.seed, p.x / p.most) AS v FROM steps p JOIN seeds s ON s.dir = p.dir AND s.host = p.host WHERE i = {steps})
SELECT j.page_id, j.host, j.path, j.rule,
       coalesce(j.by_rule, CASE WHEN d.v > t.v + 1e-9 AND d.v >= 0.5 - 1e-9 THEN 'block' ELSE 'allow' END) AS verdict
FROM said j JOIN final t ON t.host = j.host AND t.dir = 't' JOIN final d ON d.host = j.host AND d.dir = 'd'"""


ORACLE["op10_filter_urls"] = _op10()


_BITS60 = "('0x' || substr(md5({0}), 1, 15))::BIGINT"

ORACLE["op3_mix_sources"] = f"""
WITH docs AS (
  SELECT doc_id, source, CAST(len({_WORDS.format('text')}) AS BIGINT) AS size,
         {_BITS60.format("'20240:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))")} AS key
  FROM documents),
sources AS (
  SELECT source, sum(size) AS size, 2.0::DOUBLE * sum(size) AS cap,
         [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM docs GROUP BY source),
ranked AS (  -- the sources that stop at their cap are the first in this order
  SELECT *, sum(cap) OVER o AS caps, sum(w) OVER () - sum(w) OVER o AS rest_w,
         row_number() OVER (ORDER BY cap / w, source) AS k, lead(cap / w) OVER (ORDER BY cap / w, source) AS next
  FROM sources WINDOW o AS (ORDER BY cap / w, source ROWS UNBOUNDED PRECEDING)),
steps AS (
  SELECT 0 AS k, (SELECT 1.5 * sum(size) / sum(w) FROM sources) AS level, (SELECT min(cap / w) FROM sources) AS next
  UNION ALL SELECT k, CASE WHEN rest_w > 0 THEN ((SELECT 1.5 * sum(size) FROM sources) - caps) / rest_w END, next FROM ranked),
found AS (SELECT level FROM steps WHERE next IS NULL OR level <= next ORDER BY k LIMIT 1),
goals AS (
  SELECT source, size AS source_size, least(cap, coalesce(w * (SELECT level FROM found), cap)) AS target FROM sources),
placed AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, CAST(floor(g.target + 0.5) AS BIGINT) AS quota,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source),
epochs AS (SELECT *, CASE WHEN source_size > 0 THEN quota // source_size ELSE 0 END AS whole FROM placed)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, round(target, 6) AS target,
       CAST(whole * size + least(greatest(quota - whole * source_size - before, 0), size) AS BIGINT) AS taken
FROM epochs"""

_STEP = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"


def _crc_table() -> str:
    """CRC-32 of every byte: eight shifts with the reversed polynomial 0xEDB88320."""
    steps = ["SELECT i, i::BIGINT AS v FROM range(256) AS r(i)"]
    for _ in range(8):
        steps.append(f"SELECT i, {_STEP.format('v')} AS v FROM ({steps[-1]})")
    return f"SELECT list(v ORDER BY i) AS t FROM ({steps[-1]})"


ORACLE["op4_shard_documents"] = f"""
WITH crc AS MATERIALIZED ({_crc_table()}),
docs AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, {_BITS60.format("coalesce(text, '')")} AS k,
         hex(encode(coalesce(text, ''))) AS hx FROM documents),
upto AS (SELECT *, sum(size) OVER (ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) AS s, sum(size) OVER () AS total FROM docs),
cuts AS (
  SELECT j, arg_min(k, (k, doc_id)) AS k, arg_min(doc_id, (k, doc_id)) AS id
  FROM upto, unnest(range(1, 8)) AS g(j) WHERE s - size / 2.0 >= total * j // 8 GROUP BY j),
groups AS (
  SELECT c.j, c.k, c.id, sum(d.size) AS a, coalesce(sum(d.size) FILTER (d.doc_id < c.id), 0) AS low
  FROM cuts c JOIN docs d ON d.k = c.k GROUP BY c.j, c.k, c.id),
moved AS (
  SELECT j, CASE WHEN a > 0.02 * (SELECT sum(size) FROM docs) / 8 OR low * 2 <= a THEN k ELSE k + 1 END AS k,
         CASE WHEN a > 0.02 * (SELECT sum(size) FROM docs) / 8 THEN id ELSE -9223372036854775808 END AS id
  FROM groups),
placed AS (
  SELECT doc_id, size, k, hx, CAST((SELECT count(*) FROM moved m WHERE (m.k, m.id) <= (d.k, d.doc_id)) AS INTEGER) AS shard FROM docs d)
SELECT doc_id, size, xor(list_reduce(list_transform(regexp_extract_all(hx, '..'), lambda h: ('0x' || h)::BIGINT),
         lambda acc, x: xor(acc >> 8, t[(xor(acc, x) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY k, doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM placed, crc"""


ORACLE["op12_collocations"] = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
phrases AS (
  SELECT lang, g, count(*) AS f FROM (
    SELECT lang, w[i:i + k - 1] AS g FROM (
      SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, unnest(range(1, 6)) AS s(k) WHERE len(w) >= k))
  GROUP BY lang, g HAVING count(*) >= 100),
inside AS (
  SELECT lang, g, max(f) AS longer FROM (
    SELECT lang, g[:len(g) - 1] AS g, f FROM phrases WHERE len(g) > 2 UNION ALL SELECT lang, g[2:], f FROM phrases WHERE len(g) > 2)
  GROUP BY lang, g),
kept AS (
  SELECT p.lang, p.g, p.f AS a FROM phrases p LEFT JOIN inside i ON p.lang = i.lang AND p.g = i.g
  WHERE len(p.g) >= 2 AND (i.longer IS NULL OR i.longer < p.f)),
cuts AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM kept),
scored AS (
  SELECT c.lang, c.g, c.a, c.k, l.f AS l, r.f AS r, t.n,
         CAST((1000::HUGEINT * c.a * t.n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang JOIN phrases l ON l.lang = c.lang AND l.g = c.g[:c.k]
  JOIN phrases r ON r.lang = c.lang AND r.g = c.g[c.k + 1:]),
best AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, n, arg_min({'l': l, 'r': r, 'score': score}, (score, k)) AS b
         FROM scored GROUP BY lang, g, a, n),
ranked AS (
  SELECT lang, phrase, a, b.l AS l, b.r AS r, n, b.score AS score,
         row_number() OVER (PARTITION BY lang ORDER BY b.score DESC, a DESC, encode(phrase)) AS rank FROM best)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000"""


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLE["op13_rank_documents"] = f"""
WITH docs AS (SELECT doc_id, {_TERMS} AS ts FROM documents),
stats AS (SELECT count(*) AS nn, sum(len(ts))::BIGINT AS ll FROM docs WHERE len(ts) > 0),
tfs AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, len(ts) AS n, unnest(ts) AS t FROM docs) GROUP BY ALL),
dfs AS (SELECT t, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tfs, stats GROUP BY t, nn),
items AS (SELECT item_id, t, count(*) AS c FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY ALL),
scored AS (
  SELECT i.item_id, f.doc_id,
         sum(i.c * d.w * ((1000000000 * f.tf) // (1000 * f.tf + 8 * (25 + (75 * f.n * nn) // ll))))::BIGINT AS score
  FROM items i JOIN dfs d ON d.t = i.t JOIN tfs f ON f.t = i.t, stats GROUP BY i.item_id, f.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10"""
