"""Property tests: Column expressions against plain statements of their rules,
and Spark against the SQL oracle's engine on random inputs."""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from webloom.functions import text as T
from webloom.plans.oracle import is_number_expr, tokens_expr

ALPHABET = "0123456789abcdefxyzé.,;:'_- ABCÉ0x"


def number_rule(tok: str) -> bool:
    """The number-string rule in words: lower-case; '0x' + at least one hex
    digit is a number; otherwise only digits, ',', '.', a-f, at most one '.',
    and not both a hex letter and a '.'."""
    t = tok.lower()
    if t.startswith("0x"):
        return len(t) > 2 and all(c.isdigit() or c in "abcdef" for c in t[2:])
    dots = t.count(".")
    hexl = any(c in "abcdef" for c in t)
    other = any(not (c.isdigit() or c in ",.abcdef") for c in t)
    return not other and dots <= 1 and not (hexl and dots > 0)


words = st.text(alphabet=ALPHABET, max_size=12)


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(words, min_size=1, max_size=40))
def test_number_rule(spark, toks):
    df = spark.createDataFrame([(t,) for t in toks], "s string")
    got = [r[0] for r in df.select(T.is_number_string("s")).collect()]
    assert got == [number_rule(t) for t in toks]
    con = duckdb.connect()
    sql = [r[0] for r in con.execute(
        f"SELECT {is_number_expr('s')} FROM (SELECT unnest(?::VARCHAR[]) AS s)", [toks]).fetchall()]
    assert sql == got


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=ALPHABET + "\n\t!?", max_size=60), min_size=1, max_size=10))
def test_tokenizer_spark_equals_sql(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [list(r[0]) for r in df.select(T.tokenize("s")).collect()]
    con = duckdb.connect()
    sql = [list(r[0]) for r in con.execute(
        f"SELECT {tokens_expr('s')} FROM (SELECT unnest(?::VARCHAR[]) AS s, generate_subscripts(?::VARCHAR[], 1) AS i) ORDER BY i",
        [texts, texts]).fetchall()]
    assert got == sql


HTML_CASES = [
    "<p>it&#8217;s &#x27;q&#X27; &#38;lt; &amp;#65; &#0; &#65;&amp;</p>",
    '<html><head><title>T &amp; U</title><script>var t="</p>";</script></head><body><!-- c --><p>a<b>b</b></p></body>',
    "<div>\n  spaced   \n</div><p>&copy; &middot; &#128512;</p><br>tail",
    "no tags at all &lt;x&gt;",
    "",
]


def test_html_text_spark_equals_sql(spark):
    from webloom.functions.html import html_to_text
    from webloom.plans.oracle import html_text_sql
    df = spark.createDataFrame([(i, h) for i, h in enumerate(HTML_CASES)], "i int, html string")
    got = [r[0] for r in df.orderBy("i").select(html_to_text("html")).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT * FROM (SELECT unnest(?::VARCHAR[]) AS html, "
                "generate_subscripts(?::VARCHAR[], 1) AS i)", [HTML_CASES, HTML_CASES])
    sql = [r[0] for r in con.execute(f"SELECT {html_text_sql('html')} FROM t ORDER BY i").fetchall()]
    assert got == sql


def pagerank_numpy(edges, nodes, iterations, d=0.85):
    """Power iteration in plain NumPy: every id starts at 1/N, duplicate edges
    count, dangling mass is spread over all N nodes."""
    import numpy as np
    ids = sorted(set(nodes) | {s for s, _ in edges} | {t for _, t in edges})
    pos = {v: i for i, v in enumerate(ids)}
    n = len(ids)
    out = np.zeros(n)
    for s, _ in edges:
        out[pos[s]] += 1
    r = np.full(n, 1.0 / n)
    for _ in range(iterations):
        nxt = np.zeros(n)
        for s, t in edges:
            nxt[pos[t]] += r[pos[s]] / out[pos[s]]
        dangling = r[out == 0].sum()
        r = (1 - d) / n + d * (nxt + dangling / n)
    return {v: r[pos[v]] for v in ids}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 12)), max_size=30),
       st.lists(st.integers(0, 14), max_size=5), st.integers(0, 4), st.booleans())
def test_pagerank_matches_numpy(spark, edges, extra_nodes, iterations, salted):
    import pytest
    from webloom.operators import graph as G
    if not edges and not extra_nodes:
        return
    e = spark.createDataFrame(edges, "src long, dst long")
    nodes = spark.createDataFrame([(x,) for x in extra_nodes], "id long")
    got = {r.id: r.rank for r in G.pagerank(e, nodes, iterations=iterations,
                                             salt_chunk=1 if salted else 1_000_000).collect()}
    want = pagerank_numpy(edges, extra_nodes, iterations)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-12)
