import duckdb
import pytest

import __spark_entry__ as E
from webloom.llm.queries import oracle_sql

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, name, sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/{sf}/{t}.parquet')")
    want = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in want.description]
    got = E.queries()[name](spark, f"/root/testdata/{sf}")
    assert got.columns == cols
    rnd = lambda rows: sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=str)
    assert rnd(map(tuple, got.collect())) == rnd(want.fetchall())


def test_registry():
    names = [n for n in E.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14)) and "pipeline" in E.queries()
