"""Queries that SQL can express against DuckDB, and all queries' contracts, on the smallest driver tables."""
import duckdb
import pytest

from quadra.llm.queries import ORACLE, QUERIES
from tools.compare import digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    columns = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(columns) and len(rows) == len(want)
    assert digest(df.columns, rows)[0] == digest(columns, want)[0]


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")} == set(range(1, 14)) and "pipeline" in QUERIES
