"""Spark queries vs their DuckDB twins on the smallest driver tables (the correctness gate, locally)."""
import duckdb
import pytest

import __spark_entry__ as E
from tools.compare import TABLES, digest

SF = "/root/testdata/sf0.001"
FAST = ["dedup_first", "sanity_trim", "street_reference", "supply_alert", "deed_trend", "money_numbers",
        "address_normalise", "value_counts", "stream_counters"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]


def test_every_query_has_a_callable_and_entry_runs(spark):
    qs = E.queries()
    assert len(qs) >= 50
    assert E.entry(spark).count() > 0
