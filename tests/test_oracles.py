"""Every registered query against its SQL on DuckDB, over the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import TABLES, multiset  # noqa: E402
from suite.catalog import ORACLES, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, sf, name):
    df = QUERIES[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    assert len(set(df.columns)) == len(df.columns)
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert multiset(df.columns, got) == multiset(names, result.fetchall())


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
