"""Every query with an oracle matches DuckDB on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import _rows
from staylens.sources.tables import TABLES

from conftest import SF_SMALL

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    got_cols, got = _rows(E.queries()[name](spark, SF_SMALL).toPandas())
    want_cols, want = _rows(con.execute(ORACLE[name]).df())
    assert got_cols == want_cols
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["market_segment", "cancel_rate"]
    assert len(rows) > 0
    assert [r["cancel_rate"] for r in rows] == sorted((r["cancel_rate"] for r in rows), reverse=True)
