"""Every registered query with an oracle equals its DuckDB SQL on sf0.001
(row count, column names, order-insensitive values)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from ticktale.sources.tables import TABLES
from tools.oracle_check import rows_key

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(r[i] for i in idx) for r in cur.fetchall()]
    assert len(srows) == len(drows)
    assert rows_key(srows) == rows_key(drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "sharpe" in df.columns
