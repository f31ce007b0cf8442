"""DuckDB parity for every SQL-checked query on sf0.001 (the driver repeats
this at sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.parity import TABLES, rows_of


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_parity(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    a, ac = rows_of(sdf.columns, [tuple(r) for r in sdf.collect()])
    res = con.sql(E.oracle_sql()[name])
    b, bc = rows_of(res.columns, res.fetchall())
    assert ac == bc
    assert len(a) == len(b)
    assert a == b


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "AQI_Category" in df.columns
