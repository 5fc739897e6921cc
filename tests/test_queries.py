"""Every registered query against its SQL at the smallest scale; the rest must give rows."""

import os
import sys

import duckdb
import pytest

from conftest import SF_DIR

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry
from refloom.session import TABLES
from tools.check import rows_of

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert got
        return
    res = duck.execute(SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, got) == rows_of(cols, res.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
