"""Every registered query runs, and agrees with its SQL counterpart on the smallest data."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.base import QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    from verify import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_sql_names_are_registered():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    from verify import compare

    got = queries()[name](spark, DATA)
    sql = oracle_sql().get(name)
    if sql is None:
        assert got.count() >= 0
    else:
        assert compare(got.toPandas(), duck.sql(sql).df()) == "ok"
