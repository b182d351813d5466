"""Every registered query against its SQL in DuckDB on the smallest driver tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidemark.adapters import ADAPTERS, BASE_TABLES, Tables, oracle_text
from tools.check import compare

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in BASE_TABLES:
        c.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    problem, _ = compare(queries()[name](spark, DATA), con, oracle_sql()[name])
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(ADAPTERS))
def test_adapter_is_equal_on_both_engines(spark, con, name):
    problem, n = compare(getattr(Tables(spark, DATA), name), con, oracle_text(f"select * from {name}"))
    assert problem is None and n > 0, problem


def test_entry(spark):
    assert entry(spark).count() > 0
