"""Physical plans that must hold at scale."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.adapters import Tables
from tidemark.operators import aggregates as a
from tidemark.operators import joins as j
from tidemark.operators import subqueries as s
from tidemark.registry import QUERIES
from tidemark.sources import tables

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not present")


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, DATA)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(t):
    text = plan(QUERIES["b19_filter_gt"](t.spark, DATA))
    assert "GreaterThan(l_extendedprice,50000" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in text


def test_pruned_read_filters_partitions(t, tmp_path):
    tables.save_table(t.tips, "pruned_tips", ["day"], str(tmp_path / "tips"))
    df = tables.pruned_read(t.spark, "pruned_tips", F.col("day") == "N")
    assert "PartitionFilters: [isnotnull(day" in plan(df)
    # one file per partition value, not one per task and value
    place = tables.table_location(t.spark, "pruned_tips")
    detail = tables.table_detail(t.spark, place)
    assert (detail.first().file_count, detail.first().num_rows) == (3, t.tips.count())
    assert detail.first().size_in_bytes == sum(f.stat().st_size for f in (tmp_path / "tips").rglob("*.parquet"))
    assert "content" not in plan(detail)


def test_column_profile_is_one_pass(t):
    df = t.spark.createDataFrame([(1, None), (None, None)], "`a.b` int, c string")
    assert [tuple(r) for r in tables.column_profile(df).collect()] == [(0, "a.b", "int", 1), (1, "c", "string", 0)]
    assert plan(tables.column_profile(t.tips)).count("Scan parquet") == 1


def test_not_exists_is_an_anti_join_on_distinct_keys(t):
    text = plan(s.unsold_products(t.shop_products, t.shop_lines))
    assert "LeftAnti" in text and "HashAggregate" in text


def test_facts_are_reduced_before_the_join(t):
    text = plan(a.revenue_per_customer(t.shop_customers, t.shop_orders, t.shop_lines))
    above_scan = text[: text.index("lineitem.parquet")]
    assert above_scan.rindex("partial_sum") > above_scan.rindex("Join")
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_outer_join_lets_the_hot_side_split(t):
    text = plan(j.customers_with_orders(t.shop_customers, t.shop_orders))
    assert "LeftOuter" not in text


def test_top_n_keeps_a_heap_per_task(t):
    assert "TakeOrderedAndProject" in plan(QUERIES["b10_top_n"](t.spark, DATA))


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n[0] in "bcdeg"))
def test_no_python_rows_and_no_cartesian_product(t, name):
    """Plans of the cheap-to-build queries stay in the JVM."""
    text = plan(QUERIES[name](t.spark, DATA))
    assert "PythonUDF" not in text and "BatchEvalPython" not in text and "CartesianProduct" not in text
