"""Rebuild of the star schema: dimensions first, then facts, each an idempotent overwrite."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import star
from tidemark.session import side_by_side, staged
from tidemark.sources.snapshots import SnapshotTable

#: What the star schema takes from an order item.
SALE_COLUMNS = ("order_id", "customer_id", "product_id", "full_date", "quantity", "unit_price")


def build_warehouse(
    spark: SparkSession,
    folder: str,
    sale_lines: DataFrame,
    customer_snapshots: DataFrame,
    product_snapshots: DataFrame,
    customer_tracked: Sequence[str],
    product_tracked: Sequence[str],
) -> dict[str, DataFrame]:
    """Publish all tables and return them.

    Dimensions are read back from their files, so the joins of the fact
    build know their sizes. Facts are laid out by month, which lets a query
    over one period skip the rest.
    """
    tables = {
        "dim_date": SnapshotTable(spark, f"{folder}/dim_date"),
        "dim_customer": SnapshotTable(spark, f"{folder}/dim_customer"),
        "dim_product": SnapshotTable(spark, f"{folder}/dim_product"),
        "fact_sales": SnapshotTable(spark, f"{folder}/fact_sales", partition_by=["date_month"]),
        "fact_sales_daily": SnapshotTable(spark, f"{folder}/fact_sales_daily"),
    }
    tables["dim_date"].write(star.dim_date_for(sale_lines, "full_date"), "REBUILD")
    tables["dim_customer"].write(star.dim_customer(customer_snapshots, customer_tracked), "REBUILD")
    tables["dim_product"].write(star.dim_product(product_snapshots, product_tracked), "REBUILD")
    facts = star.fact_sales(sale_lines, tables["dim_customer"].read(), tables["dim_product"].read())
    facts = facts.withColumn("date_month", F.floor(F.col("date_key") / 100).cast("int"))
    tables["fact_sales"].write(facts, "REBUILD", last_step=star.with_fact_key)
    tables["fact_sales_daily"].write(star.fact_sales_daily(tables["fact_sales"].read()), "REBUILD")
    return {name: table.read() for name, table in tables.items()}


def _refreshed_dimension(
    spark: SparkSession, folder: str, name: str, updates: DataFrame, facts: DataFrame, key: str, tracked: Sequence[str], out: str
) -> DataFrame:
    """Merge dated updates into the versions, cover all facts, and number the versions by the key map."""
    versions = SnapshotTable(spark, f"{folder}/{name}_versions")
    known = None if versions.current_version() is None else versions.read()
    versions.write(star.scd2_merge(known, updates, key, tracked, "snapshot_date"), "MERGE")
    covering = star.with_inferred_members(versions.read(), facts, key, tracked, "full_date")
    numbers = SnapshotTable(spark, f"{folder}/{name}_keys")
    before = None if numbers.current_version() is None else numbers.read()
    dimension, keys = star.member_keys(covering, before, key, out)
    numbers.write(keys, "EXTEND")
    table = SnapshotTable(spark, f"{folder}/{name}")
    table.write(star.with_unknown_member(dimension, out), "MERGE")
    return table.read()


def refresh_warehouse(
    spark: SparkSession,
    folder: str,
    sale_lines: DataFrame,
    customer_updates: DataFrame,
    product_updates: DataFrame,
    customer_tracked: Sequence[str],
    product_tracked: Sequence[str],
) -> dict[str, DataFrame]:
    """Publish the star schema after new, late or repeated dimension updates; numbers once given stay.

    Every fact has a customer and a product: a member that no update has named yet is inferred, a missing key is the
    unknown member. Updates are what came since the last run, order items are all. Order items are read for each
    dimension and for the facts, so the join or whatever they come from is worked out once and written. The dimensions
    do not need each other and are refreshed side by side.
    """
    sale_lines = staged(sale_lines.select(*SALE_COLUMNS), "sale-lines")
    customers, products = side_by_side(
        spark,
        lambda: _refreshed_dimension(
            spark, folder, "dim_customer", customer_updates, sale_lines, "customer_id", customer_tracked, "customer_key"
        ),
        lambda: _refreshed_dimension(
            spark, folder, "dim_product", product_updates, sale_lines, "product_id", product_tracked, "product_key"
        ),
    )
    facts = star.fact_sales(sale_lines, customers, products)
    unknown = F.lit(star.UNKNOWN_MEMBER).cast("bigint")
    facts = facts.withColumns({k: F.coalesce(k, unknown) for k in ("customer_key", "product_key")})
    facts = facts.withColumn("date_month", F.floor(F.col("date_key") / 100).cast("int"))
    table = SnapshotTable(spark, f"{folder}/fact_sales", partition_by=["date_month"])
    table.write(facts, "REBUILD", last_step=star.with_fact_key)
    daily = SnapshotTable(spark, f"{folder}/fact_sales_daily")
    daily.write(star.fact_sales_daily(table.read()), "REBUILD")
    return {"dim_customer": customers, "dim_product": products, "fact_sales": table.read(), "fact_sales_daily": daily.read()}
