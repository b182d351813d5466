"""Rank, running, lag and moving-frame reports.

Global ranks apply to aggregated rows only; these are written out once and
then measured and ranked. Group averages and shares join
the aggregate back instead of sorting the group in a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregates import freight_per_shipper
from tidemark.operators.joins import (
    keys_of,
    revenue_by_order_key,
    revenue_by_product,
    revenue_per_supplier_all,
)
from tidemark.operators.skew import (
    attach,
    lagged,
    moving_average,
    numbered,
    ranked,
    running_total,
    with_group_stats,
)
from tidemark.session import staged


def price_rank_in_category(products: DataFrame) -> DataFrame:
    return ranked(products, ["category_id"], "unit_price", "price_rank").select(
        "category_id", "product_id", "product_name", "unit_price", "price_rank"
    )


def running_freight(orders: DataFrame) -> DataFrame:
    """Freight summed over a customer's orders by date; orders of one day share the total."""
    df = orders.select("customer_id", "order_id", "order_date", "freight")
    return running_total(df, ["customer_id"], "order_date", "freight", "running_freight").drop("freight")


def order_sequence(orders: DataFrame) -> DataFrame:
    df = orders.select("employee_id", "order_id", "order_date")
    return numbered(df, ["employee_id"], [F.col("order_date"), F.col("order_id")], "order_sequence")


def price_and_supplier_average(products: DataFrame) -> DataFrame:
    return with_group_stats(
        products.select("product_id", "product_name", "unit_price", "supplier_id"),
        ["supplier_id"],
        F.avg("unit_price").alias("avg_supplier_price"),
    ).drop("supplier_id")


def freight_and_country_average(orders: DataFrame) -> DataFrame:
    return with_group_stats(
        orders.select("ship_country", "order_id", "freight"),
        ["ship_country"],
        F.avg("freight").alias("avg_country_freight"),
    )


def employee_order_rank(employees: DataFrame, orders: DataFrame) -> DataFrame:
    counts = (
        orders.groupBy("employee_id")
        .agg(F.count("order_id").alias("total_orders"))
        .join(keys_of(employees, "employee_id"), "employee_id", "left_semi")
    )
    return ranked(staged(counts), [], "total_orders", "employee_rank")


def running_quantity(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Quantity of a product sold up to each line's order date."""
    dated = lines.select("order_id", "line_no", "product_id", "quantity").join(
        orders.select("order_id", "order_date"), "order_id"
    )
    return running_total(dated, ["product_id"], "order_date", "quantity", "running_quantity", sizes=lines).select(
        "product_id", "order_date", "running_quantity"
    )


def supplier_revenue_rank(
    suppliers: DataFrame, products: DataFrame, lines: DataFrame, digits: int = 4
) -> DataFrame:
    """Suppliers by revenue; rounding before the rank keeps equal sums equal."""
    revenue = (
        revenue_per_supplier_all(suppliers, products, lines)
        .filter(F.col("revenue").isNotNull())
        .select("company_name", F.round("revenue", digits).alias("total_revenue"))
    )
    return ranked(staged(revenue), [], "total_revenue", "supplier_rank")


def customer_row_in_country(customers: DataFrame) -> DataFrame:
    df = customers.select("customer_id", "country")
    return numbered(df, ["country"], [F.col("customer_id")], "country_row")


def quantity_and_overall_average(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Mean line quantity per order beside the mean of those means."""
    means = (
        lines.groupBy("order_id")
        .agg(F.avg("quantity").alias("avg_quantity"))
        .join(keys_of(orders, "order_id"), "order_id", "left_semi")
    )
    return with_group_stats(means, [], F.avg("avg_quantity").alias("overall_avg_quantity"))


def territory_rank(territories: DataFrame, staff_territories: DataFrame) -> DataFrame:
    counts = (
        staff_territories.groupBy("territory_id")
        .agg(F.count("employee_id").alias("employee_count"))
        .join(keys_of(territories, "territory_id"), "territory_id", "left_semi")
    )
    return ranked(staged(counts), [], "employee_count", "territory_rank")


def shipper_freight_rank(orders: DataFrame, shippers: DataFrame, digits: int = 6) -> DataFrame:
    freight = freight_per_shipper(orders, shippers).select(
        "company_name", F.round("total_freight_cost", digits).alias("total_freight")
    )
    return ranked(staged(freight), [], "total_freight", "shipper_rank")


def previous_freight(orders: DataFrame) -> DataFrame:
    df = orders.select("customer_id", "order_id", "order_date", "freight")
    return lagged(df, ["customer_id"], [F.col("order_date"), F.col("order_id")], "freight", "previous_freight")


def previous_quantity(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Quantity of the product's previous line.

    Lines are ordered by date, order, line and quantity; rows equal in all
    of these are interchangeable.
    """
    dated = lines.select("order_id", "line_no", "product_id", "quantity").join(
        orders.select("order_id", "order_date"), "order_id"
    )
    order = [F.col("order_date"), F.col("order_id"), F.col("line_no"), F.col("quantity")]
    return lagged(dated, ["product_id"], order, "quantity", "previous_quantity", sizes=lines)


def customer_revenue_rank(orders: DataFrame, lines: DataFrame, digits: int = 4) -> DataFrame:
    revenue = revenue_by_order_key(orders, lines, "customer_id").select(
        "customer_id", F.round("revenue", digits).alias("total_revenue")
    )
    return ranked(staged(revenue), [], "total_revenue", "revenue_rank", dense=True)


def category_revenue_share(products: DataFrame, lines: DataFrame) -> DataFrame:
    """Revenue per category and product name with its share of the category."""
    revenue = (
        revenue_by_product(lines)
        .join(products.select("product_id", "category_id", "product_name"), "product_id")
        .groupBy("category_id", "product_name")
        .agg(F.sum("revenue").alias("product_revenue"))
    )
    shares = with_group_stats(staged(revenue), ["category_id"], F.sum("product_revenue").alias("category_revenue"))
    return shares.withColumn(
        "revenue_share", F.col("product_revenue") / F.col("category_revenue")
    ).drop("category_revenue")


def moving_freight(orders: DataFrame, preceding: int = 2) -> DataFrame:
    df = orders.select("ship_via", "order_id", "order_date", "freight")
    order = [F.col("order_date"), F.col("order_id")]
    return moving_average(df, ["ship_via"], order, "freight", preceding, "moving_avg_freight").drop("order_date")


def order_complexity_lag(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Distinct products per order beside the employee's previous order."""
    counts = lines.groupBy("order_id").agg(F.countDistinct("product_id").alias("product_count"))
    df = orders.select("employee_id", "order_id").join(counts, "order_id")
    return lagged(
        df, ["employee_id"], [F.col("order_id")], "product_count", "previous_complexity", sizes=orders
    )


def shipper_usage_share(orders: DataFrame, shippers: DataFrame) -> DataFrame:
    used = orders.groupBy("ship_country", F.col("ship_via").alias("shipper_id")).agg(
        F.count("order_id").alias("n")
    )
    usage = (
        used.join(shippers, "shipper_id")
        .groupBy("ship_country", "company_name")
        .agg(F.sum("n").alias("usage_count"))
    )
    totals = usage.groupBy("ship_country").agg(F.sum("usage_count").alias("all_orders"))
    return (
        attach(usage, totals, ["ship_country"])
        .withColumn("usage_share", F.col("usage_count").cast("double") / F.col("all_orders"))
        .drop("all_orders")
    )


def bill_rank_in_day(tips: DataFrame) -> DataFrame:
    df = tips.select("day", "total_bill", "tip")
    return ranked(df, ["day"], "total_bill", "bill_rank")


def running_bill_in_day(tips: DataFrame) -> DataFrame:
    df = tips.select("day", "total_bill")
    return running_total(df, ["day"], "total_bill", "total_bill", "running_total")


def tip_rank_in_day(tips: DataFrame) -> DataFrame:
    df = tips.select("day", "total_bill", "tip", F.try_divide("tip", "total_bill").alias("tip_pct"))
    return ranked(df, ["day"], "tip_pct", "tip_rank")
