"""Stored reports (views) and the questions asked of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregates import revenue_per_customer
from tidemark.operators.joins import order_values, revenue_expr, revenue_per_supplier_all


def customer_total_sales(customers: DataFrame, orders: DataFrame, lines: DataFrame) -> DataFrame:
    return revenue_per_customer(customers, orders, lines).withColumnRenamed("total_spent", "total_sales")


def high_value_customers(total_sales: DataFrame, above: float) -> DataFrame:
    return total_sales.filter(F.col("total_sales") > above)


def order_total_values(orders: DataFrame, lines: DataFrame) -> DataFrame:
    return (
        orders.select("order_id", "customer_id", "order_date")
        .join(order_values(lines, "total_value"), "order_id")
    )


def above_own_average(report: DataFrame, column: str) -> DataFrame:
    """Rows of a report above the report's own mean."""
    return report.filter(F.col(column) > report.agg(F.avg(column)).scalar())


def product_sales_summary(products: DataFrame, lines: DataFrame) -> DataFrame:
    sold = lines.groupBy("product_id").agg(
        F.sum("quantity").alias("total_quantity_sold"), F.sum(revenue_expr()).alias("total_revenue")
    )
    return products.select("product_id", "product_name").join(sold, "product_id")


def premium_low_volume(summary: DataFrame, revenue_above: float, quantity_below: float) -> DataFrame:
    return summary.filter(
        (F.col("total_revenue") > revenue_above) & (F.col("total_quantity_sold") < quantity_below)
    )


def supplier_performance(suppliers: DataFrame, products: DataFrame, lines: DataFrame) -> DataFrame:
    return (
        revenue_per_supplier_all(suppliers, products, lines)
        .filter(F.col("revenue").isNotNull())
        .withColumnRenamed("revenue", "total_revenue")
    )


def shipping_performance(orders: DataFrame) -> DataFrame:
    """Orders, mean freight and share of late orders per shipper; unknown dates are not late."""
    late = F.when(F.col("shipped_date") > F.col("required_date"), 1).otherwise(0)
    return orders.groupBy("ship_via").agg(
        F.count("order_id").alias("total_orders"),
        F.avg("freight").alias("avg_freight"),
        F.avg(late).alias("late_ratio"),
    )


def reliable_shippers(performance: DataFrame, below: float) -> DataFrame:
    return performance.filter(F.col("late_ratio") < below)


def cross_country_flags(orders: DataFrame, lines: DataFrame, products: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Every order line with 1 where it ships to another country than its supplier's, else 0."""
    origin = products.select("product_id", "supplier_id").join(
        suppliers.select("supplier_id", F.col("country").alias("supplier_country")), "supplier_id"
    )
    different = F.col("ship_country") != F.col("supplier_country")
    return (
        lines.select("order_id", "product_id")
        .join(origin, "product_id")
        .join(orders.select("order_id", "customer_id", "ship_country"), "order_id")
        .select(
            "customer_id",
            "order_id",
            "ship_country",
            "supplier_country",
            F.when(different, 1).otherwise(0).alias("cross_country_flag"),
        )
    )


def sql_over_view(df: DataFrame, view: str, sql: str) -> DataFrame:
    """Register ``df`` under a name and query it by SQL text."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(sql)
