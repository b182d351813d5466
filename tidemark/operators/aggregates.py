"""Grouped aggregates and filters on aggregates.

Facts are summed to their own key before the join to a dimension, so only
one row per key crosses the network and no key can become a hot group.
Every limit is a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import (
    keys_of,
    order_values,
    revenue_by_order_key,
    revenue_by_product,
    revenue_expr,
)


def _named(counts: DataFrame, dim: DataFrame, key: str, *columns: str) -> DataFrame:
    return counts.join(dim, key).select(*columns)


def revenue_per_product(products: DataFrame, lines: DataFrame) -> DataFrame:
    """Revenue per product name; products that share a name are summed."""
    return (
        revenue_by_product(lines)
        .join(products.select("product_id", "product_name"), "product_id")
        .groupBy("product_name")
        .agg(F.sum("revenue").alias("total_revenue"))
    )


def orders_per_employee(employees: DataFrame, orders: DataFrame) -> DataFrame:
    counts = orders.groupBy("employee_id").agg(F.count("order_id").alias("total_orders"))
    return _named(counts, employees, "employee_id", "employee_id", "last_name", "total_orders")


def revenue_per_customer(customers: DataFrame, orders: DataFrame, lines: DataFrame) -> DataFrame:
    revenue = revenue_by_order_key(orders, lines, "customer_id").withColumnRenamed("revenue", "total_spent")
    return _named(revenue, customers, "customer_id", "customer_id", "company_name", "total_spent")


def big_spenders(customers: DataFrame, orders: DataFrame, lines: DataFrame, minimum: float) -> DataFrame:
    """Customers with at least ``minimum`` revenue, the largest first."""
    return (
        revenue_per_customer(customers, orders, lines)
        .filter(F.col("total_spent") >= minimum)
        .orderBy(F.col("total_spent").desc_nulls_last(), "customer_id")
    )


def average_price_per_category(products: DataFrame, categories: DataFrame) -> DataFrame:
    prices = products.groupBy("category_id").agg(F.avg("unit_price").alias("average_unit_price"))
    return _named(prices, categories, "category_id", "category_name", "average_unit_price")


def products_per_supplier(products: DataFrame, suppliers: DataFrame, more_than: int | None = None) -> DataFrame:
    counts = products.groupBy("supplier_id").agg(F.count("product_id").alias("product_count"))
    if more_than is not None:
        counts = counts.filter(F.col("product_count") > more_than)
    return _named(counts, suppliers, "supplier_id", "company_name", "product_count")


def quantity_per_category(products: DataFrame, categories: DataFrame, lines: DataFrame) -> DataFrame:
    sold = lines.groupBy("product_id").agg(F.sum("quantity").alias("quantity"))
    per_category = (
        sold.join(products.select("product_id", "category_id"), "product_id")
        .groupBy("category_id")
        .agg(F.sum("quantity").alias("sold_per_category"))
    )
    return _named(per_category, categories, "category_id", "category_name", "sold_per_category")


def average_discount_percent(products: DataFrame, lines: DataFrame) -> DataFrame:
    """Mean discount per product name in percent, the largest first."""
    parts = lines.groupBy("product_id").agg(
        F.sum("discount").alias("discounts"), F.count("discount").alias("n")
    )
    return (
        parts.join(products.select("product_id", "product_name"), "product_id")
        .groupBy("product_name")
        .agg((F.sum("discounts") / F.sum("n") * 100).alias("average_discount"))
        .orderBy(F.col("average_discount").desc_nulls_last(), "product_name")
    )


def orders_per_shipper(orders: DataFrame, shippers: DataFrame) -> DataFrame:
    counts = orders.groupBy(F.col("ship_via").alias("shipper_id")).agg(F.count("order_id").alias("num_of_orders"))
    return _named(counts, shippers, "shipper_id", "company_name", "num_of_orders")


def freight_per_shipper(orders: DataFrame, shippers: DataFrame) -> DataFrame:
    freight = orders.groupBy(F.col("ship_via").alias("shipper_id")).agg(F.sum("freight").alias("total_freight_cost"))
    return _named(freight, shippers, "shipper_id", "company_name", "total_freight_cost")


def count_per(df: DataFrame, *keys: str | Column, out: str) -> DataFrame:
    """Row count per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def hire_years(employees: DataFrame) -> DataFrame:
    """Hire year per employee; the year is grouped too, as it depends on the key."""
    return employees.select("employee_id", "first_name", "last_name", F.year("hire_date").alias("hire_year")).distinct()


def average_line_value(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_id").agg(F.avg(revenue_expr()).alias("average_line_value"))


def stock_per_category(products: DataFrame, categories: DataFrame) -> DataFrame:
    stock = products.groupBy("category_id").agg(F.sum("units_in_stock").alias("in_stock"))
    return _named(stock, categories, "category_id", "category_name", "in_stock")


def single_product_orders(orders: DataFrame, lines: DataFrame) -> DataFrame:
    unique = (
        lines.groupBy("order_id")
        .agg(F.countDistinct("product_id").alias("unique_products"))
        .filter(F.col("unique_products") == 1)
    )
    return unique.join(orders, "order_id").select("order_id", "customer_id", "unique_products")


def products_with_small_orders(products: DataFrame, lines: DataFrame, at_most: float) -> DataFrame:
    """Products never ordered in a larger quantity than ``at_most``."""
    largest = (
        lines.groupBy("product_id")
        .agg(F.max("quantity").alias("max_quantity"))
        .filter(F.col("max_quantity") <= at_most)
    )
    return _named(largest, products, "product_id", "product_id", "product_name", "max_quantity")


def discount_above_freight(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders that gave away more in discounts than their freight cost."""
    given = lines.groupBy("order_id").agg(
        F.sum(F.col("unit_price") * F.col("quantity") * F.col("discount")).alias("total_discount")
    )
    return (
        given.join(orders.select("order_id", "freight"), "order_id")
        .filter(F.col("total_discount") > F.col("freight"))
        .select("order_id", "total_discount", "freight")
    )


def customers_with_many_suppliers(
    customers: DataFrame, orders: DataFrame, lines: DataFrame, products: DataFrame, more_than: int
) -> DataFrame:
    """Customers who bought from more than so many suppliers.

    Order lines shrink to distinct (order, supplier), then to distinct
    (customer, supplier), before anything is counted per customer.
    """
    supplied = (
        lines.select("order_id", "product_id")
        .join(products.select("product_id", "supplier_id"), "product_id")
        .select("order_id", "supplier_id")
        .distinct()
    )
    counts = (
        orders.select("order_id", "customer_id")
        .join(supplied, "order_id")
        .groupBy("customer_id")
        .agg(F.countDistinct("supplier_id").alias("supplier_count"))
        .filter(F.col("supplier_count") > more_than)
    )
    return _named(counts, customers, "customer_id", "customer_id", "company_name", "supplier_count")


def employees_with_large_lines(employees: DataFrame, orders: DataFrame, lines: DataFrame, above: float) -> DataFrame:
    """Employees whose mean line quantity exceeds ``above``."""
    per_order = lines.groupBy("order_id").agg(F.sum("quantity").alias("q"), F.count("quantity").alias("n"))
    means = (
        orders.select("order_id", "employee_id")
        .join(per_order, "order_id")
        .groupBy("employee_id")
        .agg((F.sum("q") / F.sum("n")).alias("average_quantity"))
        .filter(F.col("average_quantity") > above)
    )
    return _named(means, employees, "employee_id", "employee_id", "last_name", "average_quantity")


def categories_with_min_price(products: DataFrame, categories: DataFrame, at_least: float) -> DataFrame:
    cheapest = (
        products.groupBy("category_id")
        .agg(F.min("unit_price").alias("product_cost"))
        .filter(F.col("product_cost") >= at_least)
    )
    return _named(cheapest, categories, "category_id", "category_id", "category_name", "product_cost")


def orders_with_cheap_and_dear(lines: DataFrame, cheap_below: float, dear_above: float) -> DataFrame:
    """Orders that hold both a cheap and an expensive item."""
    return (
        lines.groupBy("order_id")
        .agg(
            F.min("unit_price").alias("min_price"),
            F.max("unit_price").alias("max_price"),
            F.count_if(F.col("unit_price") < cheap_below).alias("cheap"),
            F.count_if(F.col("unit_price") > dear_above).alias("dear"),
        )
        .filter((F.col("cheap") > 0) & (F.col("dear") > 0))
        .select("order_id", "min_price", "max_price")
    )


def suppliers_never_discounted(suppliers: DataFrame, products: DataFrame, lines: DataFrame) -> DataFrame:
    highest = lines.groupBy("product_id").agg(F.max("discount").alias("discount"))
    per_supplier = (
        highest.join(products.select("product_id", "supplier_id"), "product_id")
        .groupBy("supplier_id")
        .agg(F.max("discount").alias("max_discount"))
        .filter(F.col("max_discount") == 0)
    )
    return _named(per_supplier, suppliers, "supplier_id", "supplier_id", "company_name", "max_discount")


def customers_with_few_orders(customers: DataFrame, orders: DataFrame, fewer_than: int) -> DataFrame:
    counts = (
        orders.groupBy("customer_id")
        .agg(F.count("order_id").alias("num_of_orders"))
        .filter(F.col("num_of_orders") < fewer_than)
    )
    return _named(counts, customers, "customer_id", "company_name", "num_of_orders")


def territories_per_region(regions: DataFrame, territories: DataFrame) -> DataFrame:
    counts = territories.groupBy("region_id").agg(F.count("territory_id").alias("territory_count"))
    return _named(counts, regions, "region_id", "region_description", "territory_count")


def multi_territory_employees(staff_territories: DataFrame, more_than: int = 1) -> DataFrame:
    return (
        staff_territories.groupBy("employee_id")
        .agg(F.count("territory_id").alias("territory_count"))
        .filter(F.col("territory_count") > more_than)
    )


def staff_orders(orders: DataFrame, employees: DataFrame) -> DataFrame:
    """Orders per known employee."""
    counts = orders.groupBy("employee_id").agg(F.count("order_id").alias("orders"))
    return counts.join(keys_of(employees, "employee_id"), "employee_id", "left_semi")


def orders_per_region(
    regions: DataFrame, territories: DataFrame, staff_territories: DataFrame, employees: DataFrame, orders: DataFrame
) -> DataFrame:
    """Orders per region; an order counts once for each territory of its employee."""
    return (
        staff_territories.join(staff_orders(orders, employees), "employee_id")
        .join(territories, "territory_id")
        .groupBy("region_id")
        .agg(F.sum("orders").alias("total_orders"))
        .join(regions, "region_id")
        .groupBy("region_description")
        .agg(F.sum("total_orders").alias("total_orders"))
    )


def shippers_with_many_countries(orders: DataFrame, shippers: DataFrame, more_than: int) -> DataFrame:
    counts = (
        orders.groupBy(F.col("ship_via").alias("shipper_id"))
        .agg(F.countDistinct("ship_country").alias("countries_served"))
        .filter(F.col("countries_served") > more_than)
    )
    return _named(counts, shippers, "shipper_id", "company_name", "countries_served")


def bills_per_day(tips: DataFrame) -> DataFrame:
    return tips.groupBy("day").agg(
        F.count(F.lit(1)).alias("transactions"), F.avg("total_bill").alias("avg_bill")
    )


def tip_share_per_day(tips: DataFrame) -> DataFrame:
    """Mean of the row-wise tip share and of the bill."""
    return tips.groupBy("day").agg(
        F.avg(F.try_divide("tip", "total_bill")).alias("avg_tip_pct"), F.avg("total_bill").alias("avg_bill")
    )


def day_summary(tips: DataFrame) -> DataFrame:
    return tips.groupBy("day").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.avg("total_bill").alias("avg_bill"),
        F.avg(F.try_divide("tip", "total_bill")).alias("avg_tip_percentage"),
    )


def day_time_summary(tips: DataFrame, bill_above: float) -> DataFrame:
    return (
        tips.filter(F.col("total_bill") > bill_above)
        .groupBy("day", "time")
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            F.avg("total_bill").alias("avg_bill"),
            F.avg("tip").alias("avg_tip"),
        )
        .orderBy(F.col("avg_bill").desc_nulls_last(), "day", "time")
    )


def orders_per_employee_by_territory(
    territories: DataFrame, staff_territories: DataFrame, employees: DataFrame, orders: DataFrame
) -> DataFrame:
    """Per territory: orders, employees with orders, and their ratio."""
    return (
        staff_territories.join(staff_orders(orders, employees), "employee_id")
        .join(keys_of(territories, "territory_id"), "territory_id", "left_semi")
        .groupBy("territory_id")
        .agg(F.sum("orders").alias("total_orders"), F.countDistinct("employee_id").alias("employee_count"))
        .withColumn("orders_per_employee", F.col("total_orders").cast("double") / F.col("employee_count"))
    )


def order_value_range(orders: DataFrame, lines: DataFrame, above: float) -> DataFrame:
    """Spread between a customer's dearest and cheapest order, where above the limit."""
    return (
        orders.select("order_id", "customer_id")
        .join(order_values(lines), "order_id")
        .groupBy("customer_id")
        .agg((F.max("order_value") - F.min("order_value")).alias("value_range"))
        .filter(F.col("value_range") > above)
    )
