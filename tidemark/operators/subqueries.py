"""Questions asked with subqueries: exists, not exists, for all, comparison with an aggregate.

EXISTS becomes a semi join and NOT EXISTS an anti join against distinct
keys. A single aggregate value enters as a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.aggregates import staff_orders
from tidemark.operators.joins import keys_of, order_values, revenue_expr
from tidemark.operators.skew import top_ranked, with_group_stats
from tidemark.session import staged


def unsold_products(products: DataFrame, lines: DataFrame) -> DataFrame:
    return products.join(keys_of(lines, "product_id"), "product_id", "left_anti").select("product_id", "product_name")


def customers_with_big_order(orders: DataFrame, lines: DataFrame, above: float) -> DataFrame:
    """Customers, null included, with at least one order worth more than ``above``."""
    big = order_values(lines).filter(F.col("order_value") > above).select("order_id")
    return orders.select("order_id", "customer_id").join(big, "order_id", "left_semi").select("customer_id").distinct()


def above_category_average(products: DataFrame) -> DataFrame:
    priced = with_group_stats(
        products.select("product_id", "product_name", "unit_price", "category_id"),
        ["category_id"],
        F.avg("unit_price").alias("category_price"),
    )
    return priced.filter(
        F.col("category_id").isNotNull() & (F.col("unit_price") > F.col("category_price"))
    ).select("product_name", "unit_price")


def customers_covering_category(
    customers: DataFrame,
    orders: DataFrame,
    lines: DataFrame,
    products: DataFrame,
    category_id: int,
    item: str = "product_id",
) -> DataFrame:
    """Customers who ordered every item of a category (relational division).

    ``item`` is a column of the products: the product itself or something
    coarser, such as its supplier. Counts each customer's distinct wanted
    items and compares with the number wanted. With nothing wanted every
    customer qualifies.
    """
    wanted = products.filter(F.col("category_id") == category_id).select(F.col(item).alias("_item")).distinct()
    needed = wanted.agg(F.count(F.lit(1)).alias("n"))
    items = products.select("product_id", F.col(item).alias("_item")).join(wanted, "_item", "left_semi")
    bought = (
        keys_of(lines, "order_id", "product_id")
        .join(items, "product_id")
        .select("order_id", "_item")
        .distinct()
        .join(orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id")
        .agg(F.countDistinct("_item").alias("got"))
    )
    return (
        customers.select("customer_id")
        .join(bought, "customer_id", "left")
        .filter(F.coalesce("got", F.lit(0)) == needed.scalar())
        .select("customer_id")
    )


def orders_above_average(orders: DataFrame, lines: DataFrame) -> DataFrame:
    totals = order_values(lines, "total_value").join(orders.select("order_id"), "order_id")
    mean = totals.agg(F.avg("total_value")).scalar()
    return totals.filter(F.col("total_value") > mean).select("order_id", "total_value")


def idle_employees(employees: DataFrame, orders: DataFrame) -> DataFrame:
    return employees.join(keys_of(orders, "employee_id"), "employee_id", "left_anti").select(
        "employee_id", "first_name", "last_name"
    )


def suppliers_all_above_average(suppliers: DataFrame, products: DataFrame) -> DataFrame:
    """Suppliers without a product at or below the mean price; true for suppliers without products."""
    mean = products.agg(F.avg("unit_price")).scalar()
    cheap = keys_of(products.filter(F.col("unit_price") <= mean), "supplier_id")
    return suppliers.join(cheap, "supplier_id", "left_anti").select("supplier_id", "company_name")


def customers_only_discounted(customers: DataFrame, orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Customers without a full-price line; true for customers without orders."""
    full_price = keys_of(lines.filter(F.col("discount") == 0), "order_id")
    payers = keys_of(
        orders.select("order_id", "customer_id").join(full_price, "order_id", "left_semi"), "customer_id"
    )
    return customers.join(payers, "customer_id", "left_anti").select("customer_id")


def dearest_per_supplier(products: DataFrame) -> DataFrame:
    """The most expensive products of each supplier; ties stay."""
    priced = products.select("product_id", "product_name", "unit_price", "supplier_id").filter(
        F.col("supplier_id").isNotNull() & F.col("unit_price").isNotNull()
    )
    return top_ranked(priced, ["supplier_id"], "unit_price", 1, "_rank").drop("_rank", "supplier_id")


def shippers_above_average_freight(orders: DataFrame, shippers: DataFrame) -> DataFrame:
    means = orders.groupBy(F.col("ship_via").alias("shipper_id")).agg(F.avg("freight").alias("avg_freight"))
    overall = orders.agg(F.avg("freight")).scalar()
    return (
        means.join(shippers, "shipper_id")
        .filter(F.col("avg_freight") > overall)
        .select("company_name", "avg_freight")
    )


def uncovered_territories(territories: DataFrame, staff_territories: DataFrame) -> DataFrame:
    return territories.join(keys_of(staff_territories, "territory_id"), "territory_id", "left_anti").select(
        "territory_id", "territory_description"
    )


def fully_covered_regions(regions: DataFrame, territories: DataFrame, staff_territories: DataFrame) -> DataFrame:
    """Regions without an uncovered territory; true for regions without territories."""
    open_territories = territories.join(
        keys_of(staff_territories, "territory_id"), "territory_id", "left_anti"
    )
    return regions.join(keys_of(open_territories, "region_id"), "region_id", "left_anti").select("region_description")


def busy_region_employees(
    regions: DataFrame,
    territories: DataFrame,
    staff_territories: DataFrame,
    employees: DataFrame,
    orders: DataFrame,
    above: int,
) -> DataFrame:
    """Employees of regions that handle more than ``above`` orders."""
    placed = staff_territories.join(territories, "territory_id").select("employee_id", "region_id")
    busy = (
        placed.join(staff_orders(orders, employees), "employee_id")
        .groupBy("region_id")
        .agg(F.sum("orders").alias("total_orders"))
        .filter(F.col("total_orders") > above)
        .join(keys_of(regions, "region_id"), "region_id", "left_semi")
    )
    staff = keys_of(placed.join(busy, "region_id", "left_semi"), "employee_id")
    return employees.join(staff, "employee_id", "left_semi").select("employee_id", "last_name").distinct()


def least_used_shipper_orders(orders: DataFrame, shippers: DataFrame) -> DataFrame:
    """Orders sent by the shipper with the fewest orders; the lower key wins a tie."""
    least = (
        orders.groupBy("ship_via")
        .agg(F.count("order_id").alias("n"))
        .agg(F.min(F.struct("n", "ship_via")).getField("ship_via"))
        .scalar()
    )
    chosen = shippers.filter(F.col("shipper_id") == least)
    return orders.join(chosen, orders.ship_via == chosen.shipper_id).select("order_id", "company_name")


def territories_above_average_revenue(
    territories: DataFrame,
    staff_territories: DataFrame,
    employees: DataFrame,
    orders: DataFrame,
    lines: DataFrame,
) -> DataFrame:
    per_employee = (
        orders.select("order_id", "employee_id")
        .join(order_values(lines), "order_id")
        .groupBy("employee_id")
        .agg(F.sum("order_value").alias("revenue"))
        .join(keys_of(employees, "employee_id"), "employee_id", "left_semi")
    )
    revenue = (
        staff_territories.join(keys_of(territories, "territory_id"), "territory_id", "left_semi")
        .join(per_employee, "employee_id")
        .groupBy("territory_id")
        .agg(F.sum("revenue").alias("revenue"))
    )
    return revenue.filter(F.col("revenue") > revenue.agg(F.avg("revenue")).scalar())


def never_late_shippers(orders: DataFrame, shippers: DataFrame) -> DataFrame:
    """Shippers without a late order; true for shippers without orders."""
    late = keys_of(
        orders.filter(F.col("shipped_date") > F.col("required_date")).select(
            F.col("ship_via").alias("shipper_id")
        ),
        "shipper_id",
    )
    return shippers.join(late, "shipper_id", "left_anti").select("company_name")


def product_dependency(orders: DataFrame, lines: DataFrame, above: float) -> DataFrame:
    """Customer and product pairs that make up more than a share of the customer's order lines."""
    per_order = lines.groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
    pairs = (
        orders.select("order_id", "customer_id")
        .dropna(subset=["customer_id"])
        .join(per_order, "order_id")
        .groupBy("customer_id", "product_id")
        .agg(F.sum("n").alias("product_orders"))
    )
    shares = with_group_stats(staged(pairs, "pairs"), ["customer_id"], F.sum("product_orders").alias("all_orders"))
    return (
        shares.withColumn("dependency_ratio", F.col("product_orders").cast("double") / F.col("all_orders"))
        .filter(F.col("dependency_ratio") > above)
        .select("customer_id", "product_id", "product_orders", "dependency_ratio")
    )


def dominant_lines(lines: DataFrame, above: float) -> DataFrame:
    """Order lines that make up more than a share of their order's value; an order's lines fit a task by nature."""
    valued = lines.select("order_id", "product_id", revenue_expr().alias("product_value"))
    whole = F.sum("product_value").over(Window.partitionBy("order_id"))
    return (
        valued.withColumn("order_value", whole)
        .withColumn("share", F.col("product_value") / F.col("order_value"))
        .filter(F.col("share") > above)
        .select("order_id", "product_id", "product_value", "share")
    )
