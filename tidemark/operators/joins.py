"""Join operators. Facts are reduced to their key before they meet a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import top_ranked


def revenue_expr():
    """Line value after discount."""
    return F.col("unit_price") * F.col("quantity") * (1 - F.col("discount"))


def keys_of(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct non-null keys: the right side of a semi or anti join.

    Spark cannot split a hot key on that side, so it is reduced on the map
    side first.
    """
    return df.select(*columns).dropna(subset=list(columns)).distinct()


def customers_with_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """All customers with their orders; customers without orders keep a null order.

    A left join cannot split a customer with very many orders. The inner
    join can, and the customers without orders are added to it.
    """
    columns = ["customer_id", "company_name", "order_id"]
    matched = customers.join(orders, "customer_id").select(*columns)
    unmatched = customers.join(keys_of(orders, "customer_id"), "customer_id", "left_anti").select(
        "customer_id", "company_name", F.lit(None).cast(orders.schema["order_id"].dataType).alias("order_id")
    )
    return matched.unionByName(unmatched)


def customers_without_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return customers.join(keys_of(orders, "customer_id"), "customer_id", "left_anti").select("company_name")


def orders_with_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """All orders with their customer's name, null where the customer is unknown."""
    return customers.join(orders, "customer_id", "right").select("company_name", "order_id")


def order_count_per_customer(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders per customer, 0 where there are none."""
    counts = orders.groupBy("customer_id").agg(F.count("order_id").alias("total_orders"))
    return customers.join(counts, "customer_id", "left").select(
        "customer_id", "company_name", F.coalesce("total_orders", F.lit(0)).alias("total_orders")
    )


def order_values(lines: DataFrame, out: str = "order_value") -> DataFrame:
    """Revenue per order; the map-side combine precedes the only shuffle."""
    return lines.groupBy("order_id").agg(F.sum(revenue_expr()).alias(out))


def revenue_by_order_key(orders: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """Revenue summed to a key that stands on the order, e.g. customer or employee."""
    return (
        orders.select("order_id", key)
        .join(order_values(lines), "order_id")
        .groupBy(key)
        .agg(F.sum("order_value").alias("revenue"))
    )


def revenue_per_customer_all(customers: DataFrame, orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Revenue of every customer, null for those without order lines."""
    revenue = revenue_by_order_key(orders, lines, "customer_id")
    return customers.join(revenue, "customer_id", "left").select("customer_id", "company_name", "revenue")


def products_never_ordered(products: DataFrame, lines: DataFrame) -> DataFrame:
    return products.join(keys_of(lines, "product_id"), "product_id", "left_anti").select("product_name", "product_id")


def revenue_per_employee(employees: DataFrame, orders: DataFrame, lines: DataFrame) -> DataFrame:
    revenue = revenue_by_order_key(orders, lines, "employee_id")
    return employees.join(revenue, "employee_id").select("employee_id", "last_name", "revenue")


def product_category_grid(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Every product beside every category; the product is the answer asked for here.

    Without a hint: Spark broadcasts the category list only if it is small.
    """
    return products.crossJoin(
        categories.withColumnsRenamed({"category_id": "grid_category_id", "category_name": "grid_category_name"})
    )


def products_with_category(products: DataFrame, categories: DataFrame) -> DataFrame:
    return products.join(categories, "category_id").select("product_name", "category_name")


def revenue_by_product(lines: DataFrame) -> DataFrame:
    return lines.groupBy("product_id").agg(F.sum(revenue_expr()).alias("revenue"))


def revenue_per_supplier_all(suppliers: DataFrame, products: DataFrame, lines: DataFrame) -> DataFrame:
    """Revenue of every supplier, null where nothing was sold."""
    revenue = (
        products.select("product_id", "supplier_id")
        .join(revenue_by_product(lines), "product_id")
        .groupBy("supplier_id")
        .agg(F.sum("revenue").alias("revenue"))
    )
    return suppliers.join(revenue, "supplier_id", "left").select("supplier_id", "company_name", "revenue")


def orders_with_shipper(orders: DataFrame, shippers: DataFrame) -> DataFrame:
    """Join over differently named keys."""
    return orders.join(shippers, orders.ship_via == shippers.shipper_id).select(
        "order_id", "shipper_id", "company_name"
    )


def latest_orders(orders: DataFrame) -> DataFrame:
    """Orders placed on their customer's last order date; ties stay."""
    dated = orders.filter(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
    return top_ranked(dated.select("customer_id", "order_id", "order_date"), ["customer_id"], "order_date", 1, "_rank").drop(
        "_rank"
    )


def regions_without_match(
    regions: DataFrame,
    territories: DataFrame,
    staff_territories: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
) -> DataFrame:
    """Regions on the empty side of a right join from orders to customers by ship country.

    The row survives only where no order ships to the customer's country, so
    its region is null: the result is one null row if any such customer
    exists, and empty otherwise. The order side enters through the distinct
    ship countries of orders whose employee covers a known region.
    """
    staffed = (
        staff_territories.join(territories, "territory_id")
        .join(regions, "region_id")
        .select("employee_id")
        .distinct()
    )
    reached = (
        orders.select("employee_id", "ship_country")
        .distinct()
        .join(staffed, "employee_id", "left_semi")
        .select(F.col("ship_country").alias("country"))
        .distinct()
    )
    return (
        customers.select("country")
        .join(reached, "country", "left_anti")
        .select(F.lit(None).cast("string").alias("region_description"))
        .distinct()
    )
