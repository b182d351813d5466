"""Projection, filter, sort and limit operators.

Predicates are built-in columns, so Spark pushes them and the needed
columns down to the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def filter_equal(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == value)


def filter_greater(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) > value)


def filter_at_least(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) >= value)


def filter_all(df: DataFrame, *conditions: Column) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, conditions))


def filter_any(df: DataFrame, *conditions: Column) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, conditions))


def filter_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(column).isin(*values))


def filter_between(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.filter(F.col(column).between(low, high))


def filter_ilike(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.filter(F.col(column).ilike(pattern))


def filter_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def filter_lower_equal(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.filter(F.lower(column) == value.lower())


def filter_product_above(df: DataFrame, left: str, right: str, minimum) -> DataFrame:
    """Rows whose product of two columns exceeds ``minimum``."""
    return df.filter(F.col(left) * F.col(right) > minimum)


def filter_not_equal(df: DataFrame, column: str, value) -> DataFrame:
    """NOT (column = value): null stays out, as in SQL."""
    return df.filter(~(F.col(column) == value))


def order_desc(df: DataFrame, column: str, *tie_break: str) -> DataFrame:
    return df.orderBy(F.col(column).desc_nulls_last(), *tie_break)


def top_n(df: DataFrame, column: str, n: int, *tie_break: str) -> DataFrame:
    """The ``n`` rows with the largest value; each task keeps only its own best ``n``."""
    return order_desc(df, column, *tie_break).limit(n)


def derive_ratio(df: DataFrame, numerator: str, denominator: str, out: str) -> DataFrame:
    """Add numerator / denominator, null where the denominator is 0."""
    return df.withColumn(out, F.try_divide(numerator, denominator))


def discounted_lines(orders: DataFrame, lines: DataFrame, above: float) -> DataFrame:
    """Lines of known orders with a discount above the limit."""
    return (
        lines.filter(F.col("discount") > above)
        .join(orders.select("order_id"), "order_id")
        .select("order_id", "product_id", "discount")
    )
