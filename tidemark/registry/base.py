"""Name, Spark query and equivalent SQL of every operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.adapters import Tables, oracle_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, build: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"duplicate query name {name}")
    QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
    if sql is not None:
        ORACLES[name] = oracle_text(sql)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round sums and means, so that the order of addition does not show."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
