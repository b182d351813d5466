"""Catalog tables, their partitions and facts about them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def gathered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring rows of one partition value together before a partitioned write.

    This avoids one small file per task and value. A value too large for one
    task still spreads over several: adaptive execution splits rebalanced
    partitions by size.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def save_table(df: DataFrame, name: str, partition_by: Sequence[str] = (), path: str | None = None) -> None:
    """Overwrite a Parquet table, by choice partitioned and at a given place."""
    writer = gathered(df, partition_by).write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def show_partitions(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {name}")


def pruned_read(spark: SparkSession, name: str, condition: Column) -> DataFrame:
    """Rows of the partitions the condition selects; others are not opened."""
    return spark.table(name).filter(condition)


def table_limit(df: DataFrame, n: int, *order: str) -> DataFrame:
    """``n`` rows, the first by the given columns if any."""
    return (df.orderBy(*order) if order else df).limit(n)


def table_location(spark: SparkSession, name: str) -> str:
    """Folder of a catalog table."""
    detail = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'")
    return detail.first().data_type


def table_detail(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """One row: format, files, bytes and rows. Files are listed, not opened; rows come from the file footers for Parquet."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    files = listed.select("path", "length").filter(~name.startswith("_") & ~name.startswith("."))
    rows = spark.read.format(file_format).load(path).agg(F.count(F.lit(1))).scalar()
    return files.agg(F.count(F.lit(1)).alias("file_count"), F.coalesce(F.sum("length"), F.lit(0)).alias("size_in_bytes")).select(
        F.lit(file_format).alias("format"), "file_count", "size_in_bytes", rows.alias("num_rows")
    )


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, mean, stddev, min and max, in a single pass."""
    measures = []
    for i, name in enumerate(columns):
        x = F.col(name).cast("double")
        measures += [
            F.count(x).alias(f"n{i}"), F.avg(x).alias(f"a{i}"), F.stddev_samp(x).alias(f"s{i}"),
            F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}"),
        ]
    rows = [
        F.struct(
            F.lit(name).alias("column_name"), F.col(f"n{i}").alias("count"), F.col(f"a{i}").alias("mean"),
            F.col(f"s{i}").alias("stddev"), F.col(f"l{i}").alias("min"), F.col(f"h{i}").alias("max"),
        )
        for i, name in enumerate(columns)
    ]
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def column_profile(df: DataFrame) -> DataFrame:
    """Position, name and type of every column, and how many rows fill it, in a single pass."""
    counts = df.agg(*[F.count(F.col(f"`{name}`")).alias(f"n{i}") for i, name in enumerate(df.columns)])
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("column_name"), F.lit(kind).alias("type"), F.col(f"n{i}").alias("filled"))
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*rows)))


def schema_of(df: DataFrame) -> DataFrame:
    """Column names and types as rows."""
    return df.sparkSession.createDataFrame(
        [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)], "position int, column_name string, type string"
    )
