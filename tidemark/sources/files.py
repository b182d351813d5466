"""Reading and writing CSV, JSON and Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    # keep outer blanks: trimming is the cleaning step's task
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    multiline: bool = False,
    sampling_ratio: float = 1.0,
) -> DataFrame:
    """CSV with a header. Types are inferred when no schema is given, which costs one more read.

    ``multiline`` allows line breaks inside quotes; such a file cannot be split among tasks.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", multiline)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).option("samplingRatio", sampling_ratio).csv(path)


def load_data(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multiline: bool = False
) -> DataFrame:
    """Catalogue file: CSV with header and quotes.

    A large file is read by many tasks. With ``multiline`` quotes may hold
    line breaks, and a file is one task.
    """
    return read_csv(spark, path, schema, multiline)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multiline: bool = False
) -> DataFrame:
    """One record per line, or with ``multiline`` one object or array per file."""
    reader = spark.read.option("multiLine", multiline)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def flat_for_csv(df: DataFrame) -> DataFrame:
    """Arrays and structs as JSON text: CSV has no nested values."""
    nested = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
    ]
    return df.withColumns({name: F.to_json(name) for name in nested}) if nested else df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    flat_for_csv(df).write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One record per line; null fields are written out."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def save_data(df: DataFrame, path: str) -> dict[str, str]:
    """The same rows as CSV, Parquet and JSON siblings; returns the three paths.

    The plan runs once, for Parquet; the other two formats are written from it.
    """
    stem = path.removesuffix(".csv")
    paths = {"csv": f"{stem}.csv", "parquet": f"{stem}.parquet", "json": f"{stem}.json"}
    write_parquet(df, paths["parquet"])
    stored = df.sparkSession.read.parquet(paths["parquet"])
    write_csv(stored, paths["csv"])
    write_json(stored, paths["json"])
    return paths


def format_compare(df: DataFrame, folder: str) -> DataFrame:
    """Write the rows in three formats and count each: format, rows."""
    spark = df.sparkSession
    paths = save_data(df, f"{folder}/compare.csv")
    counted = [
        spark.read.options(**CSV_OPTIONS).schema(flat_for_csv(df).schema).csv(paths["csv"]),
        spark.read.schema(df.schema).json(paths["json"]),
        spark.read.parquet(paths["parquet"]),
    ]
    result = None
    for name, frame in zip(("csv", "json", "parquet"), counted):
        one = frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("format"), "rows")
        result = one if result is None else result.unionByName(one)
    return result


def append_batch(df: DataFrame, folder: str, batch_id: str) -> str:
    """Land one batch as JSON in a directory of its own; an existing batch is never overwritten."""
    target = f"{folder}/batch_id={batch_id}"
    df.write.mode("errorifexists").json(target)
    return target
