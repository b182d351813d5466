"""Catalogue cleaning: names, white space, missing values, dates, duplicates, durations, genres."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import columns as c
from tidemark.operators.quality import require_unique
from tidemark.operators.skew import latest_per_key

# Columns whose missing entries become "Unknown".
FILLED_COLUMNS = ("director", "cast", "country", "rating")


def standardize_columns(df: DataFrame) -> DataFrame:
    """Column names in lower case with underscores for spaces."""
    return df.toDF(*[name.lower().replace(" ", "_") for name in df.columns])


def strip_whitespace(df: DataFrame) -> DataFrame:
    """Trim every text column in one projection."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: c.strip(F.col(f"`{name}`")) for name in text}) if text else df


def handle_missing_values(df: DataFrame, columns: Sequence[str] = FILLED_COLUMNS, value: str = "Unknown") -> DataFrame:
    """Replace nulls in the listed columns that exist."""
    present = [name for name in columns if name in df.columns]
    return df.fillna(value, subset=present) if present else df


def convert_date(df: DataFrame, column: str = "date_added") -> DataFrame:
    return df.withColumn(column, c.parse_date(column))


def remove_duplicates(df: DataFrame, key: str = "show_id", order: Sequence[str] = ()) -> DataFrame:
    """Keep the first row per key.

    A distributed table has no row order of its own: ``order`` names the
    columns that define it. Without them all columns are the order, so the
    choice is at least the same on every run.
    """
    return latest_per_key(df, [key], [F.col(name).asc_nulls_last() for name in (order or df.columns)])


def duplicate_summary(df: DataFrame, key: str = "show_id") -> DataFrame:
    """One row: rows before, rows kept, rows removed by ``remove_duplicates``."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"), F.count(F.lit(1)).alias("rows_kept")
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_kept"))


def clean_data(df: DataFrame, key: str = "show_id", order: Sequence[str] = ()) -> DataFrame:
    """Names, white space, missing values, dates and duplicates, in this order."""
    return (
        df.transform(standardize_columns)
        .transform(strip_whitespace)
        .transform(handle_missing_values)
        .transform(convert_date)
        .transform(remove_duplicates, key, order)
    )


def extract_duration_value(df: DataFrame) -> DataFrame:
    return df.withColumn("duration_value", c.first_number("duration"))


def extract_duration_unit(df: DataFrame) -> DataFrame:
    return df.withColumn("duration_unit", c.first_word("duration"))


def normalize_duration_unit(df: DataFrame) -> DataFrame:
    return df.withColumn("duration_unit", c.mapped("duration_unit", c.DURATION_UNITS))


def transform_duration(df: DataFrame) -> DataFrame:
    return (
        df.transform(extract_duration_value).transform(extract_duration_unit).transform(normalize_duration_unit)
    )


def transform_genres(df: DataFrame) -> DataFrame:
    return df.withColumn("genres", F.split("listed_in", ","))


def clean_genres(df: DataFrame) -> DataFrame:
    """Trim every genre; a column that is no list stays as it is."""
    if not isinstance(df.schema["genres"].dataType, T.ArrayType):
        return df
    return df.withColumn("genres", F.transform("genres", c.strip))


def genres(df: DataFrame) -> DataFrame:
    return df.transform(transform_genres).transform(clean_genres)


def create_is_movie(df: DataFrame) -> DataFrame:
    """True for movies, false for everything else, null types included."""
    return df.withColumn("is_movie", F.col("type").eqNullSafe("Movie"))


def transform_data(df: DataFrame) -> DataFrame:
    return df.transform(transform_duration).transform(genres).transform(create_is_movie)


def clean_catalogue(df: DataFrame, key: str = "show_id", order: Sequence[str] = ()) -> DataFrame:
    """The whole job without load and save; lazy from end to end."""
    return df.transform(clean_data, key, order).transform(transform_data)


def checked_catalogue(df: DataFrame, key: str = "show_id") -> DataFrame:
    """Raise if the key is still repeated after cleaning."""
    require_unique(df, [key])
    return df
