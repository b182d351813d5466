"""Versioned tables: every write is a new directory, made visible by a row in a history table.

A version's files are written first. Only the history row, added last,
makes them count, so a failed write leaves the table as it was. One
writer at a time is assumed.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.tables import gathered

HISTORY_SCHEMA = "version bigint, written_at timestamp, operation string, row_count bigint, schema_json string"


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str] = ()):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = list(partition_by)

    def _log(self) -> DataFrame:
        try:
            return self.spark.read.schema(HISTORY_SCHEMA).parquet(f"{self.path}/_history")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], HISTORY_SCHEMA)

    def history(self) -> DataFrame:
        """version, written_at, operation, row_count; one row per version."""
        return self._log().drop("schema_json")

    def current_version(self) -> int | None:
        return self._log().agg(F.max("version")).first()[0]

    def write(
        self,
        df: DataFrame,
        operation: str = "WRITE",
        before_publish: Callable[[], None] | None = None,
        last_step: Callable[[DataFrame], DataFrame] | None = None,
    ) -> int:
        """Publish ``df`` as the next version and return its number.

        ``last_step`` is a narrow step applied in the tasks that write the
        files, after the last shuffle. A task that is repeated there leaves
        only one result behind, so counts and numbers taken there are exact.
        ``before_publish`` runs once the files are written; if it raises,
        the version does not become visible.
        """
        last = self.current_version()
        version = 0 if last is None else last + 1
        target = f"{self.path}/version={version}"
        # files of an attempt that never reached the history are replaced
        rows = gathered(df, self.partition_by)
        if last_step:
            rows = last_step(rows)
        writer = rows.write.mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(target)
        if before_publish:
            before_publish()
        count = self.spark.read.schema(rows.schema).parquet(target).count()
        entry = self.spark.createDataFrame(
            [(version, operation, count, rows.schema.json())],
            "version bigint, operation string, row_count bigint, schema_json string",
        )
        (
            entry.select("version", F.current_timestamp().alias("written_at"), "operation", "row_count", "schema_json")
            .coalesce(1)
            .write.mode("append")
            .parquet(f"{self.path}/_history")
        )
        return version

    def read(self, version: int | None = None) -> DataFrame:
        """The given version, else the current one, with the schema it was written with."""
        known = self._log()
        if version is not None:
            known = known.filter(F.col("version") == version)
        entry = known.orderBy(F.desc("version")).first()
        if entry is None:
            raise LookupError(f"no version{'' if version is None else f' {version}'} of {self.path}")
        schema = T.StructType.fromJson(json.loads(entry.schema_json))
        return self.spark.read.schema(schema).parquet(f"{self.path}/version={entry.version}")

    def update(self, assignments: Mapping[str, Column], condition: Column | None = None) -> int:
        """Set columns on the rows that meet the condition, as a new version."""
        current = self.read()
        values = {}
        for name, value in assignments.items():
            kept_type = value.cast(current.schema[name].dataType)
            # only rows where the condition is true change; false and unknown keep their value
            values[name] = kept_type if condition is None else F.when(condition, kept_type).otherwise(F.col(name))
        return self.write(current.withColumns(values), "UPDATE")

    def diff(self, old: int, new: int | None, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
        """Keys whose columns differ between two versions, with old and new values.

        ``keys`` must be unique in each version.
        """
        before = self.read(old).select(*keys, *[F.col(c).alias(f"old_{c}") for c in columns], F.lit(True).alias("_b"))
        after = self.read(new).select(*keys, *[F.col(c).alias(f"new_{c}") for c in columns], F.lit(True).alias("_a"))
        both = before.join(after, list(keys), "full")
        changed = F.lit(False)
        for c in columns:
            changed = changed | ~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
        kind = (
            F.when(F.col("_b").isNull(), "added").when(F.col("_a").isNull(), "removed").when(changed, "changed")
        )
        return both.withColumn("change", kind).filter(F.col("change").isNotNull()).drop("_a", "_b")
