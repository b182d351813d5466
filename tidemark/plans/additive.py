"""Counts that are kept up to date by adding what a run changed, instead of counting all events again."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import layers
from tidemark.sources.snapshots import SnapshotTable

RUN = "run"


@dataclass(frozen=True)
class Counts:
    """A grouped count: the function that counts rows, its keys, the count's name and the layout by keys."""

    build: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    measure: str = "event_count"
    partition_by: tuple[str, ...] = ()


COUNTS: Mapping[str, Counts] = {
    "repo_velocity": Counts(layers.repo_velocity, ("repo_name", "event_hour", "window_date"), partition_by=("window_date",)),
    "event_distribution": Counts(layers.event_distribution, ("hour_of_day",)),
    "event_type_breakdown": Counts(layers.event_type_breakdown, ("event_type",)),
}


def changed_counts(counts: Counts, before: DataFrame, after: DataFrame) -> DataFrame:
    """Difference of the counts where rows ``before`` were replaced by rows ``after``; groups without change are left out."""
    gone = counts.build(before).withColumn(counts.measure, -F.col(counts.measure))
    both = counts.build(after).unionByName(gone)
    return _added_up(both, counts)


def _added_up(parts: DataFrame, counts: Counts) -> DataFrame:
    return parts.groupBy(*counts.keys).agg(F.sum(counts.measure).alias(counts.measure)).where(F.col(counts.measure) != 0)


class AdditiveTable:
    """Counts as a folded base and the differences of the runs since.

    Each run writes the difference it made to a folder of its own, by the table's partitions, and replaces that folder
    if it is repeated. Reading adds up the base and the later runs, of the partitions asked for only. ``fold`` writes a
    new base; it counts once it is in the base's history, so a fold that fails leaves everything as it was.
    """

    def __init__(self, spark: SparkSession, path: str, counts: Counts):
        self.spark, self.path, self.counts = spark, path.rstrip("/"), counts
        self.base = SnapshotTable(spark, f"{self.path}/base", counts.partition_by)

    def folded(self) -> int:
        """The last run in the base; -1 without one."""
        row = self.base.history().orderBy(F.desc("version")).first()
        return int(row.operation.split()[1]) if row else -1

    def add(self, difference: DataFrame, run: int) -> None:
        writer = difference.select(*self.counts.keys, self.counts.measure).write.mode("overwrite")
        if self.counts.partition_by:
            writer = writer.partitionBy(*self.counts.partition_by)
        writer.parquet(f"{self.path}/runs/{RUN}={run}")

    def read(self, upto: int | None = None) -> DataFrame:
        """The counts after all runs, or after run ``upto``."""
        folded, parts = self.folded(), []
        if folded >= 0:
            parts.append(self.base.read())
        schema = self.counts_schema()
        if schema is not None:
            runs = self.spark.read.schema(schema).option("basePath", f"{self.path}/runs").parquet(f"{self.path}/runs")
            later = F.col(RUN) > folded if upto is None else (F.col(RUN) > folded) & (F.col(RUN) <= upto)
            parts.append(runs.where(later).drop(RUN))
        if not parts:
            raise LookupError(f"no counts in {self.path}")
        return _added_up(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]), self.counts)

    def counts_schema(self) -> str | None:
        """Types of the runs' columns; None before the first run."""
        try:
            found = self.spark.read.option("basePath", f"{self.path}/runs").parquet(f"{self.path}/runs").schema
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.fields)

    def fold(self, run: int) -> None:
        """Make the sum of all runs up to ``run`` the new base. None of them may be repeated after that."""
        self.base.write(self.read(run), f"FOLD {run}")


def add_changes(
    spark: SparkSession, folder: str, before: DataFrame, after: DataFrame, run: int, tables: Mapping[str, Counts] = COUNTS, fold_every: int = 50
) -> dict[str, DataFrame]:
    """Bring all counts up to date after a run that replaced rows ``before`` by rows ``after``; returns the tables.

    Only the changed rows are read. Every ``fold_every`` runs the differences before this one become a new base, so
    reading adds up few; this run may still be repeated.
    """
    out = {}
    for name, counts in tables.items():
        table = AdditiveTable(spark, f"{folder}/{name}_counts", counts)
        if run - 1 - table.folded() >= fold_every:
            table.fold(run - 1)
        table.add(changed_counts(counts, before, after), run)
        out[name] = table.read()
    return out


def daily_contributors(events: DataFrame, precision: int = 12) -> DataFrame:
    """(repo_name, created_at_date, contributors): a sketch of the contributors per repository and day.

    Sketches of many days merge to that of all, so a run computes those of its days only. The relative standard error
    of a count is about 1.04 / sqrt(2 ^ precision), 1.6 % by default, whatever the number of days.
    """
    sketch = F.hll_sketch_agg("actor_login", F.lit(precision)).alias("contributors")
    return events.groupBy("repo_name", "created_at_date").agg(sketch)


def contributors_of_days(daily: DataFrame, *keys: str) -> DataFrame:
    """Approximate distinct contributors over all days of the sketches, by default per repository."""
    merged = F.hll_union_agg("contributors")
    return daily.groupBy(*(keys or ("repo_name",))).agg(F.hll_sketch_estimate(merged).alias("unique_contributors"))
