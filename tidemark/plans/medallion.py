"""Dependencies between the layered tables, and the run that publishes them in order."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import partial
from graphlib import TopologicalSorter
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import layers
from tidemark.operators.quality import Rule, RuleWatch, keep_valid
from tidemark.plans.additive import COUNTS, AdditiveTable, Counts, add_changes
from tidemark.session import side_by_side
from tidemark.sources.snapshots import SnapshotTable
from tidemark.streaming.bronze import ingest, read_bronze


@dataclass(frozen=True)
class Dataset:
    """A published table: the tables it reads, its function, layout and rules."""

    reads: tuple[str, ...]
    build: Callable[..., DataFrame]
    partition_by: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()
    #: columns that only the rules read
    hidden: tuple[str, ...] = ()


DATASETS: Mapping[str, Dataset] = {
    "silver_events": Dataset(("bronze_events",), layers.silver_events, ("created_at_date",), layers.EVENT_RULES),
    "silver_repos": Dataset(("bronze_repos",), layers.silver_repos, ("ingestion_date",), layers.REPO_RULES),
    "silver_users": Dataset(("bronze_users",), layers.silver_users, ("ingestion_date",), layers.USER_RULES),
    "repo_velocity": Dataset(("silver_events",), layers.repo_velocity, ("window_date",)),
    "user_stats": Dataset(("silver_events",), layers.user_stats),
    "event_distribution": Dataset(("silver_events",), layers.event_distribution),
    "repo_enriched": Dataset(
        ("silver_events", "silver_repos"),
        partial(layers.repo_enriched, guarded=True),
        ("created_at_date",),
        (layers.ONE_REPO,),
        (layers.REPO_PROFILES,),
    ),
    "language_distribution": Dataset(("repo_enriched",), layers.language_distribution),
    "user_enriched": Dataset(
        ("silver_events", "silver_users"),
        partial(layers.user_enriched, guarded=True),
        ("created_at_date",),
        (layers.ONE_USER,),
        (layers.USER_PROFILES,),
    ),
    "activity_summary": Dataset(
        ("silver_events", "silver_repos", "silver_users"),
        partial(layers.activity_summary, guarded=True),
        ("created_at_date",),
        (layers.ONE_REPO, layers.ONE_USER),
        (layers.REPO_PROFILES, layers.USER_PROFILES),
    ),
}


def run_levels(datasets: Mapping[str, Dataset] = DATASETS) -> Iterator[tuple[str, ...]]:
    """Names in groups: the tables of a group read only those of earlier groups."""
    graph = TopologicalSorter({name: [r for r in d.reads if r in datasets] for name, d in datasets.items()})
    graph.prepare()
    while graph.is_active():
        level = graph.get_ready()
        yield level
        graph.done(*level)


def run_order(datasets: Mapping[str, Dataset] = DATASETS) -> list[str]:
    """Names so that every table comes after the tables it reads."""
    return [name for level in run_levels(datasets) for name in level]


def publish(
    table: SnapshotTable, df: DataFrame, rules: Sequence[Rule], dataset: str, hidden: Sequence[str] = ()
) -> DataFrame | None:
    """Write the rows that pass, and make them visible only if no fail rule was broken.

    Rules are counted on the dataset's output in the tasks that write it;
    columns in ``hidden`` are there for the rules and not written.
    Returns the rule counts, None without rules.
    """
    if not rules:
        table.write(df, "REFRESH")
        return None
    watch = RuleWatch(rules, dataset)
    table.write(df, "REFRESH", before_publish=watch.enforce, last_step=lambda rows: watch.watched(rows).drop(*hidden))
    return watch.metrics(table.spark)


def merge_new_batches(
    spark: SparkSession,
    folder: str,
    bronze_tables: Mapping[str, str],
    datasets: Mapping[str, Dataset] = DATASETS,
    counts: Mapping[str, Mapping[str, Counts]] = MappingProxyType({}),
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Bring the tables that keep the latest row per key up to date from the bronze batches since the last run.

    ``bronze_tables`` maps bronze names to their folders. Beside each table lies its state, which also holds rows that
    the rules drop and every row's origin; the highest batch in it tells where to go on. A batch merged again changes
    nothing, so a run that ended between state and table is simply repeated. ``counts`` names, per table, counts of its
    rows that are kept up to date by addition; the differences are written before the new state becomes visible, and
    replaced if that run is repeated. Returns tables and rule counts.
    """
    tables: dict[str, DataFrame] = {}
    metrics: dict[str, DataFrame] = {}
    for name, spec in datasets.items():
        if not isinstance(spec.build, layers.Latest):
            continue
        state = SnapshotTable(spark, f"{folder}/{name}_state")
        source, latest, added = bronze_tables[spec.reads[0]], spec.build, counts.get(name, {})
        run = state.current_version()
        before = None if run is None else state.read()
        done = None if before is None else before.agg(F.max("batch_id")).first()[0]
        fresh = latest.flat(read_bronze(spark, source, done))
        after = latest.state(fresh) if before is None else latest.merge(before, fresh)
        if before is None or not fresh.isEmpty():
            number = 0 if run is None else run + 1

            def record(spec=spec, before=before, fresh=fresh, schema=after.schema, target=f"{state.path}/version={number}", number=number, added=added):
                written = spark.read.schema(schema).parquet(target)
                kept = lambda rows: keep_valid(spec.build.published(rows), spec.rules)
                if before is None:
                    add_changes(spark, folder, kept(written).limit(0), kept(written), number, added)
                else:
                    changed = [kept(spec.build.touched(rows, fresh)) for rows in (before, written)]
                    add_changes(spark, folder, *changed, number, added)

            state.write(after, "BUILD" if before is None else "MERGE", before_publish=record)
        for count_name, spec_of_count in added.items():
            tables[count_name] = AdditiveTable(spark, f"{folder}/{count_name}_counts", spec_of_count).read()
        table = SnapshotTable(spark, f"{folder}/{name}", spec.partition_by)
        checked = publish(table, spec.build.published(state.read()), spec.rules, name)
        if checked is not None:
            metrics[name] = checked
        tables[name] = table.read()
    return tables, metrics


def ingest_and_merge(
    spark: SparkSession, landing: Mapping[str, str], folder: str, multiline: bool = True
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """As ``ingest_and_refresh``, but the latest rows per key are merged from new batches instead of ranked anew, and
    counts of events are added up instead of counted anew."""
    bronze = _ingest_all(spark, landing, folder, multiline)
    silver, metrics = merge_new_batches(spark, folder, {name: f"{folder}/{name}" for name in landing}, counts={"silver_events": COUNTS})
    rest = {name: spec for name, spec in DATASETS.items() if name not in silver}
    tables, more = refresh(spark, folder, {**bronze, **silver}, rest)
    return tables, {**metrics, **more}


def refresh(
    spark: SparkSession, folder: str, bronze: Mapping[str, DataFrame], datasets: Mapping[str, Dataset] = DATASETS
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Rebuild all tables from bronze; returns the tables and the rule counts by table.

    Tables that do not read each other are published side by side. After a broken rule the others of that group are
    still published, those that come later are not.
    """
    available: dict[str, DataFrame] = dict(bronze)
    metrics: dict[str, DataFrame] = {}

    def rebuild(name: str) -> tuple[DataFrame, DataFrame | None]:
        spec = datasets[name]
        table = SnapshotTable(spark, f"{folder}/{name}", spec.partition_by)
        counts = publish(table, spec.build(*[available[r] for r in spec.reads]), spec.rules, name, spec.hidden)
        return table.read(), counts

    for level in run_levels(datasets):
        done = side_by_side(spark, *[partial(rebuild, name) for name in level])
        for name, (table, counts) in zip(level, done):
            if counts is not None:
                metrics[name] = counts
            available[name] = table
    return available, metrics


def ingest_and_refresh(
    spark: SparkSession, landing: Mapping[str, str], folder: str, multiline: bool = True
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """One run from landed files to gold tables.

    ``landing`` maps bronze_events, bronze_repos and bronze_users to
    separate folders; none may contain another.
    """
    return refresh(spark, folder, _ingest_all(spark, landing, folder, multiline))


def _ingest_all(spark: SparkSession, landing: Mapping[str, str], folder: str, multiline: bool) -> dict[str, DataFrame]:
    roots = [path.rstrip("/") + "/" for path in landing.values()]
    if any(a != b and a.startswith(b) for a in roots for b in roots) or len(set(roots)) < len(roots):
        raise ValueError("landing folders must not contain each other")
    steps = [partial(ingest, spark, path, f"{folder}/{name}", multiline) for name, path in landing.items()]
    return dict(zip(landing, side_by_side(spark, *steps)))
