"""Ingestion, deduplication, rules and publishing on small files."""

import datetime as dt
import json
import os
import random
import re
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import layers as g
from tidemark.operators import quality as q
from tidemark.plans.additive import COUNTS, AdditiveTable, add_changes, contributors_of_days, daily_contributors
from tidemark.plans.medallion import DATASETS, Dataset, ingest_and_merge, ingest_and_refresh, publish, refresh, run_order
from tidemark.sources import files
from tidemark.sources.snapshots import SnapshotTable
from tidemark.streaming import bronze as b


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def event(i, kind="push", login="ann", repo="o/r", at="2024-01-01T10:20:30Z", **extra):
    return {"id": str(i), "type": kind, "actor": {"login": login}, "repo": {"name": repo}, "created_at": at, **extra}


def put(folder, name, payload):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(payload))


@pytest.fixture
def landing(tmp_path):
    put(tmp_path / "events", "e1.json", [event(1), event(2, login="bob", repo="o/q"), event(3, kind=None)])
    put(tmp_path / "repos", "o__r.json", {"full_name": "o/r", "stargazers_count": 5, "forks_count": 1, "language": "Go", "open_issues_count": 2, "created_at": "2020-01-01T00:00:00Z"})
    put(tmp_path / "users", "ann.json", {"login": "ann", "company": "c", "location": None, "followers": 9, "public_repos": 3, "created_at": "2019-01-01T00:00:00Z"})
    return {f"bronze_{k}": str(tmp_path / k) for k in ("events", "repos", "users")}


def test_runs_are_incremental_and_repeatable(spark, landing, tmp_path):
    folder = str(tmp_path / "tables")
    tables, metrics = ingest_and_refresh(spark, landing, folder)
    first = {r.event_id: r for r in tables["silver_events"].collect()}
    assert sorted(first) == ["1", "2"]  # the event without a type is dropped
    assert {(r.rule, r.failed) for r in metrics["silver_events"].collect()} == {
        ("event_id not null", 0), ("event_type not null", 1),
    }
    summary = {r.event_id: r for r in tables["activity_summary"].collect()}
    assert (summary["1"].stars, summary["1"].followers) == (5, 9)
    assert (summary["2"].stars, summary["2"].followers) == (None, None)

    # the same file under a new name, a newer event, a newer profile
    put(tmp_path / "events", "e2.json", [event(1), event(2, login="bob", repo="o/q"), event(3, kind=None)])
    put(tmp_path / "repos", "o__r2.json", {"full_name": "o/r", "stargazers_count": 6, "forks_count": 1, "language": "Go", "open_issues_count": 2, "created_at": "2020-01-01T00:00:00Z"})
    tables, _ = ingest_and_refresh(spark, landing, folder)
    assert tables["bronze_events"].count() == 6
    assert tables["silver_events"].count() == 2
    assert tables["repo_enriched"].filter("event_id = '1'").first().stars == 6
    # nothing new
    tables, _ = ingest_and_refresh(spark, landing, folder)
    assert tables["bronze_events"].count() == 6 and tables["silver_repos"].count() == 1


def field(path, kind="string"):
    return F.try_variant_get("raw_payload", f"$.{path}", kind)


def test_new_fields_appear_whatever_the_time_of_the_file(spark, tmp_path):
    place, table = tmp_path / "in", str(tmp_path / "bronze")
    put(place, "1.json", [event(1)])
    b.ingest(spark, str(place), table)
    put(place, "2.json", [event(2, public=True, payload={"size": 3})])
    os.utime(place / "2.json", (1_000_000_000, 1_000_000_000))  # long before the first file
    got = b.ingest(spark, str(place), table).select(field("id").alias("id"), field("public", "boolean"), field("payload.size", "int"))
    assert rows_of(got) == [("1", None, None), ("2", True, 3)]
    fields = dict(rows_of(b.known_fields(spark, table)))
    assert fields["public"] == "boolean" and fields["payload.size"] == "bigint" and fields["actor.login"] == "string"


@pytest.mark.parametrize("values", [[5, 5.5], [5, "five"], [None, {"a": 1}], [{"a": 1}, 3], [[1], {"a": 1}, "x", None, 2.5]])
def test_a_field_may_change_its_type(spark, tmp_path, values):
    place, table = tmp_path / "in", str(tmp_path / "bronze")
    for k, v in enumerate(values):
        put(place, f"{k}.json", [{"id": k, "v": v}, {"id": k + 100, "v": v}])
        got = b.ingest(spark, str(place), table)
    shown = {r[0]: r[1] for r in got.select(field("id", "int"), field("v")).collect()}
    texts = [None if v is None else v if isinstance(v, str) else json.dumps(v, separators=(",", ":")) for v in values]
    assert shown == {i: texts[i % 100] for k in range(len(values)) for i in (k, k + 100)}
    assert got.filter("malformed is not null").count() == 0


def test_lines_lists_blanks_and_broken_text(spark, tmp_path):
    place, table = tmp_path / "in", str(tmp_path / "bronze")
    place.mkdir()
    (place / "a.json").write_text('{"id":1}\n\n[{"id":2},{"id":3}]\n{"id":\n7\n')
    got = b.ingest(spark, str(place), table, multiline=False)
    assert sorted((r[0] or 0, r[1] or "") for r in got.select(field("id", "int"), "malformed").collect()) == [(0, ""), (0, '{"id":'), (1, ""), (2, ""), (3, "")]
    assert rows_of(b.known_fields(spark, table)) == [("id", "bigint")]


def test_odd_field_names(spark, tmp_path):
    place, table = tmp_path / "in", str(tmp_path / "bronze")
    put(place, "1.json", [{"a`b": 1, "OBJECT<": {"x y": [{"z": True}]}, "e": {}}])
    b.ingest(spark, str(place), table)
    assert dict(rows_of(b.known_fields(spark, table))) == {"a`b": "bigint", "OBJECT<.x y[*].z": "boolean", "e": "struct<>"}


def test_a_repeated_batch_replaces_its_rows(spark, tmp_path):
    """A run that ended before its batch was committed writes the batch again."""
    place, table = tmp_path / "in", tmp_path / "bronze"
    put(place, "1.json", [event(1), event(2)])
    b.ingest(spark, str(place), str(table))
    (table / "checkpoint" / "commits" / "0").unlink()
    (table / "checkpoint" / "commits" / ".0.crc").unlink()
    assert b.ingest(spark, str(place), str(table)).count() == 2


def test_silver_merges_only_new_batches(spark, landing, tmp_path):
    folder = str(tmp_path / "merged")
    ingest_and_merge(spark, landing, folder)
    put(tmp_path / "events", "e2.json", [event(1, login="eve", at="2024-01-02T00:00:00Z"), event(2, at="2023-01-01T00:00:00Z"), event(4), event(3, kind="late")])
    put(tmp_path / "repos", "new.json", [{"full_name": "o/r", "stargazers_count": 6, "updated_at": "2024-01-02T00:00:00Z"}, {"full_name": "o/r", "stargazers_count": 7, "updated_at": "2024-01-03T00:00:00Z"}])
    merged, metrics = ingest_and_merge(spark, landing, folder)
    rebuilt, other = ingest_and_refresh(spark, landing, str(tmp_path / "rebuilt"))
    for name in DATASETS:
        assert rows_of(merged[name].select(*rebuilt[name].columns).drop("ingestion_date")) == rows_of(rebuilt[name].drop("ingestion_date")), name
    assert {r.event_id: r.actor_login for r in merged["silver_events"].collect()} == {"1": "eve", "2": "bob", "3": "ann", "4": "ann"}
    assert merged["silver_repos"].first().stars == 7
    assert {(r.rule, r.failed) for r in metrics["silver_events"].collect()} == {(r.rule, r.failed) for r in other["silver_events"].collect()}
    # nothing new: no further state
    ingest_and_merge(spark, landing, folder)
    assert SnapshotTable(spark, f"{folder}/silver_events_state").current_version() == 1


EVENTS = "event_id string, event_type string, actor_login string, repo_name string, created_at timestamp, created_at_date date"


def some_events(rng, n):
    days = [dt.datetime(2024, 1, 1 + rng.randrange(4), rng.randrange(24), 5) for _ in range(n)]
    return [(str(rng.randrange(40)), rng.choice(["a", "b", None]), rng.choice(["x", "y", None]), rng.choice(["o/p", "o/q", None]), d, d.date()) for d in days]


def test_counts_added_up_equal_counts_anew(spark, tmp_path):
    rng, state = random.Random(3), {}
    for run in range(5):
        rows = {r[0]: r for r in some_events(rng, 25 if run != 3 else 0)}
        before = [state[k] for k in rows if k in state]
        frames = [spark.createDataFrame(x, EVENTS) for x in (before, list(rows.values()))]
        if run == 2:  # an attempt that was not completed, with other rows
            add_changes(spark, str(tmp_path), frames[0], frames[1].limit(3), run, fold_every=2)
        tables = add_changes(spark, str(tmp_path), *frames, run, fold_every=2)
        state.update(rows)
        now = spark.createDataFrame(list(state.values()), EVENTS)
        for name, counts in COUNTS.items():
            assert rows_of(tables[name]) == rows_of(counts.build(now).select(*tables[name].columns)), (run, name)
    assert AdditiveTable(spark, f"{tmp_path}/repo_velocity_counts", COUNTS["repo_velocity"]).folded() == 3


def test_reading_counts_of_a_day_opens_its_folders_only(spark, tmp_path):
    rows = spark.createDataFrame(some_events(random.Random(4), 40), EVENTS)
    table = add_changes(spark, str(tmp_path), rows.limit(0), rows, 0)["repo_velocity"]
    plan = table.where("window_date = date'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run" in plan and "window_date" in plan.split("PartitionFilters:")[1].split("]")[0]
    with pytest.raises(LookupError):
        AdditiveTable(spark, str(tmp_path / "none"), COUNTS["repo_velocity"]).read()


def test_sketches_of_days_merge_within_their_error(spark):
    events = spark.range(60_000).selectExpr("concat('u', id % 20000) as actor_login", "concat('r', id % 3) as repo_name", "date_add(date'2024-01-01', cast(id % 7 as int)) as created_at_date")
    daily = daily_contributors(events)
    assert daily.count() == 21
    exact = {r.repo_name: r.unique_contributors for r in g.user_stats(events).collect()}
    for r in contributors_of_days(daily).collect():
        assert abs(r.unique_contributors - exact[r.repo_name]) <= 0.05 * exact[r.repo_name]
    few = spark.createDataFrame([("a", "r", dt.date(2024, 1, 1)), ("a", "r", dt.date(2024, 1, 2)), ("b", "r", dt.date(2024, 1, 2))], "actor_login string, repo_name string, created_at_date date")
    assert [tuple(r) for r in contributors_of_days(daily_contributors(few)).collect()] == [("r", 2)]


def test_a_repeated_profile_stops_the_publish(spark, tmp_path):
    events = spark.createDataFrame([("1", "push", "ann", "o/r", dt.datetime(2024, 1, 1), dt.date(2024, 1, 1))], EVENTS)
    schema = "repo_name string, stars int, forks int, primary_language string, open_issues int"
    once = spark.createDataFrame([("o/r", 1, 1, "Go", 1), ("o/q", 1, 1, "Go", 1)], schema)
    spec = DATASETS["repo_enriched"]
    table = SnapshotTable(spark, str(tmp_path / "t"))
    publish(table, spec.build(events, once), spec.rules, "repo_enriched", spec.hidden)
    assert table.read().columns == [*g.EVENT_COLUMNS, *g.REPO_COLUMNS] and table.read().first().stars == 1
    with pytest.raises(q.ExpectationFailed, match="one profile per repository"):
        publish(table, spec.build(events, once.union(once)), spec.rules, "repo_enriched", spec.hidden)
    assert table.current_version() == 0
    plan = spec.build(events, once)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(repo_name") <= 2  # one for the events, one for grouping and join


def test_all_foreign_keys_in_one_scan_a_table(spark):
    child = spark.createDataFrame([(1, 1, "x"), (1, 9, "y"), (None, 9, "x"), (5, None, None)], "a int, b int, c string")
    parent = spark.createDataFrame([(1, "x"), (2, "x"), (None, None)], "id int, name string")
    keys = [q.ForeignKey("child", "a", "parent", "id"), q.ForeignKey("child", "b", "parent", "id"), q.ForeignKey("child", "c", "parent", "name"), q.ForeignKey("parent", "id", "parent", "id")]
    for df, name in ((child, "child"), (parent, "parent")):
        df.write.parquet(f"{spark.conf.get('spark.checkpoint.dir')}/keys-{name}")
    tables = {name: spark.read.parquet(f"{spark.conf.get('spark.checkpoint.dir')}/keys-{name}") for name in ("child", "parent")}
    checked = q.foreign_keys_check(tables, keys)
    assert rows_of(checked) == [("child.a", 1, 1), ("child.b", 2, 1), ("child.c", 1, 1), ("parent.id", 0, 0)]
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"(?<!Local)Relation \[", plan)) == 3  # the child, the parent as child, the parent as parent


def test_foreign_keys_move_once_as_counters(spark):
    child = spark.createDataFrame([(1, 1), (1, 9), (None, 9), (5, None), (9, 2)], "a int, b bigint")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id smallint")
    tables = {"child": child, "parent": parent, "none": parent.limit(0)}
    keys = [q.ForeignKey("child", "a", "parent", "id"), q.ForeignKey("child", "b", "parent", "id"), q.ForeignKey("child", "a", "none", "id")]
    checked = q.foreign_keys_check(tables, keys[:2])
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert rows_of(checked) == [("child.a", 2, 2), ("child.b", 2, 1)]
    # no lists per key, whose sort grows with a task's rows, and keys are no text
    assert "ObjectHashAggregate" not in plan and "as string" not in plan
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*key", plan)) == 1
    assert rows_of(q.foreign_keys_check(tables, keys[2:])) == [("child.a", 4, 3)]


def test_new_batches_are_pruned_by_folder(spark, landing, tmp_path):
    folder = str(tmp_path / "b")
    b.ingest(spark, landing["bronze_events"], folder)
    put(tmp_path / "events", "e2.json", [event(9)])
    b.ingest(spark, landing["bronze_events"], folder)
    fresh = b.read_bronze(spark, folder, after_batch=0)
    assert [r[0] for r in fresh.select(field("id")).collect()] == ["9"]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan


def test_merging_null_keys_ties_and_no_rows(spark):
    schema = "k string, v int, _ingested_at timestamp, source_file string, source_modified timestamp, batch_id long"
    latest = g.Latest(lambda df: df, "k", lambda: [F.col("_ingested_at").desc()])
    now, old = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1)
    first = spark.createDataFrame([("a", 1, now, "f", None, 0), ("a", 2, now, "f", None, 0), (None, 3, old, "f", None, 0), ("b", 4, old, "f", None, 0)], schema)
    second = spark.createDataFrame([("a", 9, old, "f", None, 1), (None, 5, now, "f", None, 1), ("c", None, None, "f", None, 1)], schema)
    merged = latest.merge(latest.state(first), second)
    assert rows_of(merged) == rows_of(latest.state(first.unionByName(second)))
    assert sorted(((r.k, r.v) for r in merged.collect()), key=str) == [("a", 2), ("b", 4), ("c", None), (None, 5)]
    assert rows_of(latest.merge(latest.state(first), second.limit(0))) == rows_of(latest.state(first))


def test_empty_landing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with pytest.raises(FileNotFoundError):
        b.ingest(spark, str(tmp_path / "in"), str(tmp_path / "bronze"))


def test_schema_merge():
    old = T.StructType.fromDDL("a int, s struct<x:string>")
    new = T.StructType.fromDDL("s struct<y:bigint>, a double, b boolean")
    merged = b.merge_schemas(old, new)
    assert merged.simpleString() == "struct<a:double,s:struct<x:string,y:bigint>,b:boolean>"
    assert b.merge_types(T.LongType(), T.StructType()) == T.VariantType()
    assert b.merge_types(T.DecimalType(2, 1), T.LongType()) == T.DoubleType()


def test_nested_landing_is_refused(spark, landing, tmp_path):
    landing["bronze_users"] = landing["bronze_events"] + "/users"
    with pytest.raises(ValueError):
        ingest_and_refresh(spark, landing, str(tmp_path / "t"))


def test_broken_rule_keeps_the_old_version(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    rules = [q.expect_or_fail("id", "id is not null"), q.expect_or_drop("v", "v > 0")]
    metrics = publish(table, spark.createDataFrame([(1, 1), (2, -1), (3, None)], "id int, v int"), rules, "t")
    assert [tuple(r)[1:] for r in metrics.collect()] == [("id", "fail", 3, 0), ("v", "drop", 1, 2)]
    with pytest.raises(q.ExpectationFailed):
        publish(table, spark.createDataFrame([(None, 1)], "id int, v int"), rules, "t")
    assert [r.id for r in table.read().collect()] == [1]
    assert publish(table, spark.createDataFrame([], "id int, v int"), rules, "t") is not None


def test_order_of_datasets():
    order = run_order()
    for name, spec in DATASETS.items():
        for read in spec.reads:
            if read in order:
                assert order.index(read) < order.index(name)
    with pytest.raises(Exception):
        run_order({"a": Dataset(("b",), None), "b": Dataset(("a",), None)})


def test_tables_that_do_not_read_each_other_are_published_side_by_side(spark, tmp_path):
    both, calls = threading.Barrier(2, timeout=60), []

    def meets(df):
        both.wait()
        return df

    def joined(a, c):
        calls.append("joined")
        return a.unionByName(c)

    start = {"start": spark.createDataFrame([(1,), (2,)], "id int")}
    few = q.expect_or_drop("few", "id < 2")
    datasets = {"a": Dataset(("start",), meets, rules=(few,)), "joined": Dataset(("a", "c"), joined), "c": Dataset(("start",), meets)}
    tables, metrics = refresh(spark, str(tmp_path / "good"), start, datasets)
    assert rows_of(tables["joined"]) == [(1,), (1,), (2,)] and list(metrics) == ["a"]
    # what stands beside a broken table is published, what comes after is not
    broken = {**datasets, "a": Dataset(("start",), meets, rules=(q.expect_or_fail("few", "id < 2"),))}
    with pytest.raises(q.ExpectationFailed):
        refresh(spark, str(tmp_path / "bad"), start, broken)
    assert calls == ["joined"] and SnapshotTable(spark, str(tmp_path / "bad/c")).read().count() == 2
    assert SnapshotTable(spark, str(tmp_path / "bad/a")).current_version() is None


def test_text_that_opens_an_object_needs_no_schema_of_its_own(spark):
    texts = ['{"a": 1}', '  {"a": 1}', '[{"a": 1}]', "{broken", "5", '"{"', '\t{"a": 1}', "[]"]
    lineage = "'f' source_file, current_timestamp() source_modified, current_timestamp() _ingested_at"
    rows = b.payload_rows(spark.createDataFrame([(x,) for x in texts], "value string").selectExpr("value", *lineage.split(", ")))
    is_object = F.schema_of_variant("raw_payload").startswith("OBJECT<")
    got = rows.select("_opens", F.coalesce(is_object, F.lit(False)).alias("o"), F.isnull("raw_payload").alias("n")).collect()
    assert [(r["_opens"], r.o, r.n) for r in got] == [
        (True, True, False), (True, True, False), (False, True, False), (True, False, True), (False, False, False), (False, False, False), (False, True, False),
    ]


def test_latest_snapshot_and_bad_numbers(spark):
    payload = '{"full_name":"o/r","stargazers_count":"%s","language":"x","forks_count":"1","created_at":"when"}'
    rows = spark.createDataFrame([(payload % "7", "f1", 1), (payload % "bad", "f2", 2)], "text string, source_file string, n int").selectExpr(
        "parse_json(text) as raw_payload", "source_file", "timestamp_seconds(n) as _ingested_at",
        "cast(null as timestamp) as source_modified", "0L as batch_id",
    )
    row = g.silver_repos(rows).first()
    assert (row.repo_name, row.stars, row.forks, row.repo_created_at) == ("o/r", None, 1, None)


def test_snapshots(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "s"))
    with pytest.raises(LookupError):
        table.read()
    assert table.write(spark.createDataFrame([(1, 1.0), (2, None)], "id int, v double"), "CREATE") == 0
    from pyspark.sql import functions as F

    table.update({"v": F.lit(9)}, F.col("v") > 0)
    assert sorted((r.id, r.v) for r in table.read().collect()) == [(1, 9.0), (2, None)]
    assert sorted((r.id, r.v) for r in table.read(0).collect()) == [(1, 1.0), (2, None)]
    assert [(r.version, r.operation, r.row_count) for r in table.history().orderBy("version").collect()] == [
        (0, "CREATE", 2), (1, "UPDATE", 2),
    ]
    diff = table.diff(0, None, ["id"], ["v"]).collect()
    assert [(r.id, r.old_v, r.new_v, r.change) for r in diff] == [(1, 1.0, 9.0, "changed")]
    with pytest.raises(LookupError):
        table.read(5)


def test_partitioned_snapshots_keep_types_and_may_be_empty(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "p"), ["code"])
    table.write(spark.createDataFrame([(1, "007"), (2, None)], "id int, code string"))
    assert sorted((r.id, r.code) for r in table.read().collect()) == [(1, "007"), (2, None)]
    table.write(spark.createDataFrame([], "id int, code string"))
    assert table.read().columns == ["id", "code"] and table.read().count() == 0


def test_batches_never_overwrite(spark, tmp_path):
    df = spark.range(2)
    files.append_batch(df, str(tmp_path / "l"), "1")
    with pytest.raises(Exception):
        files.append_batch(df, str(tmp_path / "l"), "1")


def test_key_checks(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (2, None)], "k int, p int")
    parents = spark.createDataFrame([(2,)], "id int")
    assert tuple(q.primary_key_check(df, ["k"], "t").first()) == ("t", 1, 1)
    assert tuple(q.foreign_key_check(df, "k", parents, "id", "fk").first()) == ("fk", 2, 1)
    assert tuple(q.check_constraint(df, "k < 2", "c").first()) == ("c", 4, 1)
