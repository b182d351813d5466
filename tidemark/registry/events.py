"""Queries over event ingestion, the silver and gold layers, and pipeline quality."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.adapters import Tables
from tidemark.operators import layers as g
from tidemark.operators import quality as q
from tidemark.plans.medallion import DATASETS, ingest_and_refresh, merge_new_batches, publish, run_order
from tidemark.plans.additive import COUNTS, add_changes, contributors_of_days, daily_contributors
from tidemark.registry.base import register, rounded
from tidemark.registry.storage import iso_text
from tidemark.session import fresh_path, side_by_side, staged
from tidemark.sources import files
from tidemark.sources.snapshots import SnapshotTable
from tidemark.streaming.bronze import ingest, known_fields, read_bronze

# ---- landing files made from the driver tables --------------------------------------------------


def event_payloads(t: Tables) -> DataFrame:
    return t.feed_events.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("type"),
        F.struct(F.col("actor_login").alias("login")).alias("actor"),
        F.struct(F.col("repo_name").alias("name")).alias("repo"),
        iso_text("created_at").alias("created_at"),
    )


def repo_payloads(t: Tables) -> DataFrame:
    return t.feed_repos.select(
        F.col("repo_name").alias("full_name"),
        F.col("stars").alias("stargazers_count"),
        F.col("forks").alias("forks_count"),
        F.col("primary_language").alias("language"),
        F.col("open_issues").alias("open_issues_count"),
        F.lit("2020-01-01T00:00:00Z").alias("created_at"),
    )


def user_payloads(t: Tables) -> DataFrame:
    return t.feed_users.select(
        F.col("actor_login").alias("login"),
        "company",
        "location",
        "followers",
        "public_repos",
        F.lit("2019-06-01T00:00:00Z").alias("created_at"),
    )


def snapshots_of(t: Tables, kind: str) -> tuple[DataFrame, DataFrame]:
    """Profiles as they were, one more star or follower each, and as they are."""
    rows, count = (repo_payloads(t), "stargazers_count") if kind == "repos" else (user_payloads(t), "followers")
    return rows.withColumn(count, F.col(count) + 1), rows


def land_kind(t: Tables, kind: str, place: str) -> str:
    """Write one kind of payload as JSON: errors are delivered twice, profiles in batch 9 and again, changed, in batch 10."""
    if kind == "events":
        events = event_payloads(t)
        files.append_batch(events, place, "1")
        files.append_batch(events.filter(F.col("type") == "error"), place, "2")
    else:
        before, now = snapshots_of(t, kind)
        files.append_batch(before, place, "9")
        files.append_batch(now, place, "10")
    return place


def land(t: Tables, folder: str) -> dict[str, str]:
    """Write events, repositories and users as JSON."""
    kinds = ("events", "repos", "users")
    places = side_by_side(t.spark, *[partial(land_kind, t, kind, f"{folder}/{kind}") for kind in kinds])
    return {f"bronze_{kind}": place for kind, place in zip(kinds, places)}


def bronze(t: Tables, kind: str) -> DataFrame:
    """Bronze table of one kind, landed and ingested anew."""
    folder = fresh_path(t.spark, "feed")
    return ingest(t.spark, land_kind(t, kind, f"{folder}/landing"), f"{folder}/bronze", multiline=False)


def payload(path: str, kind: str = "string"):
    return F.try_variant_get("raw_payload", f"$.{path}", kind)


DELIVERED_SQL = "(select * from feed_events union all select * from feed_events where event_type = 'error')"

register(
    "j01_bronze_events",
    lambda t: bronze(t, "events").select(
        payload("id").alias("event_id"),
        payload("type").alias("event_type"),
        payload("actor.login").alias("actor_login"),
        payload("repo.name").alias("repo_name"),
    ),
    f"select cast(event_id as varchar) as event_id, event_type, actor_login, repo_name from {DELIVERED_SQL} e",
)
register(
    "j02_bronze_repos",
    lambda t: bronze(t, "repos").select(
        payload("full_name").alias("full_name"),
        payload("stargazers_count", "long").alias("stargazers_count"),
        payload("language").alias("language"),
    ),
    """select repo_name as full_name, cast(stars + more as bigint) as stargazers_count, primary_language as language
       from feed_repos, (values (0), (1)) d(more)""",
)
register(
    "j03_bronze_users",
    lambda t: bronze(t, "users").select(
        payload("login").alias("login"), payload("company").alias("company"), payload("followers", "long").alias("followers")
    ),
    """select actor_login as login, company, cast(followers + more as bigint) as followers
       from feed_users, (values (0), (1)) d(more)""",
)


def _mixed(t):
    """One field as a number, a fraction, a text, an object and a null in five deliveries, and lists of payloads."""
    folder = fresh_path(t.spark, "mixed")
    landing, table = f"{folder}/landing", f"{folder}/bronze"
    ids = t.feed_events.select("event_id")
    number = F.col("event_id").cast("string")
    values = [number, F.concat(number, F.lit(".5")), F.concat(F.lit('"n'), number, F.lit('"')), F.concat(F.lit('{"n":'), number, F.lit("}")), F.lit("null")]
    for k, value in enumerate(values):
        line = F.concat(F.lit('[{"id":'), number, F.lit(f',"delivery":{k},"size":'), value, F.lit("}]"))
        ids.select(line.alias("value")).write.text(f"{landing}/batch_id={k}")
        ingest(t.spark, landing, table, multiline=False)
    return table


register(
    "j01_payload_of_any_type",
    lambda t: read_bronze(t.spark, _mixed(t)).select(
        payload("id", "long").alias("event_id"),
        payload("delivery", "int").alias("delivery"),
        payload("size").alias("size"),
        payload("size", "double").alias("as_number"),
        payload("size.n", "long").alias("inner_n"),
    ),
    """select cast(event_id as bigint) as event_id, d.delivery,
              case d.delivery when 0 then cast(event_id as varchar) when 1 then concat(event_id, '.5') when 2 then concat('n', event_id)
                              when 3 then concat('{"n":', event_id, '}') end as size,
              cast(case d.delivery when 0 then event_id when 1 then event_id + 0.5 end as double) as as_number,
              cast(case d.delivery when 3 then event_id end as bigint) as inner_n
       from feed_events, (values (0), (1), (2), (3), (4)) d(delivery)""",
)


def _twice(t):
    """Ingest, run again without new files, add a batch, run again: rows after each run."""
    folder = fresh_path(t.spark, "incremental")
    landing, table = f"{folder}/landing", f"{folder}/bronze"
    events = event_payloads(t)
    counts = []
    for run, batch in enumerate([events, None, events.filter(F.col("type") == "error")]):
        if batch is not None:
            files.append_batch(batch, landing, str(run))
        seen = ingest(t.spark, landing, table, multiline=False)
        # the table grows with the next run: fix this run's count now, one number per run
        counts.append((run, seen.count()))
    return t.spark.createDataFrame(counts, "run int, rows bigint")


register(
    "j04_incremental_discovery",
    _twice,
    f"""select cast(0 as integer) as run, count(*) as rows from feed_events
        union all select 1, count(*) from feed_events union all select 2, count(*) from {DELIVERED_SQL} e""",
)


def _evolved(t):
    folder = fresh_path(t.spark, "evolution")
    landing, table = f"{folder}/landing", f"{folder}/bronze"
    events = event_payloads(t)
    files.append_batch(events.drop("repo"), landing, "1")
    ingest(t.spark, landing, table, multiline=False)
    files.append_batch(events.withColumn("public", F.lit(True)), landing, "2")
    rows = ingest(t.spark, landing, table, multiline=False)
    return rows.select(
        payload("id").alias("event_id"),
        payload("repo.name").alias("repo_name"),
        payload("public", "boolean").alias("is_public"),
    )


register(
    "j05_schema_evolution",
    _evolved,
    """select cast(event_id as varchar) as event_id, null as repo_name, cast(null as boolean) as is_public from feed_events
       union all select cast(event_id as varchar), repo_name, true from feed_events""",
)


def _fields_and_payloads(t):
    table = _mixed(t)
    payloads = read_bronze(t.spark, table).agg(F.count(F.lit(1))).scalar()
    return known_fields(t.spark, table).withColumn("payloads", payloads)


register(
    "j05_known_fields",
    _fields_and_payloads,
    """select path, type, (select 5 * count(*) from feed_events) as payloads
       from (values ('delivery', 'bigint'), ('id', 'bigint'), ('size', 'variant')) f(path, type)""",
)
register(
    "j06_lineage_columns",
    lambda t: bronze(t, "events").select(
        payload("id").alias("event_id"),
        F.regexp_extract("source_file", "batch_id=([0-9]+)", 1).alias("batch"),
        (F.col("ingestion_date") == F.to_date("_ingested_at")).alias("date_fits"),
    ),
    """select cast(event_id as varchar) as event_id, '1' as batch, true as date_fits from feed_events
       union all select cast(event_id as varchar), '2', true from feed_events where event_type = 'error'""",
)

# ---- silver -------------------------------------------------------------------------------------


def _plain(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


EVENT_LIST = "event_id, event_type, actor_login, repo_name, created_at, created_at_date"

register(
    "j07_silver_events",
    lambda t: _plain(g.silver_events(bronze(t, "events")), "created_at"),
    """select cast(event_id as varchar) as event_id, event_type, actor_login, repo_name, created_at, created_at_date
       from feed_events""",
)
register(
    "j08_silver_repos",
    lambda t: _plain(g.silver_repos(bronze(t, "repos")).drop("ingestion_date"), "repo_created_at"),
    """select repo_name, stars, forks, primary_language, open_issues,
              timestamp '2020-01-01 00:00:00' as repo_created_at from feed_repos""",
)
register(
    "j09_silver_users",
    lambda t: _plain(g.silver_users(bronze(t, "users")).drop("ingestion_date"), "user_created_at"),
    """select actor_login, company, location, followers, public_repos,
              timestamp '2019-06-01 00:00:00' as user_created_at from feed_users""",
)



def _merged(t, kind, dataset):
    """The silver table after two runs, the second of which reads only the second batch."""
    folder = fresh_path(t.spark, "merged")
    landing, bronze_tables = f"{folder}/landing/{kind}", {f"bronze_{kind}": f"{folder}/bronze_{kind}"}
    if kind == "events":
        # first with another type, then once more as it is, in two overlapping parts
        events = event_payloads(t)
        deliveries = [events.withColumn("type", F.lit("draft")).filter(F.length("id") % 2 == 0), events]
    else:
        deliveries = snapshots_of(t, kind)
    for batch, rows in enumerate(deliveries):
        files.append_batch(rows, landing, str(batch))
        ingest(t.spark, landing, bronze_tables[f"bronze_{kind}"], multiline=False)
        tables, _ = merge_new_batches(t.spark, folder, bronze_tables, {dataset: DATASETS[dataset]})
    return tables[dataset]


register(
    "j07_silver_events_merged",
    lambda t: _plain(_merged(t, "events", "silver_events"), "created_at"),
    """select cast(event_id as varchar) as event_id, event_type, actor_login, repo_name, created_at, created_at_date
       from feed_events where event_type is not null""",
)
register(
    "j08_silver_repos_merged",
    lambda t: _plain(_merged(t, "repos", "silver_repos").drop("ingestion_date"), "repo_created_at"),
    """select repo_name, stars, forks, primary_language, open_issues,
              timestamp '2020-01-01 00:00:00' as repo_created_at from feed_repos where stars is not null""",
)
register(
    "j09_silver_users_merged",
    lambda t: _plain(_merged(t, "users", "silver_users").drop("ingestion_date"), "user_created_at"),
    """select actor_login, company, location, followers, public_repos,
              timestamp '2019-06-01 00:00:00' as user_created_at from feed_users""",
)

# ---- gold ---------------------------------------------------------------------------------------

REPO_LIST = "r.stars, r.forks, r.primary_language, r.open_issues"
USER_LIST = "u.company, u.location, u.followers, u.public_repos"
ENRICHED_SQL = f"""(select e.*, {REPO_LIST}, {USER_LIST}
    from feed_events e left join feed_repos r on r.repo_name = e.repo_name
    left join feed_users u on u.actor_login = e.actor_login)"""

register(
    "j10_repo_velocity",
    lambda t: g.repo_velocity(t.feed_events),
    """select repo_name, count(*) as event_count, date_trunc('hour', created_at) as event_hour,
              cast(date_trunc('hour', created_at) as date) as window_date
       from feed_events group by all""",
)
register(
    "j11_user_stats",
    lambda t: g.user_stats(t.feed_events),
    "select repo_name, count(distinct actor_login) as unique_contributors from feed_events group by 1",
)
register(
    "j12_event_distribution",
    lambda t: g.event_distribution(t.feed_events),
    """select cast(hour(created_at) as integer) as hour_of_day, count(*) as event_count
       from feed_events group by 1""",
)
register(
    "j13_repo_enriched",
    lambda t: g.repo_enriched(t.feed_events, t.feed_repos),
    f"select {EVENT_LIST}, stars, forks, primary_language, open_issues from {ENRICHED_SQL} x",
)
register(
    "j14_language_distribution",
    lambda t: g.language_distribution(g.repo_enriched(t.feed_events, t.feed_repos)),
    f"""select coalesce(primary_language, 'Unknown') as primary_language, count(*) as event_count,
               count(distinct repo_name) as repo_count, count(distinct actor_login) as distinct_contributors,
               round(avg(stars), 2) as avg_stars, round(avg(forks), 2) as avg_forks,
               round(avg(open_issues), 2) as avg_open_issues
        from {ENRICHED_SQL} x group by 1""",
)
register(
    "j15_user_enriched",
    lambda t: g.user_enriched(t.feed_events, t.feed_users),
    f"select {EVENT_LIST}, company, location, followers, public_repos from {ENRICHED_SQL} x",
)
register(
    "j16_activity_summary",
    lambda t: g.activity_summary(t.feed_events, t.feed_repos, t.feed_users),
    f"select * from {ENRICHED_SQL} x",
)


# what is added up of each dataset beside its rows
_TOTALS = {
    "silver_events": "count(distinct actor_login)",
    "silver_repos": "sum(stars)",
    "silver_users": "sum(followers)",
    "repo_velocity": "sum(event_count * hour(event_hour))",
    "user_stats": "sum(unique_contributors)",
    "event_distribution": "sum(event_count * hour_of_day)",
    "repo_enriched": "sum(stars)",
    "language_distribution": "sum(event_count * repo_count)",
    "user_enriched": "sum(followers)",
    "activity_summary": "sum(stars + followers)",
}


def _run_all(t):
    folder = fresh_path(t.spark, "layers")
    tables, _ = ingest_and_refresh(t.spark, land(t, f"{folder}/landing"), f"{folder}/tables", multiline=False)
    counts = [
        tables[name].agg(F.count(F.lit(1)).alias("rows"), F.expr(f"cast({_TOTALS[name]} as bigint)").alias("total"))
        .select(F.lit(name).alias("dataset"), "rows", "total")
        for name in run_order()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


register(
    "j17_dataset_graph",
    _run_all,
    f"""with x as {ENRICHED_SQL},
             hours as (select repo_name, date_trunc('hour', created_at) as h, count(*) as n from feed_events group by 1, 2),
             langs as (select count(*) as n, count(distinct repo_name) as r from x group by coalesce(primary_language, 'Unknown')),
             people as (select count(distinct actor_login) as n from feed_events group by repo_name)
        select 'silver_events' as dataset, count(*) as rows, count(distinct actor_login) as total from feed_events
        union all select 'silver_repos', count(*), cast(sum(stars) as bigint) from feed_repos
        union all select 'silver_users', count(*), cast(sum(followers) as bigint) from feed_users
        union all select 'repo_velocity', count(*), cast(sum(n * hour(h)) as bigint) from hours
        union all select 'user_stats', count(*), cast(sum(n) as bigint) from people
        union all select 'event_distribution', count(distinct hour(created_at)), cast(sum(hour(created_at)) as bigint)
                  from feed_events
        union all select 'repo_enriched', count(*), cast(sum(stars) as bigint) from x
        union all select 'language_distribution', count(*), cast(sum(n * r) as bigint) from langs
        union all select 'user_enriched', count(*), cast(sum(followers) as bigint) from x
        union all select 'activity_summary', count(*), cast(sum(stars + followers) as bigint) from x""",
)


def _refreshed(t):
    table = SnapshotTable(t.spark, fresh_path(t.spark, "user-stats"))
    publish(table, g.user_stats(t.feed_events), (), "user_stats")
    publish(table, g.user_stats(t.feed_events), (), "user_stats")
    return table.read()




def _three_deliveries(t):
    """Events in three overlapping deliveries, the first with other types and times an hour later; before and after of each."""
    now = t.feed_events.withColumn("event_id", F.col("event_id").cast("string"))
    draft = now.withColumn("event_type", F.lit("draft")).withColumn("created_at", F.col("created_at") + F.expr("interval 1 hour"))
    part = F.pmod(F.hash("event_id"), F.lit(3))
    state = None
    for rows in (draft.filter(part < 2), now.filter(part > 0), now.filter(part < 2)):
        if state is None:
            yield rows.limit(0), rows
            state = staged(rows, "events")
            continue
        keys = rows.select("event_id")
        yield state.join(keys, "event_id", "left_semi"), rows
        state = staged(state.join(keys, "event_id", "left_anti").unionByName(rows), "events")


def _added(t, name):
    folder = fresh_path(t.spark, "counts")
    for run, (before, after) in enumerate(_three_deliveries(t)):
        tables = add_changes(t.spark, folder, before, after, run, {name: COUNTS[name]}, fold_every=2)
    return tables[name]


register(
    "j18_velocity_by_addition",
    lambda t: _added(t, "repo_velocity"),
    """select repo_name, count(*) as event_count, date_trunc('hour', created_at) as event_hour,
              cast(date_trunc('hour', created_at) as date) as window_date
       from feed_events group by all""",
)
register(
    "j18_types_by_addition",
    lambda t: _added(t, "event_type_breakdown"),
    "select event_type, count(*) as event_count from feed_events group by 1",
)


def _sketched(t):
    """Exact distinct contributors, and whether merged daily sketches come within a twentieth of them."""
    daily = staged(daily_contributors(t.feed_events), "sketches")
    near = F.abs(F.col("unique_contributors") - F.col("exact")) <= F.greatest(F.lit(1), F.col("exact") / 20)
    exact = g.user_stats(t.feed_events).withColumnRenamed("unique_contributors", "exact")
    return exact.join(contributors_of_days(daily), "repo_name").select("repo_name", "exact", near.alias("near"))


register(
    "j11_contributors_by_sketch",
    _sketched,
    "select repo_name, count(distinct actor_login) as exact, true as near from feed_events where repo_name is not null group by 1",
)
register(
    "j18_materialized_refresh",
    _refreshed,
    "select repo_name, count(distinct actor_login) as unique_contributors from feed_events group by 1",
)
register(
    "j19_enrichment_targets_repos",
    lambda t: g.repo_targets(t.feed_events),
    """select distinct repo_name, true as is_valid, split_part(repo_name, '/', 1) as owner,
              split_part(repo_name, '/', 2) as repo, concat(replace(repo_name, '/', '__'), '.json') as file_name
       from feed_events""",
)
register(
    "j20_enrichment_targets_users",
    lambda t: g.user_targets(t.feed_events),
    """select distinct actor_login, true as is_valid, concat(actor_login, '.json') as file_name
       from feed_events""",
)


def _run_results(t):
    """Each target's outcome: valid ones with a profile are processed, without one failed."""
    profiles = t.feed_repos.select("repo_name", F.lit(True).alias("found"))
    state = F.when(~F.col("is_valid"), "skipped").when(F.col("found"), "processed").otherwise("failed")
    return g.repo_targets(t.feed_events).join(profiles, "repo_name", "left").select(
        F.col("owner").alias("batch_id"), state.alias("status")
    )


register(
    "j21_run_summary",
    lambda t: g.run_summary(_run_results(t)),
    """select split_part(e.repo_name, '/', 1) as batch_id,
              case when r.repo_name is null then 'failed' else 'processed' end as status, count(*) as entities
       from (select distinct repo_name from feed_events) e left join feed_repos r on r.repo_name = e.repo_name
       group by all""",
)


def _landed(t):
    folder = fresh_path(t.spark, "landing")
    events = event_payloads(t)
    files.append_batch(events, folder, "0")
    files.append_batch(events.filter(F.col("type") == "error"), folder, "1")
    return files.read_json(t.spark, folder).groupBy("batch_id", "type").agg(F.count(F.lit(1)).alias("rows"))


register(
    "j22_append_only_landing",
    _landed,
    """select cast(0 as integer) as batch_id, event_type as type, count(*) as rows from feed_events group by all
       union all select 1, event_type, count(*) from feed_events where event_type = 'error' group by all""",
)
register(
    "j23_top_repos",
    lambda t: g.top_repos(g.repo_velocity(t.feed_events)),
    """select repo_name, count(*) as event_count from feed_events group by 1
       order by 2 desc, 1 limit 10""",
)
register(
    "j24_top_repos_by_contributors",
    lambda t: g.top_repos_by_contributors(g.user_stats(t.feed_events)),
    """select repo_name, count(distinct actor_login) as unique_contributors from feed_events group by 1
       order by 2 desc, 1 limit 10""",
)
register(
    "j25_event_type_breakdown",
    lambda t: g.event_type_breakdown(t.feed_events),
    "select event_type, count(*) as event_count from feed_events group by 1",
)
register(
    "j26_most_active_contributors",
    lambda t: g.most_active_contributors(t.feed_events),
    """select actor_login, count(*) as event_count from feed_events group by 1
       order by 2 desc, 1 limit 10""",
)
register(
    "j27_ingestion_health",
    lambda t: g.ingestion_health(bronze(t, "events")).agg(
        F.sum("row_count").alias("row_count"), (F.sum("file_count") > 1).alias("several_files")
    ),
    f"select count(*) as row_count, true as several_files from {DELIVERED_SQL} e",
)
register(
    "j28_platform_summary",
    lambda t: rounded(
        g.platform_summary(g.activity_summary(t.feed_events, t.feed_repos, t.feed_users)),
        6,
        "avg_stars",
        "avg_followers",
    ),
    f"""with x as {ENRICHED_SQL}
        select (select count(*) from x) as total_events, (select count(distinct primary_language) from x) as languages,
               (select count(distinct repo_name) from x) as repositories,
               (select round(avg(stars), 6) from (select distinct repo_name, stars from x)) as avg_stars,
               (select count(distinct actor_login) from x) as contributors,
               (select round(avg(followers), 6) from (select distinct actor_login, followers from x)) as avg_followers""",
)

# ---- quality ------------------------------------------------------------------------------------

# an event without known repository attributes breaks the second rule
ENRICHED_RULES = (
    q.expect_or_fail("event_id not null", "event_id is not null"),
    q.expect_or_drop("stars not null", "stars is not null"),
    q.Rule("popular repository", "stars > 10"),
)


def _published(t):
    table = SnapshotTable(t.spark, fresh_path(t.spark, "checked"))
    metrics = publish(table, g.repo_enriched(t.feed_events, t.feed_repos), ENRICHED_RULES, "repo_enriched")
    return table, metrics


register(
    "k01_expect_or_fail",
    lambda t: _published(t)[0].read().select("event_id", "stars"),
    f"select event_id, stars from {ENRICHED_SQL} x where event_id is not null and stars is not null",
)
register(
    "k02_expect_or_drop",
    lambda t: q.keep_valid(g.repo_enriched(t.feed_events, t.feed_repos), ENRICHED_RULES).select("event_id", "stars"),
    f"select event_id, stars from {ENRICHED_SQL} x where stars is not null",
)
METRICS_SQL = f"""with x as {ENRICHED_SQL}
    select 'repo_enriched' as dataset, 'event_id not null' as rule, 'fail' as action,
           count(event_id) as passed, count(*) - count(event_id) as failed from x
    union all select 'repo_enriched', 'stars not null', 'drop', count(stars), count(*) - count(stars) from x
    union all select 'repo_enriched', 'popular repository', 'warn', count(*) filter (where stars > 10),
                     count(*) - count(*) filter (where stars > 10) from x"""
register(
    "k03_expectation_metrics",
    lambda t: q.rule_metrics(g.repo_enriched(t.feed_events, t.feed_repos), ENRICHED_RULES, "repo_enriched"),
    METRICS_SQL,
)
register("k03_metrics_while_writing", lambda t: _published(t)[1], METRICS_SQL)


def _kept(t):
    rows = bronze(t, "events")
    kept = g.silver_events(rows).agg(F.count(F.lit(1))).scalar()
    return rows.agg(F.count(F.lit(1)).alias("delivered")).withColumn("kept", kept)


register(
    "k06_idempotency_count",
    _kept,
    f"""select (select count(*) from {DELIVERED_SQL} e) as delivered, (select count(*) from feed_events) as kept""",
)
register(
    "k07_enrichment_coverage",
    lambda t: rounded(
        q.coverage(
            g.activity_summary(t.feed_events, t.feed_repos, t.feed_users),
            {"repo_coverage": "stars", "user_coverage": "followers", "language_coverage": "primary_language"},
        ),
        6,
        "repo_coverage",
        "user_coverage",
        "language_coverage",
    ),
    f"""select count(*) as total_rows, round(count(stars) / count(*), 6) as repo_coverage,
               round(count(followers) / count(*), 6) as user_coverage,
               round(count(primary_language) / count(*), 6) as language_coverage from {ENRICHED_SQL} x""",
)
register(
    "k12_repeated_before_dedup",
    lambda t: q.duplicate_keys(g.flat_events(bronze(t, "events")), ["event_id"]),
    f"""select cast(event_id as varchar) as event_id, count(*) as occurrences from {DELIVERED_SQL} e
        group by 1 having count(*) > 1""",
)
register(
    "k12_unique_after_dedup",
    lambda t: q.duplicate_keys(g.silver_events(bronze(t, "events")), ["event_id"]),
    "select cast(event_id as varchar) as event_id, count(*) as occurrences from feed_events group by 1 having count(*) > 1",
)
