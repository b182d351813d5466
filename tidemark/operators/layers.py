"""Silver and gold layers over event, repository and user payloads."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.operators.joins import keys_of
from tidemark.operators.quality import Rule, expect_or_drop, expect_or_fail
from tidemark.operators.skew import latest_per_key
from tidemark.session import staged

EVENT_RULES: tuple[Rule, ...] = (
    expect_or_fail("event_id not null", "event_id is not null"),
    expect_or_drop("event_type not null", "event_type is not null"),
)
REPO_RULES: tuple[Rule, ...] = (
    expect_or_fail("repo_name not null", "repo_name is not null"),
    expect_or_drop("stars not null", "stars is not null"),
)
USER_RULES: tuple[Rule, ...] = (expect_or_fail("actor_login not null", "actor_login is not null"),)


# ---- silver -------------------------------------------------------------------------------------


LINEAGE = ("_ingested_at", "source_file", "source_modified", "batch_id")


def payload_text(path: str) -> Column:
    """A field of the payload as text, null where it is absent; objects and lists as JSON."""
    return F.try_variant_get("raw_payload", path, "string")


def newest_first() -> list[Column]:
    """Order in which one snapshot follows another: ingestion, then the batch number in the path, then the time the file
    was written, then the path.

    All files of one run share their ingestion time, and text order would
    put batch 10 before batch 9.
    """
    batch = F.regexp_extract("source_file", r"batch_id=(\d{1,18})(?:/|$)", 1)
    number = F.when(batch != "", batch).cast("long")
    return [
        F.col("_ingested_at").desc(),
        number.desc_nulls_last(),
        F.col("source_modified").desc_nulls_last(),
        F.col("source_file").desc(),
    ]


def flat_events(bronze: DataFrame) -> DataFrame:
    """Events as delivered, with their origin."""
    created = c.iso_timestamp(payload_text("$.created_at"))
    return bronze.select(
        payload_text("$.id").alias("event_id"),
        payload_text("$.type").alias("event_type"),
        payload_text("$.actor.login").alias("actor_login"),
        payload_text("$.repo.name").alias("repo_name"),
        created.alias("created_at"),
        F.to_date(created).alias("created_at_date"),
        *LINEAGE,
    )


def flat_repos(bronze: DataFrame) -> DataFrame:
    """Repository snapshots as delivered, with their origin and the time the source says they were changed."""
    return _flat_entity(
        bronze,
        {
            "repo_name": payload_text("$.full_name"),
            "stars": c.to_int(payload_text("$.stargazers_count")),
            "forks": c.to_int(payload_text("$.forks_count")),
            "primary_language": payload_text("$.language"),
            "open_issues": c.to_int(payload_text("$.open_issues_count")),
            "repo_created_at": c.iso_timestamp(payload_text("$.created_at")),
        },
    )


def flat_users(bronze: DataFrame) -> DataFrame:
    """User snapshots as delivered, with their origin and the time the source says they were changed."""
    return _flat_entity(
        bronze,
        {
            "actor_login": payload_text("$.login"),
            "company": payload_text("$.company"),
            "location": payload_text("$.location"),
            "followers": c.to_int(payload_text("$.followers")),
            "public_repos": c.to_int(payload_text("$.public_repos")),
            "user_created_at": c.iso_timestamp(payload_text("$.created_at")),
        },
    )


def _flat_entity(bronze: DataFrame, fields: Mapping[str, Column]) -> DataFrame:
    return bronze.select(
        *[value.alias(name) for name, value in fields.items()],
        F.to_date("_ingested_at").alias("ingestion_date"),
        c.iso_timestamp(payload_text("$.updated_at")).alias(CHANGED_AT),
        *LINEAGE,
    )


#: Decides between two snapshots of one entity in one file.
CHANGED_AT = "_changed_at"


class Latest:
    """The latest row per key of flat rows, kept as a state that new rows are merged into.

    The state is what the latest row per key of all rows would be, with its origin; ``published`` leaves the origin out.
    Rows that tie in everything the order knows are told apart by their values, so the choice is the same in each run.
    """

    def __init__(self, flat: Callable[[DataFrame], DataFrame], key: str, order: Callable[[], list[Column]]):
        self.flat, self.key, self.order = flat, key, order

    def state(self, flat: DataFrame) -> DataFrame:
        ties = [F.col(name).desc_nulls_last() for name in flat.columns if name not in (*LINEAGE, self.key)]
        return latest_per_key(flat, [self.key], [*self.order(), *ties])

    def merge(self, state: DataFrame, fresh: DataFrame) -> DataFrame:
        """State after the rows of ``fresh``: only keys that occur there are ranked again, all others pass.

        The latest of the latest and the new rows is the latest of all rows, so the result is that of a rebuild.
        """
        again = self.state(self.touched(state, fresh).unionByName(fresh))
        return self.touched(state, fresh, "left_anti").unionByName(again)

    def touched(self, state: DataFrame, fresh: DataFrame, how: str = "left_semi") -> DataFrame:
        """Rows of the state whose keys occur in ``fresh``, or with ``left_anti`` the others."""
        keys = fresh.select(F.col(self.key).alias("_touched")).distinct()
        return state.join(keys, F.col(self.key).eqNullSafe(F.col("_touched")), how)

    def published(self, state: DataFrame) -> DataFrame:
        return state.drop(*LINEAGE, CHANGED_AT)

    def __call__(self, bronze: DataFrame) -> DataFrame:
        return self.published(self.state(self.flat(bronze)))


def _entity_order() -> list[Column]:
    return [*newest_first(), F.col(CHANGED_AT).desc_nulls_last()]


def _event_order() -> list[Column]:
    return [F.col("created_at").desc_nulls_last(), *newest_first()]


#: One row per event id: the latest by event time, then by ingestion.
silver_events = Latest(flat_events, "event_id", _event_order)
#: Latest snapshot of each repository and user.
silver_repos = Latest(flat_repos, "repo_name", _entity_order)
silver_users = Latest(flat_users, "actor_login", _entity_order)


# ---- gold ---------------------------------------------------------------------------------------


def repo_velocity(events: DataFrame) -> DataFrame:
    """Events per repository and hour."""
    return (
        events.groupBy(F.window("created_at", "1 hour"), "repo_name")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(
            "repo_name",
            "event_count",
            F.col("window.start").alias("event_hour"),
            F.to_date("window.start").alias("window_date"),
        )
    )


def user_stats(events: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct contributors per repository; approximate only on request."""
    count = F.approx_count_distinct("actor_login") if approximate else F.countDistinct("actor_login")
    return events.groupBy("repo_name").agg(count.alias("unique_contributors"))


def event_distribution(events: DataFrame) -> DataFrame:
    """Events per hour of the day."""
    return events.groupBy(F.hour("created_at").alias("hour_of_day")).agg(F.count(F.lit(1)).alias("event_count"))


EVENT_COLUMNS = ("event_id", "event_type", "actor_login", "repo_name", "created_at", "created_at_date")
REPO_COLUMNS = ("stars", "forks", "primary_language", "open_issues")
USER_COLUMNS = ("company", "location", "followers", "public_repos")


#: Names of the columns that count the profiles an event met, for the rules below.
REPO_PROFILES, USER_PROFILES = "_repo_profiles", "_user_profiles"
ONE_REPO = expect_or_fail("one profile per repository", f"coalesce({REPO_PROFILES}, 1) = 1")
ONE_USER = expect_or_fail("one profile per contributor", f"coalesce({USER_PROFILES}, 1) = 1")


def _enrich(events: DataFrame, dimension: DataFrame, key: str, take: Sequence[str], profiles: str | None = None) -> DataFrame:
    """Left join to a dimension with one row per key.

    No broadcast hint: the planner broadcasts the dimension if its files are
    small. Otherwise a hot key on the event side is split at run time.
    With ``profiles`` the dimension is grouped by key, in the shuffle that
    the join needs anyway, and the rows per key are counted in that column:
    events do not multiply, and a rule can tell a repeated profile.
    """
    rows = dimension.select(key, *take)
    if profiles:
        rows = rows.groupBy(key).agg(F.count(F.lit(1)).alias(profiles), *[F.any_value(name).alias(name) for name in take])
    return events.join(rows, key, "left")


def repo_enriched(events: DataFrame, repos: DataFrame, guarded: bool = False) -> DataFrame:
    """Each event with its repository's attributes."""
    guard = (REPO_PROFILES,) if guarded else ()
    return _enrich(events, repos, "repo_name", REPO_COLUMNS, *guard).select(*EVENT_COLUMNS, *REPO_COLUMNS, *guard)


def user_enriched(events: DataFrame, users: DataFrame, guarded: bool = False) -> DataFrame:
    """Each event with its contributor's profile."""
    guard = (USER_PROFILES,) if guarded else ()
    return _enrich(events, users, "actor_login", USER_COLUMNS, *guard).select(*EVENT_COLUMNS, *USER_COLUMNS, *guard)


def activity_summary(events: DataFrame, repos: DataFrame, users: DataFrame, guarded: bool = False) -> DataFrame:
    """Each event with repository and contributor attributes."""
    guard = (REPO_PROFILES, USER_PROFILES) if guarded else ()
    with_repo = _enrich(events, repos, "repo_name", REPO_COLUMNS, *guard[:1])
    return _enrich(with_repo, users, "actor_login", USER_COLUMNS, *guard[1:]).select(
        *EVENT_COLUMNS, *REPO_COLUMNS, *USER_COLUMNS, *guard
    )


def language_distribution(enriched: DataFrame) -> DataFrame:
    """Activity per language; means weigh a repository by its events.

    Events are first counted per repository and contributor, so the two
    distinct counts work on pairs instead of events.
    """
    pairs = enriched.groupBy("repo_name", "actor_login", *REPO_COLUMNS).agg(F.count(F.lit(1)).alias("n"))

    def mean(column: str) -> Column:
        known = F.when(F.col(column).isNotNull(), F.col("n"))
        return F.round(F.sum(F.col(column) * F.col("n")) / F.sum(known), 2).alias(f"avg_{column}")

    return pairs.groupBy(F.coalesce("primary_language", F.lit("Unknown")).alias("primary_language")).agg(
        F.sum("n").alias("event_count"),
        F.countDistinct("repo_name").alias("repo_count"),
        F.countDistinct("actor_login").alias("distinct_contributors"),
        mean("stars"),
        mean("forks"),
        mean("open_issues"),
    )


# ---- dashboard questions ------------------------------------------------------------------------


def top_repos(velocity: DataFrame, n: int = 10) -> DataFrame:
    """Most active repositories, by name where equal."""
    totals = velocity.groupBy("repo_name").agg(F.sum("event_count").alias("event_count"))
    return totals.orderBy(F.col("event_count").desc(), "repo_name").limit(n)


def top_repos_by_contributors(stats: DataFrame, n: int = 10) -> DataFrame:
    return stats.orderBy(F.col("unique_contributors").desc(), "repo_name").limit(n)


def event_type_breakdown(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))


def most_active_contributors(events: DataFrame, n: int = 10) -> DataFrame:
    totals = events.groupBy("actor_login").agg(F.count(F.lit(1)).alias("event_count"))
    return totals.orderBy(F.col("event_count").desc(), "actor_login").limit(n)


def ingestion_health(bronze: DataFrame) -> DataFrame:
    """Rows, files and first and last read per ingestion date."""
    return bronze.groupBy("ingestion_date").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("source_file").alias("file_count"),
        F.min("_ingested_at").alias("first_ingested_at"),
        F.max("_ingested_at").alias("last_ingested_at"),
    )


def platform_summary(summary: DataFrame) -> DataFrame:
    """One row of totals over enriched events.

    Averages count each known repository and each known contributor once.
    Events are reduced to pairs of repository and contributor in one pass;
    all totals come from the pairs.
    """
    pairs = staged(
        summary.groupBy("repo_name", "actor_login", "primary_language").agg(
            F.count(F.lit(1)).alias("n"), F.max("stars").alias("stars"), F.max("followers").alias("followers")
        ),
        "pairs",
    )
    repos = pairs.groupBy("repo_name").agg(F.max("stars").alias("stars"))
    users = pairs.groupBy("actor_login").agg(F.max("followers").alias("followers"))
    events = pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_events"), F.countDistinct("primary_language").alias("languages")
    )
    repo_totals = repos.agg(F.count("repo_name").alias("repositories"), F.avg("stars").alias("avg_stars"))
    user_totals = users.agg(
        F.count("actor_login").alias("contributors"), F.avg("followers").alias("avg_followers")
    )
    parts = {name: part.select(name).scalar() for part in (repo_totals, user_totals) for name in part.columns}
    return events.withColumns(parts)


# ---- enrichment targets -------------------------------------------------------------------------


def repo_targets(events: DataFrame) -> DataFrame:
    """Distinct repositories to look up: validity, owner, name and file to land in."""
    named = keys_of(events, "repo_name")
    valid = c.is_full_name("repo_name")
    return named.select(
        "repo_name",
        valid.alias("is_valid"),
        F.when(valid, c.owner_part("repo_name")).alias("owner"),
        F.when(valid, c.repo_part("repo_name")).alias("repo"),
        F.when(
            valid,
            F.concat(c.file_key(c.owner_part("repo_name")), F.lit("__"), c.file_key(c.repo_part("repo_name")), F.lit(".json")),
        ).alias("file_name"),
    )


def user_targets(events: DataFrame) -> DataFrame:
    """Distinct contributors to look up: validity and file to land in."""
    valid = c.is_login("actor_login")
    return keys_of(events, "actor_login").select(
        "actor_login",
        valid.alias("is_valid"),
        F.when(valid, F.concat(c.file_key("actor_login"), F.lit(".json"))).alias("file_name"),
    )


def run_summary(results: DataFrame) -> DataFrame:
    """Outcomes per batch and status (processed, skipped, failed)."""
    return results.groupBy("batch_id", "status").agg(F.count(F.lit(1)).alias("entities"))
