"""Queries over files, tables, snapshots and catalogue cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.adapters import Tables
from tidemark.functions import columns as c
from tidemark.operators import cleaning as cl
from tidemark.registry.base import register, rounded
from tidemark.session import fresh_path
from tidemark.sources import files, tables
from tidemark.sources.snapshots import SnapshotTable

TIPS_COLUMNS = "day, time, size, order_key, part_key, supp_key"


def _place(t: Tables, label: str) -> str:
    return fresh_path(t.spark, label)


# ---- files --------------------------------------------------------------------------------------


def _load_csv(t):
    path = _place(t, "titles")
    files.write_csv(t.titles, path)
    return files.load_data(t.spark, path, t.titles.schema)


def _infer_csv(t):
    path = _place(t, "tips-csv")
    files.write_csv(t.tips, path)
    return files.read_csv(t.spark, path).groupBy("day").agg(
        F.count(F.lit(1)).alias("transactions"), F.round(F.avg("total_bill"), 4).alias("avg_bill")
    )


def _json(t):
    path = _place(t, "tips-json")
    files.write_json(t.tips, path)
    return rounded(files.read_json(t.spark, path), 6, "total_bill", "tip")


def _parquet(t):
    path = _place(t, "tips-parquet")
    files.write_parquet(t.tips, path)
    return files.read_parquet(t.spark, path)


_ALL_TIPS = "select total_bill, tip, day, time, cast(size as bigint) as size, order_key, part_key, supp_key from tips"

register("a02_load_data", _load_csv, "select * from titles")
register(
    "a03_read_csv_infer",
    _infer_csv,
    "select day, count(*) as transactions, round(avg(total_bill), 4) as avg_bill from tips group by day",
)
register(
    "a04_read_json",
    _json,
    f"select round(total_bill, 6) as total_bill, round(tip, 6) as tip, {TIPS_COLUMNS} from tips",
)
register("a05_read_parquet", _parquet, "select * from tips")


def _write_csv(t):
    path = _place(t, "genres-csv")
    frame = cl.genres(t.titles.select("seq", "listed_in"))
    files.write_csv(frame, path)
    return files.read_csv(t.spark, path, files.flat_for_csv(frame).schema)


register(
    "a06_write_csv",
    _write_csv,
    """select seq, trim(listed_in) as listed_in,
              concat('["', trim(split_part(listed_in, ',', 1)), '","', trim(split_part(listed_in, ',', 2)), '"]') as genres
       from titles""".replace("trim(listed_in) as listed_in", "listed_in"),
)
register("a07_write_parquet", lambda t: _write_read(t, "parquet"), "select * from shop_products")
register("a08_write_json", lambda t: _write_read(t, "json"), "select * from shop_products")


def _write_read(t, kind):
    path = _place(t, f"products-{kind}")
    if kind == "json":
        files.write_json(t.shop_products, path)
        return files.read_json(t.spark, path, t.shop_products.schema)
    files.write_parquet(t.shop_products, path)
    files.write_parquet(t.shop_products, path)
    return files.read_parquet(t.spark, path)


def _save_data(t):
    paths = files.save_data(t.shop_orders, _place(t, "saved") + "/orders.csv")
    schema = t.shop_orders.schema
    read = {
        "csv": files.read_csv(t.spark, paths["csv"], schema),
        "json": files.read_json(t.spark, paths["json"], schema),
        "parquet": files.read_parquet(t.spark, paths["parquet"]),
    }
    out = None
    for kind, frame in read.items():
        one = frame.select(F.lit(kind).alias("format"), "order_id", "customer_id", "order_date", "shipped_date")
        out = one if out is None else out.unionByName(one)
    return out


register(
    "a09_save_data",
    _save_data,
    """select f.format, order_id, customer_id, order_date, shipped_date
       from shop_orders, (values ('csv'), ('json'), ('parquet')) f(format)""",
)


# ---- tables -------------------------------------------------------------------------------------


def _tips_table(t, partition_by=()):
    path = _place(t, "tips")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    tables.save_table(t.tips, name, partition_by, path)
    return name


register("a10_save_table", lambda t: t.spark.table(_tips_table(t)), "select * from tips")
register(
    "a11_write_partitioned",
    lambda t: t.spark.table(_tips_table(t, ["day"])),
    "select * from tips",
)
register(
    "a12_show_partitions",
    lambda t: tables.show_partitions(t.spark, _tips_table(t, ["day"])),
    "select distinct concat('day=', day) as partition from tips",
)
register(
    "a13_pruned_read",
    lambda t: tables.pruned_read(t.spark, _tips_table(t, ["day"]), F.col("day") == "N"),
    "select * from tips where day = 'N'",
)
register(
    "a14_table_limit",
    lambda t: tables.table_limit(t.shop_orders, 10, "order_date", "order_id"),
    "select * from shop_orders order by order_date, order_id limit 10",
)
register(
    "a15_table_detail",
    lambda t: tables.table_detail(t.spark, f"{t.sf_dir}/lineitem.parquet").select("format", "file_count", "num_rows"),
    "select 'parquet' as format, cast(1 as bigint) as file_count, count(*) as num_rows from lineitem",
)
register(
    "a16_format_compare",
    lambda t: files.format_compare(t.tips, _place(t, "formats")),
    """select f.format, count(*) as rows
       from tips, (values ('csv'), ('json'), ('parquet')) f(format) group by all""",
)
register(
    "a17_describe",
    lambda t: rounded(tables.numeric_summary(t.tips, ["total_bill", "tip", "size"]), 4, "mean", "stddev", "min", "max"),
    """with x as (
         select 'total_bill' as column_name, total_bill as v from tips
         union all select 'tip', tip from tips
         union all select 'size', cast(size as double) from tips)
       select column_name, count(v) as count, round(avg(v), 4) as mean, round(stddev_samp(v), 4) as stddev,
              round(min(v), 4) as min, round(max(v), 4) as max from x group by all""",
)
PROFILED = {"event_id": "bigint", "event_type": "string", "actor_login": "string", "repo_name": "string", "created_at_date": "date"}
register(
    "a18_schema",
    lambda t: tables.column_profile(t.feed_events.select(*PROFILED)),
    " union all ".join(
        f"select cast({i} as integer) as position, '{name}' as column_name, '{kind}' as type, count({name}) as filled from feed_events"
        for i, (name, kind) in enumerate(PROFILED.items())
    ),
)
register(
    "a18_preview",
    lambda t: tables.table_limit(t.tips, 20, "total_bill", "order_key", "part_key"),
    "select * from tips order by total_bill, order_key, part_key limit 20",
)

# ---- snapshots ----------------------------------------------------------------------------------


def _versions(t):
    table = SnapshotTable(t.spark, _place(t, "freight"))
    table.write(t.shop_orders.select("order_id", "ship_country", "freight"), "CREATE")
    table.update({"freight": F.col("freight") * 1.1})
    table.update({"freight": F.lit(0.0)}, F.col("ship_country") == "NATION_3")
    return table


register(
    "l01_snapshot_write",
    lambda t: rounded(_versions(t).read(0), 6, "freight"),
    "select order_id, ship_country, round(freight, 6) as freight from shop_orders",
)
register(
    "l02_snapshot_update",
    lambda t: rounded(_versions(t).read(), 6, "freight"),
    """select order_id, ship_country,
              case when ship_country = 'NATION_3' then 0.0 else round(freight * 1.1, 6) end as freight
       from shop_orders""",
)
register(
    "l03_snapshot_read",
    lambda t: rounded(_versions(t).read(1), 6, "freight"),
    "select order_id, ship_country, round(freight * 1.1, 6) as freight from shop_orders",
)
register(
    "l04_snapshot_history",
    lambda t: _versions(t).history().select("version", "operation", "row_count"),
    """select v.version, v.operation, count(*) as row_count from shop_orders,
         (values (cast(0 as bigint), 'CREATE'), (cast(1 as bigint), 'UPDATE'), (cast(2 as bigint), 'UPDATE'))
         v(version, operation) group by all""",
)
register(
    "l05_snapshot_diff",
    lambda t: rounded(_versions(t).diff(1, None, ["order_id"], ["freight"]), 6, "old_freight", "new_freight"),
    """select order_id, round(freight * 1.1, 6) as old_freight, cast(0.0 as double) as new_freight,
              'changed' as change
       from shop_orders where ship_country = 'NATION_3' and freight <> 0""",
)

# ---- cleaning -----------------------------------------------------------------------------------

SPACED = {"show_id": "Show ID", "title": "Title", "listed_in": "Listed In", "date_added": "Date Added"}
# the two texts a date can take in the adapter, and the strict format that reads them
DATE_SQL = "try_strptime(date_added, '%B %-d, %Y')"
NUMBER_SQL = "cast(nullif(regexp_extract(duration, '([0-9]+)', 1), '') as bigint)"
UNIT_SQL = """case lower(regexp_extract(duration, '([a-zA-Z]+)', 1))
     when 'mins' then 'min' when 'minutes' then 'min' when 'seasons' then 'season'
     else lower(regexp_extract(duration, '([a-zA-Z]+)', 1)) end"""
GENRE_SQL = "concat(trim(split_part(listed_in, ',', 1)), '|', trim(split_part(listed_in, ',', 2)))"
FIRST_SQL = "qualify row_number() over (partition by show_id order by seq) = 1"


def _ntz(df, *columns):
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in columns})


def _joined(df):
    return df.withColumn("genres", F.array_join("genres", "|"))


register(
    "h01_standardize_columns",
    lambda t: cl.standardize_columns(t.titles.withColumnsRenamed(SPACED)),
    "select * from titles",
)
register(
    "h02_strip_whitespace",
    lambda t: cl.strip_whitespace(t.titles),
    """select show_id, seq, trim(title) as title, type, director, date_added, duration,
              trim(listed_in) as listed_in from titles""",
)
register(
    "h03_handle_missing_values",
    lambda t: cl.handle_missing_values(t.titles).select("seq", "director", "type"),
    "select seq, coalesce(director, 'Unknown') as director, type from titles",
)
register(
    "h04_convert_date",
    lambda t: _ntz(cl.convert_date(t.titles.select("seq", "date_added")), "date_added"),
    f"select seq, {DATE_SQL} as date_added from titles",
)
register(
    "h05_remove_duplicates",
    lambda t: cl.remove_duplicates(t.titles, "show_id", ["seq"]),
    f"select * from titles {FIRST_SQL}",
)
register(
    "h05_duplicate_summary",
    lambda t: cl.duplicate_summary(t.titles, "show_id"),
    """select count(*) as rows_before, count(distinct show_id) as rows_kept,
              count(*) - count(distinct show_id) as rows_removed from titles""",
)
register(
    "h06_clean_data",
    lambda t: _ntz(cl.clean_data(t.titles.withColumnsRenamed(SPACED), "show_id", ["seq"]), "date_added"),
    f"""select show_id, seq, trim(title) as title, type, coalesce(director, 'Unknown') as director,
               {DATE_SQL} as date_added, duration, trim(listed_in) as listed_in
        from titles {FIRST_SQL}""",
)
register(
    "h07_extract_duration_value",
    lambda t: cl.extract_duration_value(t.titles.select("seq", "duration")),
    f"select seq, duration, {NUMBER_SQL} as duration_value from titles",
)
register(
    "h08_extract_duration_unit",
    lambda t: cl.extract_duration_unit(t.titles.select("seq", "duration")),
    "select seq, duration, lower(nullif(regexp_extract(duration, '([a-zA-Z]+)', 1), '')) as duration_unit from titles",
)
register(
    "h09_normalize_duration_unit",
    lambda t: cl.normalize_duration_unit(cl.extract_duration_unit(t.titles.select("seq", "duration"))),
    f"select seq, duration, {UNIT_SQL} as duration_unit from titles",
)
register(
    "h10_transform_duration",
    lambda t: cl.transform_duration(t.titles.select("seq", "duration")),
    f"select seq, duration, {NUMBER_SQL} as duration_value, {UNIT_SQL} as duration_unit from titles",
)
register(
    "h11_transform_genres",
    lambda t: _joined(cl.transform_genres(t.titles.select("seq", "listed_in"))),
    "select seq, listed_in, replace(listed_in, ',', '|') as genres from titles",
)
register(
    "h12_clean_genres",
    lambda t: cl.clean_genres(cl.transform_genres(t.titles.select("seq", "listed_in"))).select(
        "seq", F.posexplode("genres").alias("position", "genre")
    ),
    """select seq, cast(0 as integer) as position, trim(split_part(listed_in, ',', 1)) as genre from titles
       union all select seq, 1, trim(split_part(listed_in, ',', 2)) from titles""",
)
register(
    "h13_genres",
    lambda t: _joined(cl.genres(t.titles.select("seq", "listed_in"))),
    f"select seq, listed_in, {GENRE_SQL} as genres from titles",
)
register(
    "h14_create_is_movie",
    lambda t: cl.create_is_movie(t.titles.select("seq", "type")),
    "select seq, type, coalesce(type = 'Movie', false) as is_movie from titles",
)


def _catalogue(t):
    source = _place(t, "catalogue-in")
    files.write_csv(t.titles, source)
    raw = files.load_data(t.spark, source, t.titles.schema)
    paths = files.save_data(cl.clean_catalogue(raw, "show_id", ["seq"]), _place(t, "catalogue-out") + "/titles.csv")
    saved = cl.checked_catalogue(files.read_parquet(t.spark, paths["parquet"]))
    return _ntz(_joined(saved), "date_added")


register(
    "h15_clean_catalogue",
    _catalogue,
    f"""select show_id, seq, trim(title) as title, type, coalesce(director, 'Unknown') as director,
               {DATE_SQL} as date_added, duration, trim(listed_in) as listed_in,
               {NUMBER_SQL} as duration_value, {UNIT_SQL} as duration_unit, {GENRE_SQL} as genres,
               coalesce(type = 'Movie', false) as is_movie
        from titles {FIRST_SQL}""",
)
register(
    "h16_lower",
    lambda t: t.shop_customers.select("customer_id", F.lower("contact_name").alias("contact_name")),
    "select customer_id, lower(contact_name) as contact_name from shop_customers",
)
register(
    "h17_date_parts",
    lambda t: t.shop_orders.select(
        "order_id",
        F.dayofmonth("order_date").alias("day"),
        F.month("order_date").alias("month"),
        F.year("order_date").alias("year"),
        F.quarter("order_date").alias("quarter"),
        c.iso_weekday("order_date").alias("day_of_week"),
    ),
    """select order_id, cast(day(order_date) as integer) as day, cast(month(order_date) as integer) as month,
              cast(year(order_date) as integer) as year, cast(quarter(order_date) as integer) as quarter,
              cast(isodow(order_date) as integer) as day_of_week from shop_orders""",
)
register(
    "h18_date_format",
    lambda t: t.shop_orders.select(
        "order_id", c.date_key("order_date").alias("date_key"), c.day_name("order_date").alias("day_name")
    ),
    """select order_id, cast(strftime(order_date, '%Y%m%d') as integer) as date_key,
              dayname(order_date) as day_name from shop_orders""",
)
register(
    "h19_case_when",
    lambda t: t.shop_orders.select(
        "order_id",
        F.when(F.col("shipped_date").isNull(), "open")
        .when(F.col("shipped_date") > F.col("required_date"), "late")
        .otherwise("on time")
        .alias("state"),
    ),
    """select order_id, case when shipped_date is null then 'open' when shipped_date > required_date then 'late'
                             else 'on time' end as state from shop_orders""",
)


def iso_text(column):
    """Timestamp as ISO-8601 text with microseconds."""
    return F.concat(F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


register(
    "h20_iso_timestamp",
    lambda t: _ntz(
        t.feed_events.select("event_id", iso_text("created_at").alias("text"))
        .withColumn("at", c.iso_timestamp(F.col("text")))
        .select("event_id", "at", F.to_date("at").alias("day"), F.hour("at").alias("hour")),
        "at",
    ),
    """select event_id, created_at as at, created_at_date as day, cast(hour(created_at) as integer) as hour
       from feed_events""",
)
register(
    "h21_cast_int",
    lambda t: t.titles.select("seq", c.to_int("duration").alias("whole"), c.to_int(c.extract("duration", r"(\d+)")).alias("number")),
    f"""select seq, try_cast(duration as integer) as whole, cast({NUMBER_SQL} as integer) as number from titles""",
)
register(
    "h22_coalesce_round",
    lambda t: t.feed_repos.groupBy(F.coalesce("primary_language", F.lit("Unknown")).alias("language")).agg(
        F.round(F.avg("stars"), 2).alias("avg_stars")
    ),
    """select coalesce(primary_language, 'Unknown') as language, round(avg(stars), 2) as avg_stars
       from feed_repos group by all""",
)
register(
    "h23_struct_path",
    lambda t: t.feed_events.select(F.struct("*").alias("raw_payload")).select(
        F.col("raw_payload.event_id").alias("event_id"), F.col("raw_payload.actor_login").alias("actor_login")
    ),
    "select event_id, actor_login from feed_events",
)
register(
    "h24_split_full_name",
    lambda t: t.feed_repos.select(
        "repo_name",
        c.owner_part("repo_name").alias("owner"),
        c.repo_part("repo_name").alias("repo"),
        c.is_full_name("repo_name").alias("is_valid"),
    ),
    """select repo_name, split_part(repo_name, '/', 1) as owner, split_part(repo_name, '/', 2) as repo,
              repo_name like '%_/_%' as is_valid from feed_repos""",
)
register(
    "h25_login_pattern",
    lambda t: t.shop_customers.select(
        "customer_id",
        c.is_login("contact_name").alias("contact_ok"),
        c.is_login(F.regexp_replace("company_name", "#", "-")).alias("company_ok"),
    ),
    """select customer_id,
              regexp_matches(trim(contact_name), '^[A-Za-z0-9]([A-Za-z0-9-]{0,37}[A-Za-z0-9])?$') as contact_ok,
              regexp_matches(replace(company_name, '#', '-'),
                             '^[A-Za-z0-9]([A-Za-z0-9-]{0,37}[A-Za-z0-9])?$') as company_ok
       from shop_customers""",
)
register(
    "h26_file_key",
    lambda t: t.feed_repos.select("repo_name", F.concat(c.file_key("repo_name"), F.lit(".json")).alias("file_name")),
    "select repo_name, concat(replace(repo_name, '/', '_'), '.json') as file_name from feed_repos",
)
