"""Star schema: calendar, slowly changing dimensions, facts, daily sums and business questions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import columns as c
from tidemark.operators.skew import carried, latest_per_key, numbered, same, top_ranked
from tidemark.session import staged


def _calendar(days: DataFrame) -> DataFrame:
    return days.select(
        c.date_key("full_date").alias("date_key"),
        "full_date",
        F.dayofmonth("full_date").alias("day"),
        F.month("full_date").alias("month"),
        F.year("full_date").alias("year"),
        F.quarter("full_date").alias("quarter"),
        c.iso_weekday("full_date").alias("day_of_week"),
        c.day_name("full_date").alias("day_name"),
        (c.iso_weekday("full_date") >= 6).alias("is_weekend"),
    )


def dim_date(
    spark: SparkSession, start: dt.date = dt.date(2020, 1, 1), end: dt.date = dt.date(2030, 12, 31)
) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    span = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return _calendar(spark.range(1).select(F.explode(span).alias("full_date")))


def dim_date_for(df: DataFrame, column: str) -> DataFrame:
    """One row per day from the first to the last date of a table, gaps included."""
    bounds = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).filter(F.col("lo").isNotNull())
    return _calendar(
        bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("full_date"))
    )


def scd2_versions(
    snapshots: DataFrame,
    key: str,
    tracked: Sequence[str],
    date_column: str,
    same_day_order: Sequence[Column] = (),
) -> DataFrame:
    """Row versions from dated snapshots: half-open intervals, the last one open.

    Of several snapshots of a key on one day the last by ``same_day_order``
    counts. That leaves at most one row per key and day, so the window per
    key is short however often a key was delivered.
    """
    order = list(same_day_order) or [F.col(name).desc_nulls_last() for name in tracked]
    daily = latest_per_key(snapshots.select(key, date_column, *tracked), [key, date_column], order)
    w = Window.partitionBy(key).orderBy(date_column)
    now = F.struct(*tracked)
    changed = (
        daily.withColumn("_before", F.lag(now).over(w))
        .withColumn("_first", F.row_number().over(w) == 1)
        .filter(F.col("_first") | ~F.col("_before").eqNullSafe(now))
    )
    return (
        changed.withColumn("end_date", F.lead(date_column).over(w))
        .withColumnRenamed(date_column, "start_date")
        .withColumn("is_current", F.col("end_date").isNull())
        .select(key, *tracked, "start_date", "end_date", "is_current")
    )


def with_surrogate_key(dimension: DataFrame, out: str, key: str) -> DataFrame:
    """Number the versions by key and start date: the same numbers on every build."""
    order = [F.col(key).asc_nulls_last(), F.col("start_date").asc_nulls_last()]
    return numbered(dimension, [], order, out).withColumn(out, F.col(out).cast("bigint"))


def extend_keys(known: DataFrame | None, members: DataFrame, identity: Sequence[str], out: str) -> DataFrame:
    """Numbers of all members ever seen: those in ``known`` stay, new ones get the next numbers in the order of ``identity``.

    ``known`` has the columns of ``identity`` and ``out``. Only new members are sorted and numbered. Nulls in
    ``identity`` are equal to each other.
    """
    fresh = members.select(*identity).distinct()
    if known is None:
        base = 0
    else:
        renamed = known.select(*[F.col(c).alias(f"_known_{c}") for c in identity])
        fresh = fresh.join(renamed, same(fresh, renamed, [(c, f"_known_{c}") for c in identity]), "left_anti")
        base = known.agg(F.max(out)).first()[0] or 0
    fresh = numbered(staged(fresh, "new-members"), [], [F.col(c).asc_nulls_last() for c in identity], out)
    fresh = fresh.withColumn(out, (F.col(out) + base).cast("bigint"))
    return fresh if known is None else known.select(*identity, out).unionByName(fresh)


def with_known_key(dimension: DataFrame, keys: DataFrame, identity: Sequence[str], out: str) -> DataFrame:
    """Dimension rows with their numbers from the key map."""
    renamed = keys.select(*[F.col(c).alias(f"_known_{c}") for c in identity], out)
    joined = dimension.join(renamed, same(dimension, renamed, [(c, f"_known_{c}") for c in identity]), "left")
    return joined.select(out, *dimension.columns)


def scd2_merge(
    dimension: DataFrame | None, updates: DataFrame, key: str, tracked: Sequence[str], date_column: str
) -> DataFrame:
    """Dimension after dated updates, however late or often they come.

    A version knows the days on which it was delivered (``delivered_on``), so an update dated inside it cuts it there,
    and equal neighbours become one version again without losing a day. Updates in any order and any repetition give
    the dimension that all of them give at once. Of several updates of a key on one day the one with the greater values
    counts. Only keys with updates are worked out anew. At most one row per key and day enters a window.
    """
    columns = [key, *tracked, "start_date", "end_date", "is_current", "delivered_on"]
    days = updates.select(key, *tracked, F.col(date_column).cast("date").alias("_day"))
    untouched = None
    if dimension is not None:
        keys = updates.select(F.col(key).alias("_touched")).distinct()
        touched = F.col(key).eqNullSafe(F.col("_touched"))
        untouched = dimension.join(keys, touched, "left_anti").select(*columns)
        again = dimension.join(keys, touched, "left_semi")
        days = days.unionByName(again.select(key, *tracked, F.explode("delivered_on").alias("_day")))
    daily = latest_per_key(days, [key, "_day"], [F.col(name).desc_nulls_last() for name in tracked])
    w = Window.partitionBy(key).orderBy("_day")
    now = F.struct(*tracked)
    begins = (F.row_number().over(w) == 1) | ~F.lag(now).over(w).eqNullSafe(now)
    runs = daily.withColumn("_begins", begins.cast("int")).withColumn("_run", F.sum("_begins").over(w))
    versions = runs.groupBy(key, "_run").agg(
        *[F.first(name).alias(name) for name in tracked],
        F.min("_day").alias("start_date"),
        F.array_sort(F.collect_list("_day")).alias("delivered_on"),
    )
    end = F.lead("start_date").over(Window.partitionBy(key).orderBy("start_date"))
    versions = versions.withColumn("end_date", end).withColumn("is_current", F.col("end_date").isNull()).select(*columns)
    return versions if untouched is None else untouched.unionByName(versions)


def as_of(facts: DataFrame, dimension: DataFrame, key: str, date_column: str, take: Sequence[str]) -> DataFrame:
    """Each fact with the dimension version valid on its date, by one sort of facts and versions together.

    The last version at or before a fact is carried to it, over slices where a key is hot; a fact never meets more than
    one version. For a key's versions that do not overlap this gives what ``point_in_time`` gives. Null keys and dates
    have no version.
    """
    known = dimension.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"),
        F.col("start_date").alias("_day"),
        F.lit(0).alias("_kind"),
        F.struct(F.col("end_date").alias("_end"), *take).alias("_version"),
        F.lit(None).cast(facts.select(F.struct("*")).schema[0].dataType).alias("_fact"),
    )
    asked = facts.select(
        F.col(key).alias("_key"),
        F.col(date_column).cast("date").alias("_day"),
        F.lit(1).alias("_kind"),
        F.lit(None).cast(known.schema["_version"].dataType).alias("_version"),
        F.struct("*").alias("_fact"),
    )
    order = [F.col("_day").asc_nulls_first(), F.col("_kind").asc()]
    both = carried(known.unionByName(asked), ["_key"], order, "_version", "_valid")
    open_on_day = F.col("_valid._end").isNull() | (F.col("_day") < F.col("_valid._end"))
    return both.where("_kind = 1").select(
        "_fact.*", *[F.when(open_on_day & F.col("_day").isNotNull(), F.col(f"_valid.{name}")).alias(name) for name in take]
    )


def with_inferred_members(
    versions: DataFrame, facts: DataFrame, key: str, tracked: Sequence[str], date_column: str
) -> DataFrame:
    """Versions that cover every fact with a key, with ``is_inferred``.

    A member that facts name before any snapshot does gets a version without values from its first fact on. A member
    known only from later on has its first version begin at its first fact. So a snapshot that comes later fills the
    placeholder: the same version then has values (see ``member_keys`` for its number).
    """
    earliest = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(date_column).cast("date").alias("_fact_day"))
    first = versions.groupBy(key).agg(F.min("start_date").alias("_first_day"))
    early = staged(
        earliest.join(first, key, "left").where(F.col("_first_day").isNull() | (F.col("_fact_day") < F.col("_first_day"))),
        "early-facts",
    )
    columns = [key, *tracked, "start_date", "end_date", "is_current", "is_inferred"]
    begins = F.when(F.col("start_date") == F.col("_first_day"), F.col("_fact_day")).otherwise(F.col("start_date"))
    known = versions.join(early, key, "left").withColumn("start_date", begins).withColumn("is_inferred", F.lit(False))
    kinds = {name: versions.schema[name].dataType for name in tracked}
    unknown = early.where("_first_day is null").select(
        key,
        *[F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()],
        F.col("_fact_day").alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.lit(True).alias("is_current"),
        F.lit(True).alias("is_inferred"),
    )
    return known.select(*columns).unionByName(unknown.select(*columns))


def member_keys(versions: DataFrame, known: DataFrame | None, key: str, out: str) -> tuple[DataFrame, DataFrame]:
    """Versions with their numbers, and the key map after this build.

    A version is known by its member and start. A placeholder's start may move, to an earlier fact or to the snapshot
    that fills it: where a member's first number belongs to no version any more, its first version takes it over. So
    what facts refer to stays, and only versions that are new get new numbers.
    """
    identity = [key, "start_date"]

    def without(df: DataFrame, other: DataFrame) -> DataFrame:
        renamed = other.select(*[F.col(name).alias(f"_o_{name}") for name in identity])
        return df.join(renamed, same(df, renamed, [(name, f"_o_{name}") for name in identity]), "left_anti")

    if known is None:
        keys = staged(extend_keys(None, versions, identity, out), "member-keys")
        return with_known_key(versions, keys, identity, out), keys
    earliest = known.groupBy(key).agg(F.min_by(out, "start_date").alias("_number"), F.min("start_date").alias("start_date"))
    left_over = without(earliest, versions).select(F.col(key).alias("_member"), F.col("_number").alias(out))
    firsts = versions.groupBy(key).agg(F.min("start_date").alias("start_date"))
    moved = without(firsts, known)
    moved = staged(moved.join(left_over, moved[key].eqNullSafe(left_over["_member"])).select(*identity, out), "moved-members")
    keys = staged(extend_keys(known, without(versions, moved), identity, out), "member-keys")
    return with_known_key(versions, keys.unionByName(moved), identity, out), keys


def dim_customer(snapshots: DataFrame, tracked: Sequence[str], date_column: str = "snapshot_date") -> DataFrame:
    versions = scd2_versions(snapshots, "customer_id", tracked, date_column)
    return with_surrogate_key(staged(versions, "versions"), "customer_key", "customer_id")


def dim_product(snapshots: DataFrame, tracked: Sequence[str], date_column: str = "snapshot_date") -> DataFrame:
    versions = scd2_versions(snapshots, "product_id", tracked, date_column)
    return with_surrogate_key(staged(versions, "versions"), "product_key", "product_id")


def scd2_apply(
    dimension: DataFrame, update: DataFrame, key: str, tracked: Sequence[str], as_of: dt.date
) -> DataFrame:
    """Dimension after an update valid from ``as_of``.

    A changed key closes its open version and opens a new one, a new key
    opens its first, all else stays. ``update`` holds one row per key; keys
    it lacks stay open. Applying the same update again changes nothing.
    """
    columns = [key, *tracked, "start_date", "end_date", "is_current"]
    closed = dimension.filter(~F.col("is_current")).select(*columns)
    old = dimension.filter("is_current").select(
        F.col(key).alias("_key"), F.struct(*tracked).alias("_old"), F.col("start_date").alias("_start")
    )
    new = update.select(key, F.struct(*tracked).alias("_new"))
    both = old.join(new, old["_key"] == new[key], "full")
    had, has = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    keep = had & (~has | F.col("_old").eqNullSafe(F.col("_new")))
    replace = had & has & ~F.col("_old").eqNullSafe(F.col("_new"))

    def version(values: str, start: Column, end: Column) -> Column:
        return F.struct(
            F.coalesce(F.col("_key"), F.col(key)).alias(key),
            *[F.col(f"{values}.{name}").alias(name) for name in tracked],
            start.alias("start_date"),
            end.alias("end_date"),
            end.isNull().alias("is_current"),
        )

    day, open_end = F.lit(as_of), F.lit(None).cast("date")
    versions = F.array(
        F.when(keep, version("_old", F.col("_start"), open_end)),
        # a version that would start and end on one day was never valid
        F.when(replace & (F.col("_start") < day), version("_old", F.col("_start"), day)),
        F.when(has & ~keep, version("_new", day, open_end)),
    )
    current = both.select(F.inline(F.filter(versions, lambda v: v.isNotNull()))).select(*columns)
    return closed.unionByName(current)


def point_in_time(facts: DataFrame, dimension: DataFrame, key: str, date_column: str, take: Sequence[str]) -> DataFrame:
    """Each fact with the dimension version valid on its date; null where none was."""
    valid = dimension.select(F.col(key).alias("_k"), F.col("start_date").alias("_s"), F.col("end_date").alias("_e"), *take)
    during = (F.col("_s") <= F.col(date_column)) & (F.col("_e").isNull() | (F.col(date_column) < F.col("_e")))
    return facts.join(valid, (facts[key] == F.col("_k")) & during, "left").drop("_k", "_s", "_e")


#: Number of the member that stands for a missing key in a fact.
UNKNOWN_MEMBER = 0


def with_unknown_member(dimension: DataFrame, out: str) -> DataFrame:
    """Dimension with one more row for facts that have no key, all else null."""
    rest = [F.lit(True if f.name == "is_inferred" else None).cast(f.dataType).alias(f.name) for f in dimension.schema.fields if f.name != out]
    one = dimension.sparkSession.range(1).select(F.lit(UNKNOWN_MEMBER).cast("bigint").alias(out), *rest)
    return dimension.unionByName(one)


def fact_sales(sale_lines: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order item with the keys of the versions valid on the order date."""
    keyed = point_in_time(sale_lines, customers, "customer_id", "full_date", ["customer_key"])
    keyed = point_in_time(keyed, products, "product_id", "full_date", ["product_key"])
    return keyed.select(
        "customer_key",
        "product_key",
        c.date_key("full_date").alias("date_key"),
        "order_id",
        "quantity",
        "unit_price",
        (F.col("quantity") * F.col("unit_price")).cast("decimal(12,2)").alias("revenue"),
    )


def with_fact_key(facts: DataFrame, out: str = "fact_key") -> DataFrame:
    """Unique number per fact row, without a shuffle.

    Nothing refers to it, so it need not repeat between builds. Use it as
    the last step of a write: a shuffle after it could mix the numbers of
    two attempts of one task.
    """
    return facts.select(F.monotonically_increasing_id().alias(out), "*")


def daily_sales(sale_lines: DataFrame, products: DataFrame) -> DataFrame:
    """What ``fact_sales_daily`` gives, straight from order items: summed per product and day before the lookup."""
    revenue = (F.col("quantity") * F.col("unit_price")).cast("decimal(12,2)")
    sums = sale_lines.groupBy("product_id", "full_date").agg(F.sum("quantity").alias("quantity"), F.sum(revenue).alias("revenue"))
    keyed = point_in_time(sums, products, "product_id", "full_date", ["product_key"])
    return fact_sales_daily(keyed.select(c.date_key("full_date").alias("date_key"), "product_key", "quantity", "revenue"))


def fact_sales_daily(facts: DataFrame) -> DataFrame:
    return facts.groupBy("date_key", "product_key").agg(
        F.sum("quantity").alias("total_quantity"), F.sum("revenue").cast("decimal(18,2)").alias("total_revenue")
    )


def revenue_per_day_and_product(daily: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue by day and product, all versions of a product together.

    Sales before a product's first version are kept, under a null product.
    """
    return (
        daily.join(products.select("product_key", "product_id", "product_name"), "product_key", "left")
        .join(dates.select("date_key", "full_date"), "date_key")
        .groupBy("full_date", "product_id", "product_name")
        .agg(F.sum("total_revenue").cast("decimal(18,2)").alias("revenue"))
    )


def revenue_and_orders_per_customer(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue and distinct orders per customer, all versions of a customer together.

    Sales before a customer's first version are kept, under a null customer.
    """
    named = facts.select("customer_key", "order_id", "revenue").join(customers.select("customer_key", "customer_id"), "customer_key", "left")
    per_order = named.groupBy("customer_id", "order_id").agg(F.sum("revenue").alias("revenue"))
    return per_order.groupBy("customer_id").agg(
        F.sum("revenue").cast("decimal(18,2)").alias("revenue"), F.count("order_id").alias("orders")
    )


def top_products_per_month(daily: DataFrame, dates: DataFrame, products: DataFrame, top: int) -> DataFrame:
    """The best products of each month by quantity, with revenue; ties stay, sales without a product version count as
    one product."""
    sold = (
        daily.join(products.select("product_key", "product_id"), "product_key", "left")
        .join(dates.select("date_key", "year", "month"), "date_key")
        .groupBy("year", "month", "product_id")
        .agg(
            F.sum("total_quantity").alias("quantity"),
            F.sum("total_revenue").cast("decimal(18,2)").alias("revenue"),
        )
    )
    return top_ranked(sold, ["year", "month"], "quantity", top, "product_rank")


def order_value_per_month(facts: DataFrame, dates: DataFrame) -> DataFrame:
    """Revenue, distinct orders and mean order value by month.

    Facts are reduced to one row per day and order before orders are counted.
    """
    per_order = facts.groupBy("date_key", "order_id").agg(F.sum("revenue").alias("revenue"))
    return (
        per_order.join(dates.select("date_key", "year", "month"), "date_key")
        .groupBy("year", "month")
        .agg(
            F.sum("revenue").cast("decimal(18,2)").alias("revenue"),
            F.countDistinct("order_id").alias("orders"),
        )
        .withColumn("avg_order_value", F.col("revenue").cast("double") / F.col("orders"))
    )
