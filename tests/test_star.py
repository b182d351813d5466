import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as q
from tidemark.operators import star
from tidemark.plans.warehouse import build_warehouse, refresh_warehouse

D = dt.date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_calendar(spark):
    days = star.dim_date(spark)
    assert days.count() == 4018
    first = days.orderBy("full_date").first()
    assert (first.date_key, first.day_of_week, first.day_name, first.is_weekend) == (20200101, 3, "Wednesday", False)
    sunday = days.filter(F.col("full_date") == D(2020, 1, 5)).first()
    assert (sunday.day_of_week, sunday.is_weekend, sunday.quarter) == (7, True, 1)
    assert q.check_constraint(days, "day_of_week between 1 and 7", "c").first().violations == 0


@pytest.fixture
def snapshots(spark):
    return spark.createDataFrame(
        [
            (1, D(2020, 1, 1), "A"), (1, D(2020, 2, 1), "A"), (1, D(2020, 3, 1), "B"), (1, D(2020, 4, 1), None),
            (1, D(2020, 5, 1), "A"), (2, D(2020, 2, 1), None), (2, D(2020, 3, 1), None),
        ],
        "customer_id long, snapshot_date date, segment string",
    )


def test_versions(snapshots):
    got = rows(star.scd2_versions(snapshots, "customer_id", ["segment"], "snapshot_date"))
    assert got == [
        (1, "A", D(2020, 1, 1), D(2020, 3, 1), False),
        (1, "A", D(2020, 5, 1), None, True),
        (1, "B", D(2020, 3, 1), D(2020, 4, 1), False),
        (1, None, D(2020, 4, 1), D(2020, 5, 1), False),
        (2, None, D(2020, 2, 1), None, True),
    ]


def test_last_snapshot_of_a_day_counts(spark):
    df = spark.createDataFrame(
        [(1, D(2020, 1, 1), "A", 1), (1, D(2020, 1, 1), "B", 2)], "k long, d date, v string, n int"
    )
    got = star.scd2_versions(df.withColumn("seq", F.col("n")), "k", ["v", "n"], "d", [F.col("n").desc()])
    assert rows(got) == [(1, "B", 2, D(2020, 1, 1), None, True)]


def test_apply_closes_opens_and_repeats_safely(spark, snapshots):
    dim = star.scd2_versions(snapshots, "customer_id", ["segment"], "snapshot_date")
    update = spark.createDataFrame([(1, "C"), (3, "N")], "customer_id long, segment string")
    once = star.scd2_apply(dim, update, "customer_id", ["segment"], D(2020, 6, 1))
    got = rows(once)
    assert (1, "A", D(2020, 5, 1), D(2020, 6, 1), False) in got
    assert (1, "C", D(2020, 6, 1), None, True) in got
    assert (2, None, D(2020, 2, 1), None, True) in got
    assert (3, "N", D(2020, 6, 1), None, True) in got
    assert rows(star.scd2_apply(once, update, "customer_id", ["segment"], D(2020, 6, 1))) == got
    assert q.partial_unique_check(once, "is_current", ["customer_id"]).count() == 0
    correction = spark.createDataFrame([(1, "D")], "customer_id long, segment string")
    fixed = rows(star.scd2_apply(once, correction, "customer_id", ["segment"], D(2020, 6, 1)))
    assert (1, "D", D(2020, 6, 1), None, True) in fixed and len(fixed) == len(got)


def test_intervals_do_not_overlap(snapshots):
    v = star.scd2_versions(snapshots, "customer_id", ["segment"], "snapshot_date")
    a, b = v.alias("a"), v.alias("b")
    clash = a.join(b, F.expr(
        "a.customer_id = b.customer_id and a.start_date < b.start_date"
        " and (a.end_date is null or b.start_date < a.end_date)"
    ))
    assert clash.count() == 0


def test_warehouse(spark, snapshots, tmp_path):
    lines = spark.createDataFrame(
        [
            (1, 1, 7, D(2020, 1, 5), 2, Decimal("1.50")), (1, 1, 8, D(2020, 3, 1), 1, Decimal("2.00")),
            (2, 2, 7, D(2020, 1, 5), 3, Decimal("1.50")), (3, 2, 7, D(2020, 2, 2), 4, Decimal("1.50")),
        ],
        "order_id long, customer_id long, product_id long, full_date date, quantity int, unit_price decimal(10,2)",
    )
    products = spark.createDataFrame(
        [(7, D(2020, 1, 1), "p7"), (8, D(2020, 1, 1), "p8")], "product_id long, snapshot_date date, product_name string"
    )
    args = (spark, str(tmp_path / "w"), lines, snapshots, products, ["segment"], ["product_name"])
    t = build_warehouse(*args)
    facts = {(r.order_id, r.product_key): r for r in t["fact_sales"].collect()}
    assert len(facts) == 4
    segments = {r.customer_key: r.segment for r in t["dim_customer"].collect()}
    assert segments[facts[(1, 1)].customer_key] == "A" and segments[facts[(1, 2)].customer_key] == "B"
    assert facts[(2, 1)].customer_key is None  # before the first version
    assert facts[(1, 1)].revenue == Decimal("3.00")
    assert t["dim_date"].count() == 57
    keys = [r.fact_key for r in t["fact_sales"].collect()]
    assert len(set(keys)) == 4
    customers = rows(star.revenue_and_orders_per_customer(t["fact_sales"], t["dim_customer"]))
    assert sorted(customers, key=str) == [(1, Decimal("5.00"), 1), (2, Decimal("6.00"), 1), (None, Decimal("4.50"), 1)]
    again = build_warehouse(*args)
    assert rows(again["fact_sales_daily"]) == rows(t["fact_sales_daily"])


MEMBERS = "product_id long, start_date date"


def test_numbers_stay_when_smaller_keys_arrive(spark):
    first = star.extend_keys(None, spark.createDataFrame([(5, D(2020, 1, 1)), (7, D(2020, 1, 1)), (5, D(2020, 1, 1))], MEMBERS), ["product_id", "start_date"], "n")
    assert rows(first) == [(5, D(2020, 1, 1), 1), (7, D(2020, 1, 1), 2)]
    more = spark.createDataFrame([(7, D(2020, 1, 1)), (1, D(2020, 1, 1)), (None, None), (5, D(2019, 1, 1)), (None, None)], MEMBERS)
    second = star.extend_keys(first, more, ["product_id", "start_date"], "n")
    assert rows(second) == sorted(rows(first) + [(1, D(2020, 1, 1), 3), (5, D(2019, 1, 1), 4), (None, None, 5)], key=str)
    assert rows(star.extend_keys(second, more, ["product_id", "start_date"], "n")) == rows(second)
    assert rows(star.extend_keys(second, more.limit(0), ["product_id", "start_date"], "n")) == rows(second)
    keyed = star.with_known_key(more.distinct(), second, ["product_id", "start_date"], "n")
    assert {r.n for r in keyed.collect()} == {2, 3, 4, 5}


def test_only_new_members_are_numbered_and_hot_maps_are_sliced(spark, small_groups):
    first = star.extend_keys(None, spark.range(20).selectExpr("id * 2 as k"), ["k"], "n")
    second = star.extend_keys(first, spark.range(40).selectExpr("id as k"), ["k"], "n")
    assert rows(second) == sorted([(2 * k, k + 1) for k in range(20)] + [(2 * k + 1, k + 21) for k in range(20)], key=str)


UPDATES = "k long, v string, w int, day date"


def plain_history(updates):
    """Versions from all updates at once."""
    out = []
    for k in {u[0] for u in updates}:
        days = {}
        for _, v, w, day in (u for u in updates if u[0] == k):
            old = days.get(day)
            better = old is None or [x if x is not None else (type(x) is int, "") for x in (v or "", -1 if w is None else w)] > [x for x in (old[0] or "", -1 if old[1] is None else old[1])]
            if better:
                days[day] = (v, w)
        versions = []
        for day in sorted(days):
            if versions and versions[-1][0] == days[day]:
                versions[-1][2].append(day)
            else:
                versions.append((days[day], day, [day]))
        for i, (value, start, delivered) in enumerate(versions):
            end = versions[i + 1][1] if i + 1 < len(versions) else None
            out.append((k, *value, start, end, end is None, delivered))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_updates_in_any_order_give_one_dimension(spark, seed):
    rng = random.Random(seed)
    updates = [
        (rng.choice([1, 2, 3, None]), rng.choice(["a", "b", None]), rng.choice([1, 2, None]), D(2020, 1, 1) + dt.timedelta(rng.randrange(12)))
        for _ in range(60)
    ]
    want = plain_history(updates)
    dimension, rest = None, list(updates)
    rng.shuffle(rest)
    for part in (rest[:25], rest[10:30], rest[30:]):
        dimension = star.scd2_merge(dimension, spark.createDataFrame(part, UPDATES), "k", ["v", "w"], "day")
        dimension = spark.createDataFrame(dimension.collect(), dimension.schema)
    assert rows(dimension) == want
    assert rows(star.scd2_merge(dimension, spark.createDataFrame([], UPDATES), "k", ["v", "w"], "day")) == want


def test_a_late_update_cuts_a_version_and_its_withdrawal_joins_it(spark):
    history = spark.createDataFrame([(1, "A", 0, D(2020, 1, 1)), (1, "A", 0, D(2020, 3, 1)), (2, "B", 0, D(2020, 1, 1))], UPDATES)
    dim = star.scd2_merge(None, history, "k", ["v", "w"], "day")
    late = star.scd2_merge(dim, spark.createDataFrame([(1, "C", 0, D(2020, 2, 1))], UPDATES), "k", ["v", "w"], "day")
    assert [(r.v, r.start_date, r.end_date) for r in late.filter("k = 1").orderBy("start_date").collect()] == [
        ("A", D(2020, 1, 1), D(2020, 2, 1)), ("C", D(2020, 2, 1), D(2020, 3, 1)), ("A", D(2020, 3, 1), None),
    ]


def test_as_of_equals_the_interval_join(spark, small_groups):
    rng = random.Random(5)
    versions = star.scd2_merge(
        None,
        spark.createDataFrame([(k, rng.choice("abc"), k, D(2020, 1, 1) + dt.timedelta(rng.randrange(300))) for k in (1, 2, 3) for _ in range(15)], UPDATES),
        "k", ["v", "w"], "day",
    )
    facts = [(n, rng.choice([1, 1, 1, 2, 3, 4, None]), rng.choice([None, *[D(2019, 12, 1) + dt.timedelta(d) for d in range(0, 400, 7)]])) for n in range(400)]
    facts = spark.createDataFrame(facts, "n int, k long, day date").repartition(3)
    for closed in (versions, versions.filter("is_current = false")):
        want = rows(star.point_in_time(facts, closed, "k", "day", ["v", "w"]).select("n", "k", "day", "v", "w"))
        merged = star.as_of(facts, closed, "k", "day", ["v", "w"])
        assert rows(merged.select("n", "k", "day", "v", "w")) == want and merged.count() == 400


def test_as_of_reads_each_side_once_without_a_join(spark):
    versions = star.scd2_merge(None, spark.createDataFrame([(1, "a", 1, D(2020, 1, 1))], UPDATES), "k", ["v", "w"], "day")
    facts = spark.createDataFrame([(1, 1, D(2020, 2, 1))], "n int, k long, day date")
    plan = star.as_of(facts, versions, "k", "day", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


LINES = "order_id long, customer_id long, product_id long, full_date date, quantity int, unit_price decimal(10,2)"


def test_inferred_members_are_filled_and_keep_their_numbers(spark, snapshots, tmp_path):
    one = Decimal("1.50")
    lines = spark.createDataFrame(
        [
            (1, 1, 7, D(2020, 1, 5), 2, one), (2, 2, 7, D(2020, 1, 5), 3, one), (3, 9, 8, D(2020, 1, 7), 4, one),
            (4, None, 7, D(2020, 2, 1), 5, one), (5, 9, None, D(2020, 2, 2), 6, one),
        ],
        LINES,
    )
    products = spark.createDataFrame([(7, D(2020, 1, 6), "p7")], "product_id long, snapshot_date date, product_name string")
    folder = str(tmp_path / "w")
    t = refresh_warehouse(spark, folder, lines, snapshots, products, ["segment"], ["product_name"])
    facts = {r.order_id: r for r in t["fact_sales"].collect()}
    assert len(facts) == 5 and all(r.customer_key is not None and r.product_key is not None for r in facts.values())
    customers = {r.customer_key: r for r in t["dim_customer"].collect()}
    assert customers[facts[4].customer_key].customer_id is None and facts[4].customer_key == star.UNKNOWN_MEMBER
    unknown = customers[facts[3].customer_key]
    assert (unknown.customer_id, unknown.segment, unknown.is_inferred, unknown.start_date) == (9, None, True, D(2020, 1, 7))
    assert customers[facts[2].customer_key].start_date == D(2020, 1, 5)  # known from February on, sold to in January
    names = {r.product_key: (r.product_id, r.product_name) for r in t["dim_product"].collect()}
    assert names[facts[1].product_key] == (7, "p7") and names[facts[3].product_key] == (8, None)

    # the missing profile arrives, and one dated before all others; nothing else is delivered again
    late = spark.createDataFrame([(9, D(2020, 6, 1), "N"), (1, D(2019, 1, 1), "Z")], snapshots.schema)
    again = refresh_warehouse(spark, folder, lines, late, products.limit(0), ["segment"], ["product_name"])
    after = {r.order_id: r for r in again["fact_sales"].collect()}
    assert {o: (r.customer_key, r.product_key) for o, r in after.items()} == {o: (r.customer_key, r.product_key) for o, r in facts.items()}
    filled = {r.customer_key: r for r in again["dim_customer"].collect()}
    assert (filled[after[3].customer_key].segment, filled[after[3].customer_key].is_inferred) == ("N", False)
    assert filled[after[1].customer_key].segment == "A"  # the version before it got a number of its own
    assert [(r.segment, r.end_date) for r in filled.values() if r.start_date == D(2019, 1, 1)] == [("Z", D(2020, 1, 1))]
    assert len({r.customer_key for r in again["dim_customer"].collect()}) == again["dim_customer"].count()

    total = sum(r.revenue for r in after.values())
    dates = star.dim_date_for(lines, "full_date")
    daily, products_now, customers_now = again["fact_sales_daily"], again["dim_product"], again["dim_customer"]
    assert sum(r.revenue for r in star.revenue_per_day_and_product(daily, dates, products_now).collect()) == total
    assert sum(r[1] for r in star.revenue_and_orders_per_customer(again["fact_sales"], customers_now).collect()) == total


def test_a_refresh_works_out_order_items_once(spark, snapshots, tmp_path):
    lines = spark.createDataFrame([(1, 1, 7, D(2020, 3, 5), 2, Decimal("1.50"))], LINES)
    products = spark.createDataFrame([(7, D(2020, 1, 6), "p7")], "product_id long, snapshot_date date, product_name string")
    worked_out = spark.sparkContext.accumulator(0)

    def counted(rows):
        for batch in rows:
            worked_out.add(batch.num_rows)
            yield batch

    t = refresh_warehouse(
        spark, str(tmp_path / "w"), lines.mapInArrow(counted, lines.schema), snapshots, products, ["segment"], ["product_name"]
    )
    assert t["fact_sales"].count() == 1 and t["fact_sales_daily"].count() == 1
    assert worked_out.value == 1


def test_a_moved_placeholder_keeps_its_number(spark):
    schema = "k long, start_date date"
    first, keys = star.member_keys(spark.createDataFrame([(9, D(2020, 1, 7)), (1, D(2020, 1, 1))], schema), None, "k", "n")
    assert rows(first) == [(1, 1, D(2020, 1, 1)), (2, 9, D(2020, 1, 7))]
    moved, keys = star.member_keys(spark.createDataFrame([(9, D(2020, 1, 3)), (9, D(2020, 6, 1)), (1, D(2020, 1, 1)), (1, D(2019, 1, 1))], schema), keys, "k", "n")
    assert rows(moved) == [(1, 1, D(2020, 1, 1)), (2, 9, D(2020, 1, 3)), (3, 1, D(2019, 1, 1)), (4, 9, D(2020, 6, 1))]
    again, _ = star.member_keys(spark.createDataFrame([(9, D(2019, 5, 5)), (9, D(2020, 6, 1)), (1, D(2019, 1, 1))], schema), keys, "k", "n")
    assert rows(again) == [(2, 9, D(2019, 5, 5)), (3, 1, D(2019, 1, 1)), (4, 9, D(2020, 6, 1))]


def test_daily_sales_from_lines_equal_those_from_facts(spark, snapshots):
    rng = random.Random(8)
    lines = [(n, rng.choice([1, 2, None]), rng.choice([7, 8, None]), D(2020, 1, 1) + dt.timedelta(rng.randrange(90)), rng.randrange(5), Decimal("1.25")) for n in range(200)]
    lines = spark.createDataFrame(lines, LINES)
    products = star.dim_product(spark.createDataFrame([(7, D(2020, 1, 6), "a"), (7, D(2020, 2, 6), "b")], "product_id long, snapshot_date date, name string"), ["name"])
    facts = star.fact_sales(lines, star.dim_customer(snapshots, ["segment"]), products)
    assert rows(star.daily_sales(lines, products)) == rows(star.fact_sales_daily(facts))


def test_orders_of_a_customer_are_grouped_once(spark):
    schema = "customer_key bigint, order_id bigint, revenue decimal(12,2)"
    # order 7 under two versions of one customer, order 9 before any version, one item without an order
    rows = [(1, 7, Decimal("1.50")), (2, 7, Decimal("2.00")), (2, 8, Decimal("3.00")), (2, 8, None), (2, None, Decimal("4.00")), (None, 9, Decimal("5.00")), (3, 7, None)]
    facts = spark.createDataFrame(rows, schema)
    customers = spark.createDataFrame([(1, 10), (2, 10), (3, 30), (4, 40)], "customer_key bigint, customer_id bigint")
    asked = star.revenue_and_orders_per_customer(facts, customers)
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, asked.collect()), key=str) == [(10, Decimal("10.50"), 2), (30, None, 1), (None, Decimal("5.00"), 1)]
    # partial and final counts per customer and order, then per customer: no other table of orders in a task
    assert plan.count("HashAggregate(keys=") == 4
