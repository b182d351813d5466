"""Queries over the star schema and integrity checks."""

from __future__ import annotations

import datetime as dt
from functools import cached_property, reduce

from pyspark.sql import functions as F

from tidemark.adapters import Tables
from tidemark.operators import quality as q
from tidemark.operators import star
from tidemark.plans.warehouse import build_warehouse, refresh_warehouse
from tidemark.registry.base import register, rounded
from tidemark.session import fresh_path, staged

CUSTOMER_TRACKED = ("country", "customer_segment")
PRODUCT_TRACKED = ("product_name", "category", "brand")


def _versions_sql(source: str, key: str, tracked: tuple[str, ...], out: str) -> str:
    before = ", ".join(f"lag({c}) over w as old_{c}" for c in tracked)
    changed = " or ".join(f"{c} is distinct from old_{c}" for c in tracked)
    columns = ", ".join(tracked)
    return f"""(
      with steps as (
        select *, {before}, row_number() over w as step from {source}
        window w as (partition by {key} order by snapshot_date)),
      kept as (select * from steps where step = 1 or {changed})
      select row_number() over (order by {key}, snapshot_date) as {out}, {key}, {columns},
             snapshot_date as start_date,
             lead(snapshot_date) over (partition by {key} order by snapshot_date) as end_date,
             lead(snapshot_date) over (partition by {key} order by snapshot_date) is null as is_current
      from kept)"""


CUSTOMERS_SQL = _versions_sql("customer_history", "customer_id", CUSTOMER_TRACKED, "customer_key")
PRODUCTS_SQL = _versions_sql("product_history", "product_id", PRODUCT_TRACKED, "product_key")
FACTS_SQL = f"""(
    select c.customer_key, p.product_key,
           cast(strftime(l.full_date, '%Y%m%d') as integer) as date_key, l.order_id, l.quantity, l.unit_price,
           cast(l.quantity * l.unit_price as decimal(12,2)) as revenue, l.full_date, l.customer_id, l.product_id
    from sale_lines l
    left join {CUSTOMERS_SQL} c on c.customer_id = l.customer_id
      and c.start_date <= l.full_date and (c.end_date is null or l.full_date < c.end_date)
    left join {PRODUCTS_SQL} p on p.product_id = l.product_id
      and p.start_date <= l.full_date and (p.end_date is null or l.full_date < p.end_date))"""
CALENDAR_SQL = """(
    select cast(strftime(d, '%Y%m%d') as integer) as date_key, cast(d as date) as full_date,
           cast(day(d) as integer) as day, cast(month(d) as integer) as month, cast(year(d) as integer) as year,
           cast(quarter(d) as integer) as quarter, cast(isodow(d) as integer) as day_of_week,
           dayname(d) as day_name, isodow(d) in (6, 7) as is_weekend
    from (select unnest(generate_series(lo, hi, interval 1 day)) as d
          from (select cast(min(order_date) as timestamp) as lo, cast(max(order_date) as timestamp) as hi
                from shop_orders)))"""


def _dim_customer(t: Tables):
    return star.dim_customer(t.customer_history, CUSTOMER_TRACKED)


def _dim_product(t: Tables):
    return star.dim_product(t.product_history, PRODUCT_TRACKED)


class Star:
    """Dimensions read back from files, so that joins know their sizes, and the facts over them."""

    def __init__(self, t: Tables):
        self._t = t

    @cached_property
    def dates(self):
        return staged(star.dim_date_for(self._t.shop_orders, "order_date"), "dim-date")

    @cached_property
    def customers(self):
        return staged(_dim_customer(self._t), "dim-customer")

    @cached_property
    def products(self):
        return staged(_dim_product(self._t), "dim-product")

    @cached_property
    def facts(self):
        return star.fact_sales(self._t.sale_lines, self.customers, self.products)

    @cached_property
    def daily(self):
        return star.daily_sales(self._t.sale_lines, self.products)


register("i01_dim_date", lambda t: star.dim_date_for(t.shop_orders, "order_date"), f"select * from {CALENDAR_SQL} d")
register("i02_dim_product", _dim_product, f"select * from {PRODUCTS_SQL} d")
register("i03_dim_customer", _dim_customer, f"select * from {CUSTOMERS_SQL} d")
register(
    "i04_surrogate_key",
    lambda t: star.with_surrogate_key(
        star.scd2_versions(t.product_history, "product_id", ["category"], "snapshot_date"), "product_key", "product_id"
    ).select("product_key", "product_id", "start_date"),
    f"""select product_key, product_id, start_date
        from {_versions_sql('product_history', 'product_id', ('category',), 'product_key')} d""",
)


def _key_map(t):
    """Numbers after two builds: odd products first, then all of them."""
    versions = star.scd2_versions(t.product_history, "product_id", PRODUCT_TRACKED, "snapshot_date")
    identity, out = ["product_id", "start_date"], "product_key"
    first = staged(star.extend_keys(None, versions.filter("product_id % 2 = 1"), identity, out), "keys")
    keys = star.extend_keys(first, versions, identity, out)
    return star.with_known_key(versions, keys, identity, out).select(out, *identity, "category")


register(
    "i04_key_map",
    _key_map,
    f"""select row_number() over (order by product_id % 2 = 0, product_id, start_date) as product_key,
               product_id, start_date, category from {PRODUCTS_SQL} d""",
)


def _applied(t):
    history = t.customer_history
    last = dt.date(1999, 1, 1)
    before = star.scd2_versions(
        history.filter(F.col("snapshot_date") < last), "customer_id", CUSTOMER_TRACKED, "snapshot_date"
    )
    update = history.filter(F.col("snapshot_date") == last).select("customer_id", *CUSTOMER_TRACKED)
    return star.scd2_apply(before, update, "customer_id", CUSTOMER_TRACKED, last)


register(
    "i05_scd2_apply",
    _applied,
    f"select customer_id, country, customer_segment, start_date, end_date, is_current from {CUSTOMERS_SQL} d",
)


def _merged_late(t):
    """The customer dimension after three deliveries, each with days from all over the history, one of them twice."""
    history = t.customer_history
    part = F.pmod(F.col("customer_id") + F.month("snapshot_date") + F.year("snapshot_date"), F.lit(3))
    dimension = None
    for k in (2, 0, 0, 1):
        update = history.filter(part == k)
        dimension = staged(star.scd2_merge(dimension, update, "customer_id", CUSTOMER_TRACKED, "snapshot_date"), "merged")
    return dimension.withColumn("days", F.size("delivered_on")).drop("delivered_on")


register(
    "i05_late_updates",
    _merged_late,
    f"""select d.customer_id, d.country, d.customer_segment, d.start_date, d.end_date, d.is_current,
               cast(count(*) as integer) as days
        from {CUSTOMERS_SQL} d join customer_history h on h.customer_id = d.customer_id
          and h.snapshot_date >= d.start_date and (d.end_date is null or h.snapshot_date < d.end_date)
        group by all""",
)
register(
    "i06_as_of_merge",
    lambda t: star.as_of(
        t.sale_lines.select("order_id", "customer_id", "full_date", "quantity"),
        Star(t).customers,
        "customer_id",
        "full_date",
        ["customer_key", "customer_segment"],
    ),
    f"""select l.order_id, l.customer_id, l.full_date, l.quantity, c.customer_key, c.customer_segment
        from sale_lines l left join {CUSTOMERS_SQL} c on c.customer_id = l.customer_id
          and l.full_date >= c.start_date and l.full_date < coalesce(c.end_date, date '9999-12-31')""",
)
register(
    "i06_point_in_time",
    lambda t: star.point_in_time(
        t.sale_lines.select("order_id", "customer_id", "full_date", "quantity"),
        Star(t).customers,
        "customer_id",
        "full_date",
        ["customer_key", "customer_segment"],
    ),
    f"""select l.order_id, l.customer_id, l.full_date, l.quantity, c.customer_key, c.customer_segment
        from sale_lines l left join {CUSTOMERS_SQL} c on c.customer_id = l.customer_id
          and l.full_date >= c.start_date and l.full_date < coalesce(c.end_date, date '9999-12-31')""",
)
register(
    "i07_fact_sales",
    lambda t: Star(t).facts,
    f"select customer_key, product_key, date_key, order_id, quantity, unit_price, revenue from {FACTS_SQL} f",
)


def _inferred(t):
    """Revenue by customer version, where a fifth of the customers and all days before 1997 lack snapshots."""
    known = t.customer_history.filter("customer_id % 5 <> 0 and snapshot_date >= date'1997-01-01'")
    tables = refresh_warehouse(
        t.spark, fresh_path(t.spark, "refreshed"), t.sale_lines, known, t.product_history, CUSTOMER_TRACKED, PRODUCT_TRACKED
    )
    totals = tables["fact_sales"].groupBy("customer_key").agg(
        F.sum("revenue").cast("decimal(18,2)").alias("revenue"), F.count(F.lit(1)).alias("items")
    )
    named = totals.join(tables["dim_customer"], "customer_key")
    return named.groupBy("customer_id", "customer_segment", "is_inferred").agg(
        F.sum("revenue").cast("decimal(18,2)").alias("revenue"), F.sum("items").alias("items")
    )


register(
    "i07_inferred_members",
    _inferred,
    f"""with h as (select * from customer_history where customer_id % 5 <> 0 and snapshot_date >= date '1997-01-01'),
             v as {_versions_sql('h', 'customer_id', CUSTOMER_TRACKED, 'customer_key')},
             f as (select *, row_number() over (partition by customer_id order by start_date) as no from v)
        select l.customer_id, f.customer_segment, f.customer_id is null as is_inferred,
               cast(sum(cast(l.quantity * l.unit_price as decimal(12,2))) as decimal(18,2)) as revenue, count(*) as items
        from sale_lines l left join f on f.customer_id = l.customer_id
          and (f.no = 1 or f.start_date <= l.full_date) and (f.end_date is null or l.full_date < f.end_date)
        group by 1, 2, 3""",
)
register(
    "i08_fact_sales_daily",
    lambda t: Star(t).daily,
    f"""select date_key, product_key, cast(sum(quantity) as bigint) as total_quantity,
               cast(sum(revenue) as decimal(18,2)) as total_revenue
        from {FACTS_SQL} f group by 1, 2""",
)


def _rebuilt(t):
    tables = build_warehouse(
        t.spark,
        fresh_path(t.spark, "warehouse"),
        t.sale_lines,
        t.customer_history,
        t.product_history,
        CUSTOMER_TRACKED,
        PRODUCT_TRACKED,
    )
    totals = {
        "dim_date": "date_key",
        "dim_customer": "customer_key * customer_id",
        "dim_product": "product_key * product_id",
        "fact_sales": "quantity * (customer_key + product_key)",
        "fact_sales_daily": "total_quantity * product_key",
    }
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows"), F.expr(f"cast(sum({totals[name]}) as bigint)").alias("total"))
        .select(F.lit(name).alias("table_name"), "rows", "total")
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


register(
    "i09_refresh_order",
    _rebuilt,
    f"""with f as {FACTS_SQL}
        select 'dim_date' as table_name, count(*) as rows, cast(sum(date_key) as bigint) as total from {CALENDAR_SQL} d
        union all select 'dim_customer', count(*), cast(sum(customer_key * customer_id) as bigint) from {CUSTOMERS_SQL} d
        union all select 'dim_product', count(*), cast(sum(product_key * product_id) as bigint) from {PRODUCTS_SQL} d
        union all select 'fact_sales', count(*), cast(sum(quantity * (customer_key + product_key)) as bigint) from f
        union all select 'fact_sales_daily', count(*), cast(sum(total * product_key) as bigint)
                  from (select product_key, sum(quantity) as total from f group by date_key, product_key)""",
)


def _question(build):
    def run(t):
        s = Star(t)
        return build(s)

    return run


register(
    "i10_revenue_per_day_product",
    _question(lambda s: star.revenue_per_day_and_product(s.daily, s.dates, s.products)),
    f"""select f.full_date, f.product_id, p.p_name as product_name, cast(sum(f.revenue) as decimal(18,2)) as revenue
        from {FACTS_SQL} f join part p on p.p_partkey = f.product_id group by all""",
)
register(
    "i11_revenue_orders_per_customer",
    _question(lambda s: star.revenue_and_orders_per_customer(s.facts, s.customers)),
    f"""select customer_id, cast(sum(revenue) as decimal(18,2)) as revenue, count(distinct order_id) as orders
        from {FACTS_SQL} f group by 1""",
)
register(
    "i12_top_products_over_time",
    _question(lambda s: star.top_products_per_month(s.daily, s.dates, s.products, 5)),
    f"""with sold as (
          select cast(year(full_date) as integer) as year, cast(month(full_date) as integer) as month, product_id,
                 cast(sum(quantity) as bigint) as quantity, cast(sum(revenue) as decimal(18,2)) as revenue
          from {FACTS_SQL} f group by 1, 2, 3)
        select *, rank() over (partition by year, month order by quantity desc) as product_rank
        from sold qualify product_rank <= 5""",
)
register(
    "i13_aov_over_time",
    _question(lambda s: rounded(star.order_value_per_month(s.facts, s.dates), 6, "avg_order_value")),
    f"""select cast(year(full_date) as integer) as year, cast(month(full_date) as integer) as month,
               cast(sum(revenue) as decimal(18,2)) as revenue, count(distinct order_id) as orders,
               round(cast(sum(revenue) as double) / count(distinct order_id), 6) as avg_order_value
        from {FACTS_SQL} f group by 1, 2""",
)

# ---- integrity ----------------------------------------------------------------------------------

register(
    "k04_duplicate_keys",
    lambda t: q.duplicate_keys(t.titles, ["show_id"]),
    "select show_id, count(*) as occurrences from titles group by 1 having count(*) > 1",
)
register(
    "k05_unique_vs_total",
    lambda t: q.unique_vs_total(t.titles, "show_id"),
    "select count(*) as total_rows, count(distinct show_id) as unique_keys from titles",
)

PRIMARY_KEYS = {
    "shop_categories": ["category_id"],
    "shop_customers": ["customer_id"],
    "shop_employees": ["employee_id"],
    "shop_staff_territories": ["employee_id", "territory_id"],
    "shop_lines": ["order_id", "product_id"],
    "shop_orders": ["order_id"],
    "shop_products": ["product_id"],
    "shop_regions": ["region_id"],
    "shop_shippers": ["shipper_id"],
    "shop_suppliers": ["supplier_id"],
    "shop_territories": ["territory_id"],
}
FOREIGN_KEYS = [
    ("shop_orders", "customer_id", "shop_customers", "customer_id"),
    ("shop_orders", "employee_id", "shop_employees", "employee_id"),
    ("shop_orders", "ship_via", "shop_shippers", "shipper_id"),
    ("shop_lines", "product_id", "shop_products", "product_id"),
    ("shop_lines", "order_id", "shop_orders", "order_id"),
    ("shop_products", "category_id", "shop_categories", "category_id"),
    ("shop_products", "supplier_id", "shop_suppliers", "supplier_id"),
    ("shop_territories", "region_id", "shop_regions", "region_id"),
    ("shop_staff_territories", "territory_id", "shop_territories", "territory_id"),
    ("shop_staff_territories", "employee_id", "shop_employees", "employee_id"),
    ("shop_employees", "reports_to", "shop_employees", "employee_id"),
]


def _primary_keys(t):
    checks = [q.primary_key_check(getattr(t, name), keys, name) for name, keys in PRIMARY_KEYS.items()]
    return reduce(lambda a, b: a.unionByName(b), checks)


def _foreign_keys(t):
    constraints = [q.ForeignKey(*entry) for entry in FOREIGN_KEYS]
    return q.foreign_keys_check({name: getattr(t, name) for c in constraints for name in (c.child, c.parent)}, constraints)


register(
    "k08_primary_key_check",
    _primary_keys,
    " union all ".join(
        f"""select '{name}' as table_name,
                   (select count(*) from {name} where {' or '.join(k + ' is null' for k in keys)}) as null_keys,
                   (select count(*) from (select {', '.join(keys)} from {name} group by all having count(*) > 1))
                     as duplicate_keys"""
        for name, keys in PRIMARY_KEYS.items()
    ),
)
register(
    "k09_foreign_key_check",
    _foreign_keys,
    " union all ".join(
        f"""select '{child}.{column}' as constraint_name, count(*) as orphan_rows,
                   count(distinct x.{column}) as orphan_keys
            from {child} x where x.{column} is not null
              and not exists (from {parent} y where y.{key} = x.{column})"""
        for child, column, parent, key in FOREIGN_KEYS
    ),
)
register(
    "k10_partial_unique_check",
    lambda t: q.partial_unique_check(_dim_customer(t), "is_current", ["customer_id"]),
    f"""select customer_id, count(*) as occurrences from {CUSTOMERS_SQL} d where is_current
        group by 1 having count(*) > 1""",
)
register(
    "k10_partial_unique_broken",
    lambda t: q.partial_unique_check(t.customer_history, "snapshot_date >= date'1997-01-01'", ["customer_id"]),
    """select customer_id, count(*) as occurrences from customer_history where snapshot_date >= date '1997-01-01'
       group by 1 having count(*) > 1""",
)
register(
    "k11_check_constraint",
    lambda t: q.check_constraint(
        star.dim_date_for(t.shop_orders, "order_date"), "day_of_week between 1 and 7", "day_of_week range"
    ),
    f"""select 'day_of_week range' as constraint_name, count(*) as total_rows,
               count(*) filter (where not day_of_week between 1 and 7) as violations from {CALENDAR_SQL} d""",
)
