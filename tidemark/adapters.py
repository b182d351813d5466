"""The driver tables seen in the shapes the operators work on.

Every adapter is one SELECT that Spark and DuckDB both accept, so the
engine and the check read exactly the same rows. Where the dialects
differ, the DuckDB text stands in ``DUCKDB_ONLY``. No adapter drops
rows: missing partners, idle members and null keys come from shifting
or blanking keys.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

ADAPTERS: dict[str, str] = {
    "shop_regions": """
        select r_regionkey as region_id, r_name as region_description from region""",
    "shop_territories": """
        select n_nationkey as territory_id, n_name as territory_description, n_regionkey as region_id
        from nation""",
    "shop_employees": """
        select s_suppkey as employee_id, s_name as last_name, concat('First ', s_name) as first_name,
               cast('1992-01-01' as date) + cast(s_suppkey % 40 * 100 as int) as hire_date,
               case when s_suppkey = 0 then null else cast(floor(s_suppkey / 3) as bigint) end as reports_to
        from supplier""",
    "shop_staff_territories": """
        select distinct s_suppkey % 60 as employee_id,
               case when s_nationkey = 7 then 8 else s_nationkey end as territory_id
        from supplier""",
    "shop_customers": """
        select c.c_custkey as customer_id, c.c_name as company_name,
               concat('Contact ', c.c_name) as contact_name, n.n_name as country,
               case when c.c_custkey % 3 = 0 then null else c.c_mktsegment end as region
        from customer c join nation n on c.c_nationkey = n.n_nationkey""",
    "shop_orders": """
        select o_orderkey as order_id,
               case when o_orderkey % 97 = 0 or o_custkey % 50 = 0 then null else o_custkey end as customer_id,
               o_orderkey % 90 as employee_id,
               cast(o_orderdate as date) as order_date,
               cast(o_orderdate as date) + 28 as required_date,
               case when o_orderstatus = 'O' then null
                    else cast(o_orderdate as date) + cast(o_orderkey % 40 as int) end as shipped_date,
               1 + o_orderkey % 5 as ship_via,
               o_totalprice / 1000 as freight,
               concat('NATION_', cast(o_orderkey % 24 as varchar(10))) as ship_country
        from orders""",
    "shop_lines": """
        select l_orderkey as order_id,
               l_partkey - case when l_partkey % 100 = 13 then 1 else 0 end as product_id,
               l_linenumber as line_no,
               l_extendedprice / l_quantity as unit_price,
               l_quantity as quantity,
               case when (l_partkey - case when l_partkey % 100 = 13 then 1 else 0 end) % 8 = 3 then 0.0
                    else l_discount * 3 end as discount
        from lineitem""",
    "shop_products": """
        select p_partkey as product_id, p_name as product_name, p_partkey % 8 as supplier_id,
               1 + p_partkey % 7 as category_id, p_retailprice as unit_price,
               p_size as units_in_stock, case when p_partkey % 10 = 0 then 1 else 0 end as discontinued
        from part""",
    "shop_categories": """
        select distinct 1 + p_partkey % 7 as category_id,
               concat('Category', cast(1 + p_partkey % 7 as varchar(10))) as category_name
        from part""",
    "shop_suppliers": """
        select s.s_suppkey as supplier_id, s.s_name as company_name, n.n_name as country
        from supplier s join nation n on s.s_nationkey = n.n_nationkey""",
    "shop_shippers": """
        select r_regionkey + 1 as shipper_id,
               concat('Shipper', cast(r_regionkey + 1 as varchar(10))) as company_name
        from region
        union all
        select max(r_regionkey) + 2 as shipper_id, 'Spare shipper' as company_name from region""",
    "shop_customer_types": """
        select distinct c_mktsegment as customer_type_id, concat('Customers in ', c_mktsegment) as customer_desc
        from customer""",
    "shop_customer_type_members": """
        select c_custkey as customer_id, c_mktsegment as customer_type_id from customer""",
    "shop_states": """
        select n.n_nationkey as state_id, n.n_name as state_name, substr(n.n_name, 1, 2) as state_abbr,
               r.r_name as state_region
        from nation n join region r on n.n_regionkey = r.r_regionkey""",
    "tips": """
        select l_extendedprice as total_bill, l_extendedprice * l_tax as tip, l_returnflag as day,
               l_linestatus as time, l_linenumber as size, l_orderkey as order_key,
               l_partkey as part_key, l_suppkey as supp_key
        from lineitem""",
    "titles": """
        select concat('s', cast(p_partkey % 150 as varchar(10))) as show_id, p_partkey as seq,
               concat('  ', p_name, ' ') as title,
               case when p_partkey % 17 = 0 then null when p_partkey % 2 = 0 then 'Movie' else 'TV Show' end as type,
               case when p_partkey % 5 = 0 then null else p_brand end as director,
               case when p_partkey % 11 = 0 then null when p_partkey % 13 = 0 then 'not a date'
                    else concat(case p_partkey % 3 when 0 then 'September' when 1 then 'May' else 'June' end, ' ',
                                cast(1 + p_partkey % 28 as varchar(10)), ', ',
                                cast(2000 + p_partkey % 20 as varchar(10))) end as date_added,
               case when p_partkey % 19 = 0 then null
                    else concat(cast(p_size as varchar(10)), ' ',
                                case p_partkey % 5 when 0 then 'min' when 1 then 'mins' when 2 then 'Season'
                                     when 3 then 'Seasons' else 'minutes' end) end as duration,
               concat(p_type, ', ', p_brand, ' ') as listed_in
        from part""",
    "feed_events": """
        select event_id, event_type, concat('user', cast(user_id as varchar(10))) as actor_login,
               concat('org', cast(cast(regexp_extract(props, '[0-9]+', 0) as int) % 10 as varchar(10)),
                      '/repo', regexp_extract(props, '[0-9]+', 0)) as repo_name,
               ts as created_at, cast(ts as date) as created_at_date
        from events""",
    "feed_repos": """
        select concat('org', cast((p_partkey + 20) % 10 as varchar(10)),
                      '/repo', cast(p_partkey + 20 as varchar(10))) as repo_name,
               p_size as stars, cast(p_partkey % 50 as int) as forks,
               case when p_type = 'ECONOMY' then null else p_type end as primary_language,
               cast(p_partkey % 7 as int) as open_issues
        from part""",
    "feed_users": """
        select concat(case when c.c_custkey % 5 = 0 then 'former' else 'user' end,
                      cast(c.c_custkey as varchar(10))) as actor_login,
               c.c_mktsegment as company, n.n_name as location,
               cast(floor(abs(c.c_acctbal)) as int) as followers,
               cast(c.c_custkey % 30 as int) as public_repos
        from customer c join nation n on c.c_nationkey = n.n_nationkey""",
    "sale_lines": """
        select l.l_orderkey as order_id, o.o_custkey as customer_id, l.l_partkey as product_id,
               cast(o.o_orderdate as date) as full_date, cast(l.l_quantity as int) as quantity,
               cast(floor(l.l_extendedprice * 100 / l.l_quantity) / 100 as decimal(10,2)) as unit_price
        from lineitem l join orders o on l.l_orderkey = o.o_orderkey""",
    "customer_history": """
        select c.c_custkey as customer_id, s.snapshot_date, n.n_name as country,
               case when c.c_custkey % 4 = 0 and s.snapshot_date >= cast('1997-01-01' as date) then 'VIP'
                    when c.c_custkey % 4 = 1 and s.snapshot_date = cast('1997-01-01' as date) then null
                    else c.c_mktsegment end as customer_segment
        from (select c_custkey, c_nationkey, c_mktsegment,
                     explode(array(date'1995-01-01', date'1997-01-01', date'1999-01-01')) as snapshot_date
              from customer) c
        join nation n on c.c_nationkey = n.n_nationkey""".replace("s.snapshot_date", "c.snapshot_date"),
    "product_history": """
        select p.product_id, p.snapshot_date, p.product_name,
               case when p.product_id % 3 = 0 and p.snapshot_date >= cast('1998-01-01' as date) then 'Premium'
                    else p.p_type end as category, p.brand
        from (select p_partkey as product_id, p_name as product_name, p_type, p_brand as brand,
                     explode(array(date'1995-01-01', date'1998-01-01')) as snapshot_date
              from part) p""",
}

DUCKDB_ONLY: dict[str, str] = {
    name: ADAPTERS[name]
    .replace("explode(array(", "unnest(list_value(")
    for name in ("customer_history", "product_history")
}


def _referenced(text: str, names) -> list[str]:
    words = set(re.findall(r"[a-z_]+", text))
    return [name for name in names if name in words]


def oracle_text(sql: str) -> str:
    """Put the adapters a query reads in front of it as common table expressions."""
    parts = [
        f"{name} as ({DUCKDB_ONLY.get(name, ADAPTERS[name]).strip()})" for name in _referenced(sql, ADAPTERS)
    ]
    body = sql.strip()
    if not parts:
        return body
    if body.lower().startswith("with "):
        return "with " + ",\n".join(parts) + ",\n" + body[5:]
    return "with " + ",\n".join(parts) + "\n" + body


class Tables:
    """Lazy access to the driver tables and adapters of one directory, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.base(name)
        if name not in ADAPTERS:
            raise AttributeError(name)
        text = ADAPTERS[name]
        sources = _referenced(text, BASE_TABLES)
        # table names stand after FROM or JOIN only
        text = re.sub(
            r"\b(from|join)\s+(" + "|".join(sources) + r")\b", lambda m: f"{m.group(1)} {{{m.group(2)}}}", text
        )
        return self.spark.sql(text, **{s: self.base(s) for s in sources})
