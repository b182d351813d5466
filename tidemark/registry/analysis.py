"""Queries over subqueries and window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import subqueries as s
from tidemark.operators import windows as w
from tidemark.operators.skew import latest_per_key
from tidemark.registry.base import register, rounded

REV = "l.unit_price * l.quantity * (1 - l.discount)"

register(
    "e01_not_exists_product",
    lambda t: s.unsold_products(t.shop_products, t.shop_lines),
    """select product_id, product_name from shop_products p
       where not exists (from shop_lines l where l.product_id = p.product_id)""",
)
register(
    "e02_exists_group_having",
    lambda t: s.customers_with_big_order(t.shop_orders, t.shop_lines, 400_000),
    f"""select distinct customer_id from shop_orders
        where order_id in (select l.order_id from shop_lines l group by 1 having sum({REV}) > 400000)""",
)
register(
    "e03_corr_scalar_avg",
    lambda t: s.above_category_average(t.shop_products),
    """select product_name, unit_price from shop_products p
       where unit_price > (select avg(q.unit_price) from shop_products q where q.category_id = p.category_id)""",
)
register(
    "e04_relational_division",
    lambda t: s.customers_covering_category(t.shop_customers, t.shop_orders, t.shop_lines, t.shop_products, 1),
    """with bought as (
         select distinct o.customer_id, l.product_id
         from shop_orders o join shop_lines l on l.order_id = o.order_id),
       missing as (
         select c.customer_id from shop_customers c cross join shop_products p
         where p.category_id = 1 and not exists (
           from bought b where b.customer_id = c.customer_id and b.product_id = p.product_id))
       select customer_id from shop_customers where customer_id not in (select customer_id from missing)""",
)
register(
    "e04_relational_division_suppliers",
    lambda t: s.customers_covering_category(
        t.shop_customers, t.shop_orders, t.shop_lines, t.shop_products, 1, item="supplier_id"
    ),
    """with bought as (
         select distinct o.customer_id, p.supplier_id
         from shop_orders o join shop_lines l on l.order_id = o.order_id
         join shop_products p on p.product_id = l.product_id),
       missing as (
         select c.customer_id
         from shop_customers c cross join (select distinct supplier_id from shop_products where category_id = 1) w
         where not exists (
           from bought b where b.customer_id = c.customer_id and b.supplier_id = w.supplier_id))
       select customer_id from shop_customers where customer_id not in (select customer_id from missing)""",
)
register(
    "e05_above_avg_orders",
    lambda t: rounded(s.orders_above_average(t.shop_orders, t.shop_lines), 4, "total_value"),
    f"""with totals as (
          select o.order_id, sum({REV}) as v from shop_orders o join shop_lines l on l.order_id = o.order_id group by 1)
        select order_id, round(v, 4) as total_value from totals where v > (select avg(v) from totals)""",
)
register(
    "e06_not_exists_employee",
    lambda t: s.idle_employees(t.shop_employees, t.shop_orders),
    """select employee_id, first_name, last_name from shop_employees e
       where not exists (from shop_orders o where o.employee_id = e.employee_id)""",
)
register(
    "e07_forall_above_global_avg",
    lambda t: s.suppliers_all_above_average(t.shop_suppliers, t.shop_products),
    """select supplier_id, company_name from shop_suppliers s
       where not exists (
         from shop_products p where p.supplier_id = s.supplier_id
         and p.unit_price <= (select avg(unit_price) from shop_products))""",
)
register(
    "e08_only_discounted",
    lambda t: s.customers_only_discounted(t.shop_customers, t.shop_orders, t.shop_lines),
    """select customer_id from shop_customers c
       where not exists (
         from shop_orders o join shop_lines l on l.order_id = o.order_id
         where o.customer_id = c.customer_id and l.discount = 0)""",
)
register(
    "e09_corr_scalar_max",
    lambda t: s.dearest_per_supplier(t.shop_products),
    """select product_id, product_name, unit_price from shop_products
       qualify rank() over (partition by supplier_id order by unit_price desc) = 1""",
)
register(
    "e10_having_vs_global",
    lambda t: rounded(s.shippers_above_average_freight(t.shop_orders, t.shop_shippers), 6, "avg_freight"),
    """select s.company_name, round(avg(o.freight), 6) as avg_freight
       from shop_orders o join shop_shippers s on o.ship_via = s.shipper_id
       group by s.company_name having avg(o.freight) > (select avg(freight) from shop_orders)""",
)
register(
    "e11_uncovered_territories",
    lambda t: s.uncovered_territories(t.shop_territories, t.shop_staff_territories),
    """select territory_id, territory_description from shop_territories
       where territory_id not in (select territory_id from shop_staff_territories)""",
)
register(
    "e12_fully_covered_regions",
    lambda t: s.fully_covered_regions(t.shop_regions, t.shop_territories, t.shop_staff_territories),
    """select region_description from shop_regions
       where region_id not in (
         select region_id from shop_territories
         where territory_id not in (select territory_id from shop_staff_territories))""",
)
_STAFFED = """shop_orders o join shop_employees e on e.employee_id = o.employee_id
         join shop_staff_territories st on st.employee_id = e.employee_id
         join shop_territories te on te.territory_id = st.territory_id"""
register(
    "e13_busy_region_employees",
    lambda t: s.busy_region_employees(
        t.shop_regions, t.shop_territories, t.shop_staff_territories, t.shop_employees, t.shop_orders, 3000
    ),
    f"""with busy as (
          select te.region_id from {_STAFFED} group by 1 having count(o.order_id) > 3000)
        select distinct e.employee_id, e.last_name
        from shop_employees e join shop_staff_territories st on st.employee_id = e.employee_id
        join shop_territories te on te.territory_id = st.territory_id
        where te.region_id in (select region_id from busy)""",
)
register(
    "e14_least_used_shipper",
    lambda t: s.least_used_shipper_orders(t.shop_orders, t.shop_shippers),
    """select o.order_id, s.company_name from shop_orders o join shop_shippers s on s.shipper_id = o.ship_via
       where o.ship_via = (select ship_via from shop_orders group by 1 order by count(*), ship_via limit 1)""",
)
register(
    "e15_above_avg_territories",
    lambda t: rounded(
        s.territories_above_average_revenue(
            t.shop_territories, t.shop_staff_territories, t.shop_employees, t.shop_orders, t.shop_lines
        ),
        2,
        "revenue",
    ),
    f"""with earned as (
          select te.territory_id, sum({REV}) as v
          from {_STAFFED} join shop_lines l on l.order_id = o.order_id group by 1)
        select territory_id, round(v, 2) as revenue from earned where v > (select avg(v) from earned)""",
)
register(
    "e16_never_late_shippers",
    lambda t: s.never_late_shippers(t.shop_orders, t.shop_shippers),
    """select company_name from shop_shippers s
       where not exists (
         from shop_orders o where o.ship_via = s.shipper_id and o.shipped_date > o.required_date)""",
)
register(
    "e17_dependency_ratio",
    lambda t: rounded(s.product_dependency(t.shop_orders, t.shop_lines, 0.05), 6, "dependency_ratio"),
    """with pairs as (
         select o.customer_id, l.product_id, count(*) as n
         from shop_orders o join shop_lines l on l.order_id = o.order_id
         where o.customer_id is not null group by 1, 2),
       shares as (
         select *, cast(n as double) / cast(sum(n) over (partition by customer_id) as double) as share from pairs)
       select customer_id, product_id, n as product_orders, round(share, 6) as dependency_ratio
       from shares where share > 0.05""",
)
register(
    "e18_dominant_line",
    lambda t: rounded(s.dominant_lines(t.shop_lines, 0.7), 6, "product_value", "share"),
    f"""with valued as (
          select l.order_id, l.product_id, {REV} as v,
                 sum({REV}) over (partition by l.order_id) as total from shop_lines l)
        select order_id, product_id, round(v, 6) as product_value, round(v / total, 6) as share
        from valued where v / total > 0.7""",
)
register(
    "e19_derived_table",
    lambda t: rounded(
        w.revenue_by_order_key(t.shop_orders, t.shop_lines, "customer_id").withColumnRenamed(
            "revenue", "total_revenue"
        ),
        4,
        "total_revenue",
    ),
    f"""select d.customer_id, round(d.v, 4) as total_revenue
        from (select o.customer_id, sum({REV}) as v
              from shop_orders o join shop_lines l on l.order_id = o.order_id group by 1) d""",
)

# ---- windows ------------------------------------------------------------------------------------

register(
    "f01_rank_partition",
    lambda t: w.price_rank_in_category(t.shop_products),
    """select category_id, product_id, product_name, unit_price,
              rank() over (partition by category_id order by unit_price desc nulls last) as price_rank
       from shop_products""",
)
register(
    "f02_running_sum",
    lambda t: rounded(w.running_freight(t.shop_orders), 6, "running_freight"),
    """select customer_id, order_id, order_date,
              round(sum(freight) over (partition by customer_id order by order_date), 6) as running_freight
       from shop_orders""",
)
register(
    "f03_row_number",
    lambda t: w.order_sequence(t.shop_orders),
    """select employee_id, order_id, order_date,
              row_number() over (partition by employee_id order by order_date, order_id) as order_sequence
       from shop_orders""",
)
register(
    "f04_avg_over_partition",
    lambda t: rounded(w.price_and_supplier_average(t.shop_products), 6, "avg_supplier_price"),
    """select product_id, product_name, unit_price,
              round(avg(unit_price) over (partition by supplier_id), 6) as avg_supplier_price
       from shop_products""",
)
register(
    "f05_avg_freight_country",
    lambda t: rounded(w.freight_and_country_average(t.shop_orders), 6, "avg_country_freight"),
    """select ship_country, order_id, freight,
              round(avg(freight) over (partition by ship_country), 6) as avg_country_freight
       from shop_orders""",
)
register(
    "f06_rank_of_count",
    lambda t: w.employee_order_rank(t.shop_employees, t.shop_orders),
    """with n as (
         select e.employee_id, count(o.order_id) as total_orders
         from shop_employees e join shop_orders o on o.employee_id = e.employee_id group by 1)
       select *, rank() over (order by total_orders desc) as employee_rank from n""",
)
register(
    "f07_running_quantity",
    lambda t: w.running_quantity(t.shop_orders, t.shop_lines),
    """select l.product_id, o.order_date,
              sum(l.quantity) over (partition by l.product_id order by o.order_date) as running_quantity
       from shop_lines l join shop_orders o on o.order_id = l.order_id""",
)
register(
    "f08_rank_of_revenue",
    lambda t: w.supplier_revenue_rank(t.shop_suppliers, t.shop_products, t.shop_lines, digits=1),
    f"""with n as (
          select s.company_name, round(sum({REV}), 1) as total_revenue
          from shop_suppliers s join shop_products p on p.supplier_id = s.supplier_id
          join shop_lines l on l.product_id = p.product_id group by 1)
        select *, rank() over (order by total_revenue desc) as supplier_rank from n""",
)
register(
    "f09_row_number_country",
    lambda t: w.customer_row_in_country(t.shop_customers),
    """select customer_id, country, row_number() over (partition by country order by customer_id) as country_row
       from shop_customers""",
)
register(
    "f10_avg_of_avg",
    lambda t: rounded(
        w.quantity_and_overall_average(t.shop_orders, t.shop_lines), 6, "avg_quantity", "overall_avg_quantity"
    ),
    """with n as (
         select o.order_id, avg(l.quantity) as q
         from shop_orders o join shop_lines l on l.order_id = o.order_id group by 1)
       select order_id, round(q, 6) as avg_quantity, round(avg(q) over (), 6) as overall_avg_quantity from n""",
)
register(
    "f11_rank_territories",
    lambda t: w.territory_rank(t.shop_territories, t.shop_staff_territories),
    """with n as (
         select territory_id, count(employee_id) as employee_count
         from shop_staff_territories join shop_territories using (territory_id) group by 1)
       select *, rank() over (order by employee_count desc) as territory_rank from n""",
)
register(
    "f12_rank_shippers",
    lambda t: w.shipper_freight_rank(t.shop_orders, t.shop_shippers),
    """with n as (
         select s.company_name, round(sum(o.freight), 6) as total_freight
         from shop_orders o join shop_shippers s on s.shipper_id = o.ship_via group by 1)
       select *, rank() over (order by total_freight desc) as shipper_rank from n""",
)
register(
    "f13_lag_freight",
    lambda t: w.previous_freight(t.shop_orders),
    """select customer_id, order_id, order_date, freight,
              lag(freight) over (partition by customer_id order by order_date, order_id) as previous_freight
       from shop_orders""",
)
register(
    "f14_lag_quantity",
    lambda t: w.previous_quantity(t.shop_orders, t.shop_lines),
    """select l.order_id, l.line_no, l.product_id, l.quantity, o.order_date,
              lag(l.quantity) over (
                partition by l.product_id order by o.order_date, l.order_id, l.line_no, l.quantity
              ) as previous_quantity
       from shop_lines l join shop_orders o on o.order_id = l.order_id""",
)
register(
    "f15_dense_rank_revenue",
    lambda t: w.customer_revenue_rank(t.shop_orders, t.shop_lines),
    f"""with n as (
          select o.customer_id, round(sum({REV}), 4) as total_revenue
          from shop_orders o join shop_lines l on l.order_id = o.order_id group by 1)
        select *, dense_rank() over (order by total_revenue desc nulls last) as revenue_rank from n""",
)
register(
    "f16_share_of_category",
    lambda t: rounded(
        rounded(w.category_revenue_share(t.shop_products, t.shop_lines), 4, "product_revenue"), 6, "revenue_share"
    ),
    f"""with n as (
          select p.category_id, p.product_name, sum({REV}) as v
          from shop_products p join shop_lines l on l.product_id = p.product_id group by 1, 2)
        select category_id, product_name, round(v, 4) as product_revenue,
               round(v / sum(v) over (partition by category_id), 6) as revenue_share from n""",
)
register(
    "f17_moving_avg",
    lambda t: rounded(w.moving_freight(t.shop_orders), 6, "moving_avg_freight"),
    """select ship_via, order_id, freight,
              round(avg(freight) over (partition by ship_via order by order_date, order_id
                                       rows between 2 preceding and current row), 6) as moving_avg_freight
       from shop_orders""",
)
register(
    "f18_lag_complexity",
    lambda t: w.order_complexity_lag(t.shop_orders, t.shop_lines),
    """with n as (
         select o.employee_id, o.order_id, count(distinct l.product_id) as product_count
         from shop_orders o join shop_lines l on l.order_id = o.order_id group by 1, 2)
       select *, lag(product_count) over (partition by employee_id order by order_id) as previous_complexity from n""",
)
register(
    "f19_usage_share",
    lambda t: rounded(w.shipper_usage_share(t.shop_orders, t.shop_shippers), 6, "usage_share"),
    """with n as (
         select o.ship_country, s.company_name, count(o.order_id) as usage_count
         from shop_orders o join shop_shippers s on s.shipper_id = o.ship_via group by 1, 2)
       select *, round(cast(usage_count as double)
                       / cast(sum(usage_count) over (partition by ship_country) as double), 6) as usage_share
       from n""",
)
register(
    "f20_rank_bill_by_day",
    lambda t: w.bill_rank_in_day(t.tips),
    """select day, total_bill, tip,
              rank() over (partition by day order by total_bill desc) as bill_rank from tips""",
)
register(
    "f21_running_total_by_day",
    lambda t: rounded(w.running_bill_in_day(t.tips), 2, "running_total"),
    """select day, total_bill,
              round(sum(total_bill) over (partition by day order by total_bill), 2) as running_total from tips""",
)
register(
    "f22_tip_rank",
    lambda t: rounded(w.tip_rank_in_day(t.tips), 6, "tip_pct"),
    """select day, total_bill, tip, round(tip / total_bill, 6) as tip_pct,
              rank() over (partition by day order by tip / total_bill desc) as tip_rank from tips""",
)
register(
    "f23_dedup_latest",
    lambda t: latest_per_key(t.titles, ["show_id"], [F.col("seq").desc()]),
    "select * from titles qualify row_number() over (partition by show_id order by seq desc) = 1",
)
