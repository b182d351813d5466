"""Queries over grouped aggregates and stored reports."""

from __future__ import annotations

from tidemark.operators import aggregates as a
from tidemark.operators import reports as r
from tidemark.registry.base import register, rounded

REV = "l.unit_price * l.quantity * (1 - l.discount)"

register(
    "d01_revenue_per_product",
    lambda t: rounded(a.revenue_per_product(t.shop_products, t.shop_lines), 4, "total_revenue"),
    f"""select p.product_name, round(sum({REV}), 4) as total_revenue
        from shop_lines l join shop_products p on p.product_id = l.product_id group by all""",
)
register(
    "d02_orders_per_employee",
    lambda t: a.orders_per_employee(t.shop_employees, t.shop_orders),
    """select e.employee_id, e.last_name, count(*) as total_orders
       from shop_orders o join shop_employees e on e.employee_id = o.employee_id group by all""",
)
register(
    "d03_revenue_per_customer",
    lambda t: rounded(a.revenue_per_customer(t.shop_customers, t.shop_orders, t.shop_lines), 4, "total_spent"),
    f"""select c.customer_id, c.company_name, round(sum({REV}), 4) as total_spent
        from shop_lines l join shop_orders o on o.order_id = l.order_id
        join shop_customers c on c.customer_id = o.customer_id group by all""",
)
register(
    "d04_having_sum",
    lambda t: rounded(
        a.big_spenders(t.shop_customers, t.shop_orders, t.shop_lines, 1_500_000), 4, "total_spent"
    ),
    f"""select c.customer_id, c.company_name, round(sum({REV}), 4) as total_spent
        from shop_lines l join shop_orders o on o.order_id = l.order_id
        join shop_customers c on c.customer_id = o.customer_id
        group by all having sum({REV}) >= 1500000 order by 3 desc, 1""",
)
register(
    "d05_avg_price_per_category",
    lambda t: rounded(a.average_price_per_category(t.shop_products, t.shop_categories), 6, "average_unit_price"),
    """select c.category_name, round(avg(p.unit_price), 6) as average_unit_price
       from shop_products p join shop_categories c on c.category_id = p.category_id group by all""",
)
register(
    "d06_products_per_supplier",
    lambda t: a.products_per_supplier(t.shop_products, t.shop_suppliers),
    """select s.company_name, count(*) as product_count
       from shop_suppliers s join shop_products p on p.supplier_id = s.supplier_id group by all""",
)
register(
    "d07_qty_per_category",
    lambda t: a.quantity_per_category(t.shop_products, t.shop_categories, t.shop_lines),
    """select c.category_name, sum(l.quantity) as sold_per_category
       from shop_categories c join shop_products p on p.category_id = c.category_id
       join shop_lines l on l.product_id = p.product_id group by all""",
)
register(
    "d08_avg_discount_pct",
    lambda t: rounded(a.average_discount_percent(t.shop_products, t.shop_lines), 6, "average_discount"),
    """select p.product_name, round(avg(l.discount) * 100, 6) as average_discount
       from shop_products p join shop_lines l on l.product_id = p.product_id group by all order by 2 desc, 1""",
)
register(
    "d09_orders_per_shipper",
    lambda t: a.orders_per_shipper(t.shop_orders, t.shop_shippers),
    """select s.company_name, count(*) as num_of_orders
       from shop_shippers s join shop_orders o on s.shipper_id = o.ship_via group by all""",
)
register(
    "d10_freight_per_shipper",
    lambda t: rounded(a.freight_per_shipper(t.shop_orders, t.shop_shippers), 6, "total_freight_cost"),
    """select s.company_name, round(sum(o.freight), 6) as total_freight_cost
       from shop_shippers s join shop_orders o on s.shipper_id = o.ship_via group by all""",
)
register(
    "d11_count_star_group",
    lambda t: a.count_per(t.shop_customers, "country", out="num_customers"),
    "select country, count(*) as num_customers from shop_customers group by country",
)
register(
    "d12_hire_year",
    lambda t: a.hire_years(t.shop_employees),
    """select distinct employee_id, first_name, last_name, cast(year(hire_date) as integer) as hire_year
       from shop_employees""",
)
register(
    "d13_avg_line_value",
    lambda t: rounded(a.average_line_value(t.shop_lines), 8, "average_line_value"),
    f"""select l.order_id, round(avg({REV}), 8) as average_line_value from shop_lines l group by all""",
)
register(
    "d14_stock_per_category",
    lambda t: a.stock_per_category(t.shop_products, t.shop_categories),
    """select c.category_name, cast(sum(p.units_in_stock) as bigint) as in_stock
       from shop_categories c join shop_products p on p.category_id = c.category_id group by all""",
)
register(
    "d15_having_count",
    lambda t: a.products_per_supplier(t.shop_products, t.shop_suppliers, more_than=3),
    """select s.company_name, count(*) as product_count
       from shop_suppliers s join shop_products p on p.supplier_id = s.supplier_id
       group by all having count(*) > 3""",
)
register(
    "d16_having_count_distinct",
    lambda t: a.single_product_orders(t.shop_orders, t.shop_lines),
    """select o.order_id, o.customer_id, count(distinct l.product_id) as unique_products
       from shop_orders o join shop_lines l on l.order_id = o.order_id
       group by all having count(distinct l.product_id) = 1""",
)
register(
    "d17_having_max",
    lambda t: a.products_with_small_orders(t.shop_products, t.shop_lines, 49),
    """select p.product_id, p.product_name, max(l.quantity) as max_quantity
       from shop_products p join shop_lines l on l.product_id = p.product_id
       group by all having max(l.quantity) <= 49""",
)
register(
    "d18_having_sum_vs_column",
    lambda t: rounded(a.discount_above_freight(t.shop_orders, t.shop_lines), 6, "total_discount", "freight"),
    """select o.order_id, round(sum(l.unit_price * l.quantity * l.discount), 6) as total_discount,
              round(o.freight, 6) as freight
       from shop_orders o join shop_lines l on l.order_id = o.order_id
       group by o.order_id, o.freight having sum(l.unit_price * l.quantity * l.discount) > o.freight""",
)
register(
    "d19_having_distinct_suppliers",
    lambda t: a.customers_with_many_suppliers(
        t.shop_customers, t.shop_orders, t.shop_lines, t.shop_products, 3
    ),
    """select c.customer_id, c.company_name, count(distinct p.supplier_id) as supplier_count
       from shop_customers c join shop_orders o on o.customer_id = c.customer_id
       join shop_lines l on l.order_id = o.order_id join shop_products p on p.product_id = l.product_id
       group by all having count(distinct p.supplier_id) > 3""",
)
register(
    "d20_having_avg",
    lambda t: rounded(
        a.employees_with_large_lines(t.shop_employees, t.shop_orders, t.shop_lines, 25.5), 6, "average_quantity"
    ),
    """select e.employee_id, e.last_name, round(avg(l.quantity), 6) as average_quantity
       from shop_employees e join shop_orders o on o.employee_id = e.employee_id
       join shop_lines l on l.order_id = o.order_id group by all having avg(l.quantity) > 25.5""",
)
register(
    "d21_having_min",
    lambda t: a.categories_with_min_price(t.shop_products, t.shop_categories, 900.3),
    """select c.category_id, c.category_name, min(p.unit_price) as product_cost
       from shop_categories c join shop_products p on p.category_id = c.category_id
       group by all having min(p.unit_price) >= 900.3""",
)
register(
    "d22_conditional_agg",
    lambda t: a.orders_with_cheap_and_dear(t.shop_lines, 1000, 3000),
    """select order_id, min(unit_price) as min_price, max(unit_price) as max_price
       from shop_lines group by order_id
       having count(*) filter (where unit_price < 1000) > 0 and count(*) filter (where unit_price > 3000) > 0""",
)
register(
    "d23_having_max_zero",
    lambda t: a.suppliers_never_discounted(t.shop_suppliers, t.shop_products, t.shop_lines),
    """select s.supplier_id, s.company_name, max(l.discount) as max_discount
       from shop_suppliers s join shop_products p on p.supplier_id = s.supplier_id
       join shop_lines l on l.product_id = p.product_id group by all having max(l.discount) = 0""",
)
register(
    "d24_having_lt",
    lambda t: a.customers_with_few_orders(t.shop_customers, t.shop_orders, 7),
    """select c.company_name, count(o.order_id) as num_of_orders
       from shop_customers c join shop_orders o on o.customer_id = c.customer_id
       group by c.company_name having count(o.order_id) < 7""",
)
register(
    "d25_territories_per_region",
    lambda t: a.territories_per_region(t.shop_regions, t.shop_territories),
    """select r.region_description, count(*) as territory_count
       from shop_territories te join shop_regions r on r.region_id = te.region_id group by all""",
)
register(
    "d26_multi_territory_employees",
    lambda t: a.multi_territory_employees(t.shop_staff_territories),
    """select employee_id, count(*) as territory_count from shop_staff_territories
       group by employee_id having count(*) > 1""",
)
_STAFFED = """shop_orders o join shop_employees e on e.employee_id = o.employee_id
       join shop_staff_territories st on st.employee_id = e.employee_id
       join shop_territories te on te.territory_id = st.territory_id"""
register(
    "d27_orders_per_region",
    lambda t: a.orders_per_region(
        t.shop_regions, t.shop_territories, t.shop_staff_territories, t.shop_employees, t.shop_orders
    ),
    f"""select r.region_description, count(*) as total_orders
        from {_STAFFED} join shop_regions r on r.region_id = te.region_id group by all""",
)
register(
    "d28_countries_per_shipper",
    lambda t: a.shippers_with_many_countries(t.shop_orders, t.shop_shippers, 3),
    """select s.company_name, count(distinct o.ship_country) as countries_served
       from shop_orders o join shop_shippers s on s.shipper_id = o.ship_via
       group by all having count(distinct o.ship_country) > 3""",
)
register(
    "d29_group_multi_agg",
    lambda t: rounded(a.bills_per_day(t.tips), 4, "avg_bill"),
    "select day, count(*) as transactions, round(avg(total_bill), 4) as avg_bill from tips group by day",
)
register(
    "d30_avg_tip_pct_by_day",
    lambda t: rounded(rounded(a.tip_share_per_day(t.tips), 6, "avg_tip_pct"), 4, "avg_bill"),
    """select day, round(avg(tip / total_bill), 6) as avg_tip_pct, round(avg(total_bill), 4) as avg_bill
       from tips group by day""",
)
register(
    "d31_combined_by_day",
    lambda t: rounded(rounded(a.day_summary(t.tips), 6, "avg_tip_percentage"), 4, "avg_bill"),
    """select day, count(*) as transactions, round(avg(total_bill), 4) as avg_bill,
              round(avg(tip / total_bill), 6) as avg_tip_percentage from tips group by day""",
)
register(
    "d32_filter_group_sort",
    lambda t: rounded(a.day_time_summary(t.tips, 10_000), 4, "avg_bill", "avg_tip"),
    """select day, time, count(*) as transactions, round(avg(total_bill), 4) as avg_bill,
              round(avg(tip), 4) as avg_tip
       from tips where total_bill > 10000 group by day, time order by 4 desc, 1, 2""",
)
register(
    "d33_orders_per_employee_territory",
    lambda t: rounded(
        a.orders_per_employee_by_territory(
            t.shop_territories, t.shop_staff_territories, t.shop_employees, t.shop_orders
        ),
        6,
        "orders_per_employee",
    ),
    f"""select te.territory_id, count(o.order_id) as total_orders,
               count(distinct e.employee_id) as employee_count,
               round(cast(count(o.order_id) as double) / count(distinct e.employee_id), 6) as orders_per_employee
        from {_STAFFED} group by te.territory_id""",
)
register(
    "d34_value_range",
    lambda t: rounded(a.order_value_range(t.shop_orders, t.shop_lines, 50_000), 4, "value_range"),
    f"""with totals as (
          select o.order_id, o.customer_id, sum({REV}) as v
          from shop_orders o join shop_lines l on l.order_id = o.order_id group by 1, 2)
        select customer_id, round(max(v) - min(v), 4) as value_range from totals
        group by customer_id having max(v) - min(v) > 50000""",
)

# ---- stored reports -----------------------------------------------------------------------------

_CUSTOMER_SALES = f"""(select c.customer_id, c.company_name, sum({REV}) as total_sales
     from shop_customers c join shop_orders o on o.customer_id = c.customer_id
     join shop_lines l on l.order_id = o.order_id group by 1, 2)"""
_ORDER_TOTALS = f"""(select o.order_id, o.customer_id, o.order_date, sum({REV}) as total_value
     from shop_orders o join shop_lines l on l.order_id = o.order_id group by 1, 2, 3)"""
_PRODUCT_SALES = f"""(select p.product_id, p.product_name, sum(l.quantity) as total_quantity_sold,
            sum({REV}) as total_revenue
     from shop_products p join shop_lines l on l.product_id = p.product_id group by 1, 2)"""
_SUPPLIER_SALES = f"""(select s.supplier_id, s.company_name, sum({REV}) as total_revenue
     from shop_suppliers s join shop_products p on p.supplier_id = s.supplier_id
     join shop_lines l on l.product_id = p.product_id group by 1, 2)"""
_SHIPPING = """(select ship_via, count(order_id) as total_orders, avg(freight) as avg_freight,
            avg(case when shipped_date > required_date then 1.0 else 0.0 end) as late_ratio
     from shop_orders group by ship_via)"""


def _customer_sales(t):
    return r.customer_total_sales(t.shop_customers, t.shop_orders, t.shop_lines)


register(
    "g01_customer_total_sales",
    lambda t: rounded(_customer_sales(t), 4, "total_sales"),
    f"select customer_id, company_name, round(total_sales, 4) as total_sales from {_CUSTOMER_SALES} v",
)
register(
    "g02_high_value_customers",
    lambda t: rounded(r.high_value_customers(_customer_sales(t), 1_500_000), 4, "total_sales"),
    f"""select customer_id, company_name, round(total_sales, 4) as total_sales from {_CUSTOMER_SALES} v
        where total_sales > 1500000""",
)
register(
    "g03_order_total_values",
    lambda t: rounded(r.order_total_values(t.shop_orders, t.shop_lines), 4, "total_value"),
    f"select order_id, customer_id, order_date, round(total_value, 4) as total_value from {_ORDER_TOTALS} v",
)
register(
    "g04_orders_above_avg",
    lambda t: rounded(
        r.above_own_average(r.order_total_values(t.shop_orders, t.shop_lines), "total_value").select(
            "order_id", "total_value"
        ),
        4,
        "total_value",
    ),
    f"""with v as {_ORDER_TOTALS}
        select order_id, round(total_value, 4) as total_value from v
        where total_value > (select avg(total_value) from v)""",
)
register(
    "g05_product_sales_summary",
    lambda t: rounded(r.product_sales_summary(t.shop_products, t.shop_lines), 4, "total_revenue"),
    f"""select product_id, product_name, total_quantity_sold, round(total_revenue, 4) as total_revenue
        from {_PRODUCT_SALES} v""",
)
register(
    "g06_premium_low_volume",
    lambda t: rounded(
        r.premium_low_volume(r.product_sales_summary(t.shop_products, t.shop_lines), 700_000, 700),
        4,
        "total_revenue",
    ),
    f"""select product_id, product_name, total_quantity_sold, round(total_revenue, 4) as total_revenue
        from {_PRODUCT_SALES} v where total_revenue > 700000 and total_quantity_sold < 700""",
)
register(
    "g07_supplier_performance",
    lambda t: rounded(
        r.supplier_performance(t.shop_suppliers, t.shop_products, t.shop_lines), 1, "total_revenue"
    ),
    f"select supplier_id, company_name, round(total_revenue, 1) as total_revenue from {_SUPPLIER_SALES} v",
)
register(
    "g08_suppliers_above_avg",
    lambda t: rounded(
        r.above_own_average(
            r.supplier_performance(t.shop_suppliers, t.shop_products, t.shop_lines), "total_revenue"
        ),
        1,
        "total_revenue",
    ),
    f"""with v as {_SUPPLIER_SALES}
        select supplier_id, company_name, round(total_revenue, 1) as total_revenue from v
        where total_revenue > (select avg(total_revenue) from v)""",
)
register(
    "g09_shipping_performance",
    lambda t: rounded(r.shipping_performance(t.shop_orders), 6, "avg_freight", "late_ratio"),
    f"""select ship_via, total_orders, round(avg_freight, 6) as avg_freight, round(late_ratio, 6) as late_ratio
        from {_SHIPPING} v""",
)
register(
    "g10_reliable_shippers",
    lambda t: rounded(
        r.reliable_shippers(r.shipping_performance(t.shop_orders), 0.19), 6, "avg_freight", "late_ratio"
    ),
    f"""select ship_via, total_orders, round(avg_freight, 6) as avg_freight, round(late_ratio, 6) as late_ratio
        from {_SHIPPING} v where late_ratio < 0.19""",
)
register(
    "g11_cross_country_flag",
    lambda t: r.cross_country_flags(t.shop_orders, t.shop_lines, t.shop_products, t.shop_suppliers),
    """select o.customer_id, o.order_id, o.ship_country, s.country as supplier_country,
              cast(case when o.ship_country <> s.country then 1 else 0 end as integer) as cross_country_flag
       from shop_lines l join shop_orders o on o.order_id = l.order_id
       join shop_products p on p.product_id = l.product_id
       join shop_suppliers s on s.supplier_id = p.supplier_id""",
)
register(
    "g12_temp_view_sql",
    lambda t: r.sql_over_view(
        t.tips.select("day", "total_bill"),
        "tidemark_bills",
        """select day, count(*) as transactions, round(avg(total_bill), 4) as avg_bill
           from tidemark_bills group by day""",
    ),
    "select day, count(*) as transactions, round(avg(total_bill), 4) as avg_bill from tips group by day",
)
