"""Queries over projection, filter, sort, limit and joins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import filters as f
from tidemark.operators import joins as j
from tidemark.registry.base import register, rounded

# ---- full scans ---------------------------------------------------------------------------------

SCANNED = (
    "shop_categories", "shop_customers", "shop_employees", "shop_staff_territories", "shop_territories",
    "shop_regions", "shop_orders", "shop_lines", "shop_products", "shop_shippers", "shop_suppliers",
    "shop_customer_types", "shop_customer_type_members", "shop_states",
)

for _table in SCANNED:
    register(f"a01_scan_{_table.removeprefix('shop_')}", lambda t, n=_table: getattr(t, n), f"select * from {_table}")

for _table in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
    register(f"a01_scan_base_{_table}", lambda t, n=_table: t.base(n), f"select * from {_table}")

# ---- projection and filters ---------------------------------------------------------------------

register(
    "b01_project",
    lambda t: f.project(t.shop_customers, ["customer_id", "company_name"]),
    "select customer_id, company_name from shop_customers",
)
register(
    "b02_filter_eq",
    lambda t: f.filter_equal(t.shop_customers, "country", "NATION_3").select("company_name", "country", "region"),
    "select company_name, country, region from shop_customers where country = 'NATION_3'",
)
register(
    "b03_filter_and",
    lambda t: f.filter_all(t.shop_products, F.col("unit_price") > 950, F.col("discontinued") == 0).select(
        "product_id", "product_name", "unit_price"
    ),
    "select product_id, product_name, unit_price from shop_products where discontinued = 0 and unit_price > 950",
)
register(
    "b04_filter_or",
    lambda t: f.filter_any(
        t.shop_customers, F.col("country") == "NATION_1", F.col("country") == "NATION_2"
    ).select("customer_id", "company_name", "country"),
    """select customer_id, company_name, country from shop_customers
       where country = 'NATION_1' or country = 'NATION_2'""",
)
register(
    "b05_filter_in",
    lambda t: f.filter_in(t.shop_customers, "country", ["NATION_1", "NATION_5", "NATION_9"]).select(
        "customer_id", "company_name", "country"
    ),
    """select customer_id, company_name, country from shop_customers
       where country in ('NATION_1', 'NATION_5', 'NATION_9')""",
)
register(
    "b06_filter_between",
    lambda t: f.filter_between(t.shop_products, "unit_price", 920, 950).select("product_id", "unit_price"),
    "select product_id, unit_price from shop_products where unit_price between 920 and 950",
)
register(
    "b07_filter_ilike",
    lambda t: f.filter_ilike(t.shop_products, "product_name", "R%").select("product_id", "product_name"),
    "select product_id, product_name from shop_products where product_name ilike 'R%'",
)
register(
    "b08_filter_is_null",
    lambda t: f.filter_null(t.shop_customers, "region"),
    "select * from shop_customers where region is null",
)
register(
    "b09_order_by_desc",
    lambda t: f.order_desc(t.shop_products.select("product_id", "unit_price"), "unit_price", "product_id"),
    "select product_id, unit_price from shop_products order by unit_price desc nulls last, product_id",
)
register(
    "b10_top_n",
    lambda t: f.top_n(t.shop_products.select("product_id", "product_name", "unit_price"), "unit_price", 5, "product_id"),
    """select product_id, product_name, unit_price from shop_products
       order by unit_price desc nulls last, product_id limit 5""",
)
register(
    "b11_filter_date_ge",
    lambda t: f.filter_at_least(t.shop_orders, "order_date", dt.date(1997, 1, 1)).select("order_id", "order_date"),
    "select order_id, order_date from shop_orders where order_date >= date '1997-01-01'",
)
register(
    "b12_filter_sort_limit",
    lambda t: f.top_n(
        f.filter_equal(f.filter_between(t.shop_products, "unit_price", 920, 950), "discontinued", 0).select(
            "product_id", "product_name", "unit_price"
        ),
        "unit_price",
        10,
        "product_id",
    ),
    """select product_id, product_name, unit_price from shop_products
       where unit_price between 920 and 950 and discontinued = 0
       order by unit_price desc nulls last, product_id limit 10""",
)
register(
    "b13_filter_date_between",
    lambda t: f.filter_between(t.shop_orders, "order_date", dt.date(1997, 1, 1), dt.date(1997, 12, 31)).select(
        "order_id", "customer_id", "order_date"
    ),
    """select order_id, customer_id, order_date from shop_orders
       where order_date between date '1997-01-01' and date '1997-12-31'""",
)
register(
    "b14_filter_text_eq",
    lambda t: f.filter_equal(t.shop_customers, "contact_name", "Contact Customer#000000007"),
    "select * from shop_customers where contact_name = 'Contact Customer#000000007'",
)
register(
    "b15_filter_lower_eq",
    lambda t: f.filter_lower_equal(t.shop_customers, "contact_name", "CONTACT customer#000000007"),
    "select * from shop_customers where lower(contact_name) = 'contact customer#000000007'",
)
register(
    "b16_filter_computed",
    lambda t: f.filter_product_above(t.shop_products, "unit_price", "units_in_stock", 30000).select(
        "product_name", "unit_price", "units_in_stock"
    ),
    """select product_name, unit_price, units_in_stock from shop_products
       where unit_price * units_in_stock > 30000""",
)
register(
    "b17_filter_not",
    lambda t: f.filter_not_equal(t.shop_products, "discontinued", 1).select("product_id", "product_name"),
    "select product_id, product_name from shop_products where not discontinued = 1",
)
register(
    "b18_filter_not_null_multi",
    lambda t: f.filter_all(
        t.shop_orders,
        F.col("shipped_date").isNotNull(),
        F.col("shipped_date") > dt.date(1998, 1, 1),
        F.col("customer_id").isin(11, 12, 13, 14),
    ).select("order_id", "customer_id", "shipped_date"),
    """select order_id, customer_id, shipped_date from shop_orders
       where shipped_date is not null and shipped_date > date '1998-01-01' and customer_id in (11, 12, 13, 14)""",
)
register(
    "b19_filter_gt",
    lambda t: f.filter_greater(t.tips, "total_bill", 50000).select("order_key", "total_bill"),
    "select order_key, total_bill from tips where total_bill > 50000",
)
register(
    "b20_select_cols",
    lambda t: f.project(t.tips, ["total_bill", "tip", "day"]),
    "select total_bill, tip, day from tips",
)
register(
    "b21_derive_ratio",
    lambda t: rounded(
        f.derive_ratio(t.tips.select("order_key", "total_bill", "tip"), "tip", "total_bill", "tip_pct"), 6, "tip_pct"
    ),
    "select order_key, total_bill, tip, round(tip / total_bill, 6) as tip_pct from tips",
)
register(
    "b22_filter_line_discount",
    lambda t: f.discounted_lines(t.shop_orders, t.shop_lines, 0.2),
    """select order_id, product_id, discount from shop_lines join shop_orders using (order_id)
       where discount > 0.2""",
)

# ---- joins --------------------------------------------------------------------------------------

REV = "l.unit_price * l.quantity * (1 - l.discount)"

register(
    "c01_left_join",
    lambda t: j.customers_with_orders(t.shop_customers, t.shop_orders),
    """select c.customer_id, c.company_name, o.order_id
       from shop_customers c left join shop_orders o on o.customer_id = c.customer_id""",
)
register(
    "c02_left_anti",
    lambda t: j.customers_without_orders(t.shop_customers, t.shop_orders),
    """select company_name from shop_customers
       where customer_id not in (select customer_id from shop_orders where customer_id is not null)""",
)
register(
    "c03_right_join",
    lambda t: j.orders_with_customers(t.shop_customers, t.shop_orders),
    """select c.company_name, o.order_id
       from shop_orders o left join shop_customers c on o.customer_id = c.customer_id""",
)
register(
    "c04_left_join_count",
    lambda t: j.order_count_per_customer(t.shop_customers, t.shop_orders),
    """select c.customer_id, c.company_name, count(o.order_id) as total_orders
       from shop_customers c left join shop_orders o on o.customer_id = c.customer_id group by 1, 2""",
)
register(
    "c05_left_join_chain_sum",
    lambda t: rounded(j.revenue_per_customer_all(t.shop_customers, t.shop_orders, t.shop_lines), 4, "revenue"),
    f"""select c.customer_id, c.company_name, round(sum({REV}), 4) as revenue
        from shop_customers c left join shop_orders o on o.customer_id = c.customer_id
        left join shop_lines l on l.order_id = o.order_id group by 1, 2""",
)
register(
    "c06_left_anti_products",
    lambda t: j.products_never_ordered(t.shop_products, t.shop_lines),
    """select p.product_name, p.product_id
       from shop_products p left join shop_lines l on l.product_id = p.product_id where l.order_id is null""",
)
register(
    "c07_join_sum_employee",
    lambda t: rounded(j.revenue_per_employee(t.shop_employees, t.shop_orders, t.shop_lines), 4, "revenue"),
    f"""select e.employee_id, e.last_name, round(sum({REV}), 4) as revenue
        from shop_employees e join shop_orders o on o.employee_id = e.employee_id
        join shop_lines l on l.order_id = o.order_id group by 1, 2""",
)
register(
    "c08_cross_join",
    lambda t: j.product_category_grid(t.shop_products, t.shop_categories),
    """select p.*, c.category_id as grid_category_id, c.category_name as grid_category_name
       from shop_products p, shop_categories c""",
)
register(
    "c09_cross_filter",
    lambda t: j.products_with_category(t.shop_products, t.shop_categories),
    """select p.product_name, c.category_name from shop_products p, shop_categories c
       where c.category_id = p.category_id""",
)
register(
    "c10_left_chain_supplier",
    lambda t: rounded(j.revenue_per_supplier_all(t.shop_suppliers, t.shop_products, t.shop_lines), 1, "revenue"),
    f"""select s.supplier_id, s.company_name, round(sum({REV}), 1) as revenue
        from shop_suppliers s left join shop_products p on p.supplier_id = s.supplier_id
        left join shop_lines l on l.product_id = p.product_id group by 1, 2""",
)
register(
    "c11_non_key_name_join",
    lambda t: j.orders_with_shipper(t.shop_orders, t.shop_shippers),
    """select o.order_id, s.shipper_id, s.company_name
       from shop_shippers s join shop_orders o on s.shipper_id = o.ship_via""",
)
register(
    "c12_join_back_max",
    lambda t: j.latest_orders(t.shop_orders),
    """select customer_id, order_id, order_date from shop_orders
       where customer_id is not null
       qualify rank() over (partition by customer_id order by order_date desc) = 1""",
)
register(
    "c13_right_join_theta_null",
    lambda t: j.regions_without_match(
        t.shop_regions, t.shop_territories, t.shop_staff_territories, t.shop_orders, t.shop_customers
    ),
    """with handled as (
         select r.region_description, o.order_id, o.ship_country
         from shop_orders o
         join shop_staff_territories st on st.employee_id = o.employee_id
         join shop_territories te on te.territory_id = st.territory_id
         join shop_regions r on r.region_id = te.region_id)
       select distinct h.region_description
       from shop_customers c left join handled h on h.ship_country = c.country
       where h.order_id is null""",
)
