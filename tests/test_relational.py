"""Null, tie and empty-side cases on hand-written frames."""

import datetime as dt

import pytest

from tidemark.operators import aggregates as a
from tidemark.operators import filters as f
from tidemark.operators import joins as j
from tidemark.operators import reports as r
from tidemark.operators import subqueries as s
from tidemark.operators import windows as w

D = dt.date


@pytest.fixture(scope="module")
def shop(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    return {
        "customers": frame(
            [(1, "Ann", "Ann A", "X", None), (2, "Bob", "Bob B", "Y", "r"), (3, "Cy", "Cy C", "Z", None)],
            "customer_id long, company_name string, contact_name string, country string, region string",
        ),
        "orders": frame(
            [
                (10, 1, 100, D(2020, 1, 1), D(2020, 1, 9), D(2020, 1, 10), 1, 5.0, "X"),
                (11, 1, 100, D(2020, 1, 1), D(2020, 1, 9), None, 1, 7.0, "Y"),
                (12, 2, 101, D(2020, 1, 3), D(2020, 1, 9), D(2020, 1, 4), 2, 1.0, "Y"),
                (13, None, 101, D(2020, 1, 2), D(2020, 1, 9), D(2020, 1, 4), 2, 2.0, "X"),
            ],
            "order_id long, customer_id long, employee_id long, order_date date, required_date date, "
            "shipped_date date, ship_via long, freight double, ship_country string",
        ),
        "lines": frame(
            [
                (10, 7, 1, 10.0, 2.0, 0.0), (10, 8, 2, 100.0, 1.0, 0.5), (11, 7, 1, 10.0, 1.0, 0.5),
                (12, 8, 1, 100.0, 3.0, 0.25), (13, 7, 1, 10.0, 1.0, 0.0),
            ],
            "order_id long, product_id long, line_no int, unit_price double, quantity double, discount double",
        ),
        "products": frame(
            [(7, "p7", 1, 1, 10.0, 5, 0), (8, "p8", 2, 1, 100.0, 1, 1), (9, "p9", 2, 2, 100.0, 0, 0)],
            "product_id long, product_name string, supplier_id long, category_id long, unit_price double, "
            "units_in_stock int, discontinued int",
        ),
        "suppliers": frame([(1, "S1", "X"), (2, "S2", "Y"), (3, "S3", "Z")], "supplier_id long, company_name string, country string"),
        "shippers": frame([(1, "H1"), (2, "H2"), (3, "H3")], "shipper_id long, company_name string"),
        "employees": frame(
            [(100, "E0", "e0", D(2000, 5, 1)), (101, "E1", "e1", D(2001, 5, 1)), (102, "E2", "e2", D(2001, 5, 1))],
            "employee_id long, last_name string, first_name string, hire_date date",
        ),
        "staff": frame([(100, 1), (100, 2), (101, 2)], "employee_id long, territory_id long"),
        "territories": frame([(1, "T1", 1), (2, "T2", 1), (3, "T3", 2)], "territory_id long, territory_description string, region_id long"),
        "regions": frame([(1, "R1"), (2, "R2"), (3, "R3")], "region_id long, region_description string"),
    }


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_outer_joins(shop):
    assert rows(j.customers_with_orders(shop["customers"], shop["orders"])) == [
        (1, "Ann", 10), (1, "Ann", 11), (2, "Bob", 12), (3, "Cy", None),
    ]
    assert rows(j.customers_without_orders(shop["customers"], shop["orders"])) == [("Cy",)]
    assert rows(j.orders_with_customers(shop["customers"], shop["orders"])) == [
        ("Ann", 10), ("Ann", 11), ("Bob", 12), (None, 13),
    ]
    assert rows(j.order_count_per_customer(shop["customers"], shop["orders"]))[2] == (3, "Cy", 0)
    assert rows(j.revenue_per_customer_all(shop["customers"], shop["orders"], shop["lines"])) == [
        (1, "Ann", 75.0), (2, "Bob", 225.0), (3, "Cy", None),
    ]
    assert rows(j.revenue_per_supplier_all(shop["suppliers"], shop["products"], shop["lines"]))[2] == (3, "S3", None)


def test_ties_stay(shop):
    assert rows(j.latest_orders(shop["orders"])) == [
        (1, 10, D(2020, 1, 1)), (1, 11, D(2020, 1, 1)), (2, 12, D(2020, 1, 3)),
    ]
    assert [x[0] for x in rows(s.dearest_per_supplier(shop["products"]))] == [7, 8, 9]


def test_true_over_nothing(shop):
    assert rows(s.customers_only_discounted(shop["customers"], shop["orders"], shop["lines"])) == [(2,), (3,)]
    assert rows(s.suppliers_all_above_average(shop["suppliers"], shop["products"])) == [(2, "S2"), (3, "S3")]
    assert rows(s.never_late_shippers(shop["orders"], shop["shippers"])) == [("H2",), ("H3",)]
    assert rows(s.fully_covered_regions(shop["regions"], shop["territories"], shop["staff"])) == [("R1",), ("R3",)]


@pytest.mark.parametrize("category,expected", [(1, [(1,)]), (2, []), (99, [(1,), (2,), (3,)])])
def test_relational_division(shop, category, expected):
    got = s.customers_covering_category(shop["customers"], shop["orders"], shop["lines"], shop["products"], category)
    assert rows(got) == expected


def test_null_customer_is_a_group(shop):
    assert rows(s.customers_with_big_order(shop["orders"], shop["lines"], 5)) == [(1,), (2,), (None,)]
    assert rows(a.order_value_range(shop["orders"], shop["lines"], 10)) == [(1, 65.0)]
    # the pair of an unknown customer is left out
    assert rows(s.product_dependency(shop["orders"], shop["lines"], 0.5)) == [
        (1, 7, 2, 2 / 3), (2, 8, 1, 1.0),
    ]


def test_aggregate_limits(shop):
    assert rows(a.single_product_orders(shop["orders"], shop["lines"])) == [(11, 1, 1), (12, 2, 1), (13, None, 1)]
    assert rows(a.orders_with_cheap_and_dear(shop["lines"], 50, 50)) == [(10, 10.0, 100.0)]
    assert rows(a.discount_above_freight(shop["orders"], shop["lines"])) == [(10, 50.0, 5.0), (12, 75.0, 1.0)]
    assert rows(a.orders_per_region(shop["regions"], shop["territories"], shop["staff"], shop["employees"], shop["orders"])) == [("R1", 6)]
    assert rows(a.orders_per_employee_by_territory(shop["territories"], shop["staff"], shop["employees"], shop["orders"])) == [
        (1, 2, 1, 2.0), (2, 4, 2, 2.0),
    ]
    assert rows(a.suppliers_never_discounted(shop["suppliers"], shop["products"], shop["lines"])) == []


def test_region_right_join_gives_one_null(shop):
    args = [shop["regions"], shop["territories"], shop["staff"], shop["orders"], shop["customers"]]
    assert rows(j.regions_without_match(*args)) == [(None,)]
    args[4] = shop["customers"].filter("country <> 'Z'")
    assert rows(j.regions_without_match(*args)) == []


def test_scalar_comparisons(shop):
    assert rows(s.orders_above_average(shop["orders"], shop["lines"])) == [(12, 225.0)]
    assert rows(s.least_used_shipper_orders(shop["orders"], shop["shippers"])) == [(10, "H1"), (11, "H1")]
    assert rows(r.reliable_shippers(r.shipping_performance(shop["orders"]), 0.1)) == [(2, 2, 1.5, 0.0)]
    assert rows(s.busy_region_employees(shop["regions"], shop["territories"], shop["staff"], shop["employees"], shop["orders"], 3)) == [
        (100, "E0"), (101, "E1"),
    ]


def test_windows(shop):
    assert rows(w.running_freight(shop["orders"]))[:2] == [(1, 10, D(2020, 1, 1), 12.0), (1, 11, D(2020, 1, 1), 12.0)]
    share = w.category_revenue_share(shop["products"], shop["lines"]).collect()
    assert sum(x.revenue_share for x in share) == pytest.approx(1.0)
    assert rows(w.employee_order_rank(shop["employees"], shop["orders"])) == [(100, 2, 1), (101, 2, 1)]
    assert rows(w.quantity_and_overall_average(shop["orders"], shop["lines"]))[0] == (10, 1.5, 1.625)


def test_grid(shop, spark):
    categories = spark.range(5).selectExpr("id as category_id", "concat('c', id) as category_name")
    assert j.product_category_grid(shop["products"], categories).count() == 15


def test_not_equal_drops_null(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert rows(f.filter_not_equal(df, "x", 1)) == [(2,)]
    ratio = f.derive_ratio(spark.createDataFrame([(1.0, 0.0)], "a double, b double"), "a", "b", "r")
    assert ratio.first().r is None


def test_view_and_frame_agree(shop):
    by_sql = r.sql_over_view(shop["orders"], "shop_orders_view", "select ship_via, count(*) as n from shop_orders_view group by 1")
    assert rows(by_sql) == rows(a.count_per(shop["orders"], "ship_via", out="n"))
