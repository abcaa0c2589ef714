"""Hand-computed values of the curated tables for a small seed."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shopgrain.operators.amounts import order_amounts
from shopgrain.plans import dims, facts, marts, sqlmodels
from shopgrain.rules import LOADED_AT, TABLES


@pytest.fixture(scope="module")
def seed(spark):
    """Three customers in two countries, one of them returning; two products; a refund, a
    cancellation and an order without lines."""
    make = spark.createDataFrame
    customers = make(
        [
            (7, "ida@shop.test", "Ida", "Berg", "NO", "Norway", "Bergen", "premium", "2023-05-04", True),
            (8, "ole@shop.test", "Ole", "Dahl", "NO", "Norway", "Oslo", "premium", "2023-06-01", False),
            (9, "pia@shop.test", "Pia", "Holm", "DK", "Denmark", "Aarhus", "budget", "2023-07-30", True),
        ],
        "customer_id bigint, email string, first_name string, last_name string, "
        "country_code string, country_name string, city string, customer_segment string, "
        "signup_date string, is_active boolean",
    )
    products = make(
        [
            (31, "T-31", "Teapot", "kitchen", "tea", "Kanne", 24.5, 11.0, True),
            (32, "C-32", "Cup", "kitchen", "tea", "Kanne", 6.0, 2.0, True),
        ],
        "product_id bigint, sku string, product_name string, category string, subcategory string, "
        "brand string, unit_price double, unit_cost double, is_active boolean",
    )
    orders = make(
        [
            (1, 7, "2023-11-30T23:10:00Z", "completed", "NO", 55.0, 0.0, 5.0, 4.4, 64.4),
            (2, 7, "2023-12-02T08:00:00Z", "completed", "NO", 24.5, 0.0, 5.0, 1.96, 31.46),
            (3, 8, "2023-12-02T09:30:00Z", "refunded", "NO", 12.0, 0.0, 5.0, 0.96, 17.96),
            (4, 9, "2023-12-05T12:00:00Z", "cancelled", "DK", 6.0, 0.0, 5.0, 0.48, 11.48),
            (5, 9, "2023-12-05T13:00:00Z", "completed", "DK", 0.0, 0.0, 5.0, 0.0, 5.0),
        ],
        "order_id bigint, customer_id bigint, order_date string, order_status string, "
        "shipping_country string, subtotal_amount double, discount_amount double, "
        "shipping_amount double, tax_amount double, total_amount double",
    )
    items = make(
        [
            (11, 1, 31, 2, 24.5, 0.0, 49.0), (12, 1, 32, 1, 6.0, 0.0, 6.0),
            (21, 2, 31, 1, 24.5, 0.0, 24.5), (31, 3, 32, 2, 6.0, 0.0, 12.0),
            (41, 4, 32, 1, 6.0, 0.0, 6.0),
        ],
        "order_item_id bigint, order_id bigint, product_id bigint, quantity int, "
        "unit_price double, discount_pct double, line_total double",
    )
    payments = make(
        [
            (91, 1, "2023-11-30T23:20:00Z", "gift_card", "succeeded", 64.4),
            (92, 2, "2023-12-02T08:05:00Z", "debit_card", "failed", 31.46),
            (93, 2, "2023-12-02T08:09:00Z", "debit_card", "succeeded", 31.46),
            (94, 3, "2023-12-02T09:31:00Z", "paypal", "refunded", 17.96),
            (95, 4, "2023-12-05T12:01:00Z", "paypal", "failed", 11.48),
        ],
        "payment_id bigint, order_id bigint, payment_date string, payment_method string, "
        "payment_status string, amount double",
    )
    return {
        "dim_date": dims.calendar(spark, "2023-11-01", "2023-12-31"),
        "dim_country": dims.dim_country(customers),
        "dim_customers": dims.dim_customers(customers),
        "dim_products": dims.dim_products(products),
        "fct_orders": facts.fct_orders(orders),
        "fct_order_items": facts.fct_order_items(items),
        "fct_payments": facts.fct_payments(payments),
    }


@pytest.fixture(scope="module")
def tables(seed):
    s = seed
    return s | {
        "mart_daily_sales": marts.mart_daily_sales(s["fct_orders"], s["fct_payments"]),
        "mart_monthly_revenue": marts.mart_monthly_revenue(s["fct_orders"]),
        "mart_customer_lifetime_value": marts.mart_customer_lifetime_value(s["fct_orders"]),
        "mart_product_performance": marts.mart_product_performance(
            s["fct_order_items"], s["dim_products"], s["fct_orders"]
        ),
        "mart_customer_segments": marts.mart_customer_segments(
            s["fct_orders"], s["dim_customers"]
        ),
    }


def values(frame, *order):
    plain = frame.drop(LOADED_AT)
    return [
        tuple(
            str(v) if hasattr(v, "year") else float(v) if hasattr(v, "as_tuple")
            else round(v, 6) if isinstance(v, float) else v for v in r
        )
        for r in plain.orderBy(*order).collect()
    ]


def test_columns_and_counts(tables):
    assert {name: tuple(frame.columns) for name, frame in tables.items()} == {
        name: contract.columns for name, contract in TABLES.items()
    }
    counts = {name: frame.count() for name, frame in tables.items()}
    assert counts == {
        "dim_date": 61, "dim_country": 2, "dim_customers": 3, "dim_products": 2, "fct_orders": 5,
        "fct_order_items": 5, "fct_payments": 5, "mart_daily_sales": 3, "mart_monthly_revenue": 2,
        "mart_customer_lifetime_value": 3, "mart_product_performance": 2, "mart_customer_segments": 2,
    }


def test_daily_sales(tables):
    # Gross revenue counts completed and refunded orders alike, net revenue completed ones.
    assert values(tables["mart_daily_sales"], "sale_date") == [
        ("2023-11-30", 64.4, 64.4, 1, 0, 0, 0, 1, 64.4, 0.0, 0.0),
        ("2023-12-02", 49.42, 31.46, 2, 0, 1, 1, 3, 15.73, 0.333333, 0.0),
        ("2023-12-05", 5.0, 5.0, 2, 1, 0, 1, 1, 2.5, 1.0, 0.5),
    ]


def test_monthly_revenue(tables):
    assert values(tables["mart_monthly_revenue"], "year_month") == [
        ("2023-11", 64.4, 64.4, 1, 1, 1, 0, 64.4),
        ("2023-12", 54.42, 36.46, 4, 3, 2, 1, 9.115),
    ]


def test_lifetime_value(tables):
    shown = tables["mart_customer_lifetime_value"].drop("first_order_date", "last_order_date")
    assert values(shown, "customer_key") == [
        (7, 2, 95.86, 95.86, 47.93, 1.0),
        (8, 1, 17.96, 0.0, 0.0, 0.0),
        (9, 2, 5.0, 5.0, 2.5, 1.0),
    ]


def test_product_performance(tables):
    assert values(tables["mart_product_performance"], "product_id") == [
        (31, "kitchen", "tea", "Teapot", 3, 73.5, 73.5, 2, 24.5),
        (32, "kitchen", "tea", "Cup", 4, 24.0, 6.0, 3, 1.5),
    ]


def test_segments(tables):
    assert values(tables["mart_customer_segments"], "customer_segment") == [
        ("budget", "DK", "Denmark", 1, 5.0, 5.0, 2, 1, 1, 1, 1, 2.5, 1.0, 0.5),
        ("premium", "NO", "Norway", 2, 113.82, 95.86, 3, 0, 2, 1, 2, 31.953333, 0.5, 0.0),
    ]


def test_sql_models_agree(spark, tables):
    names = sqlmodels.create_views(spark, tables)
    assert len(names) == 18
    for name in sqlmodels.MARTS:
        built = tables[name.removeprefix("sql_")].drop(LOADED_AT)
        modelled = spark.table(name).select(*built.columns)
        assert built.exceptAll(modelled).isEmpty() and modelled.exceptAll(built).isEmpty()


def test_dates(tables):
    rows = {str(r.full_date): r for r in dims.calendar(
        tables["dim_date"].sparkSession, "2020-12-28", "2021-01-05").collect()}
    new_year = rows["2021-01-01"]
    assert (new_year.date_key, new_year.week_of_year, new_year.day_of_week) == (20210101, 53, 5)
    assert (new_year.month_name, new_year.day_name, new_year.quarter) == ("January", "Friday", 1)
    assert rows["2021-01-02"].is_weekend and not rows["2021-01-04"].is_weekend


def test_default_calendar(spark):
    assert dims.dim_date(spark).count() == 1461


def test_unreadable_dates_and_null_status(rows):
    orders = rows(
        "order_id bigint, customer_id bigint, order_date string, order_status string, "
        "shipping_country string, subtotal_amount double, discount_amount double, "
        "shipping_amount double, tax_amount double, total_amount double",
        (1, 1, "not a date", None, "US", 1.0, 0.0, 0.0, 0.0, 5.0),
        (2, 1, "2024-03-01 00:00:00", "refunded", "US", 1.0, 0.0, 0.0, 0.0, 5.0),
    )
    bad, refunded = facts.fct_orders(orders).orderBy("order_key").collect()
    assert bad.order_timestamp is None and bad.order_date_key is None
    assert bad.is_completed is None and bad.gross_revenue == 0 and bad.net_revenue == 0
    assert refunded.order_date_key == 20240301
    assert refunded.gross_revenue == 5 and refunded.net_revenue == 0


def test_new_and_returning_customers(rows):
    ddl = ("order_key bigint, customer_key bigint, order_timestamp timestamp_ntz, "
           "gross_revenue decimal(18,2), net_revenue decimal(18,2)")
    day = [datetime(2024, m, 5) for m in range(1, 5)]
    orders = rows(ddl).sparkSession.createDataFrame(
        [(1, 1, day[0]), (2, 1, day[0]), (3, 1, day[1]), (4, 2, day[1]), (5, None, day[1]),
         (6, 3, None)],
        "order_key bigint, customer_key bigint, order_timestamp timestamp_ntz",
    ).withColumns({n: F.lit(1).cast("decimal(18,2)") for n in ("gross_revenue", "net_revenue")})
    got = {
        r.year_month: (r.order_count, r.monthly_active_customers, r.new_customers, r.returning_customers)
        for r in marts.mart_monthly_revenue(orders).collect()
    }
    assert got == {"2024-01": (2, 1, 1, 0), "2024-02": (3, 2, 1, 1), None: (1, 1, 0, 0)}


def test_segment_code_with_two_names(rows):
    orders = rows("order_key bigint, customer_key bigint", (1, 1), (2, 1), (3, 2), (4, 3)).withColumns(
        {
            "gross_revenue": F.lit(1).cast("decimal(18,2)"),
            "net_revenue": F.lit(1).cast("decimal(18,2)"),
            "is_cancelled": F.lit(False),
        }
    )
    customers = rows(
        "customer_key bigint, customer_segment string, country_code string, country_name string",
        (1, "budget", "XX", "Old"), (2, "budget", "XX", "New"), (3, None, "XX", "New"),
    )
    got = {
        (r.customer_segment, r.country_name): (r.repeat_customers, r.customers_with_orders)
        for r in marts.mart_customer_segments(orders, customers).collect()
    }
    assert got == {("budget", "Old"): (1, 2), ("budget", "New"): (1, 2), (None, "New"): (0, 0)}


def test_payments_without_orders_are_left_out(tables):
    late = tables["fct_payments"].withColumn(
        "payment_timestamp", F.col("payment_timestamp") + F.expr("interval 9 days")
    )
    daily = marts.mart_daily_sales(tables["fct_orders"], late)
    assert {r.payment_attempt_count for r in daily.collect()} == {0}
    assert {r.payment_failure_rate for r in daily.collect()} == {0.0}


def test_order_amounts(rows):
    orders = rows("order_id bigint, shipping_amount double, total_amount double",
                  (1, 10.46, 0.0), (2, 3.0, 9.0))
    orders = orders.withColumn("shipping_amount", F.col("shipping_amount").cast("decimal(18,2)"))
    items = rows("order_id bigint, quantity int, unit_price double, line_total double",
                 (1, 2, 142.44, 284.88))
    items = items.withColumns({n: F.col(n).cast("decimal(18,2)") for n in ("unit_price", "line_total")})
    got = {r.order_id: tuple(float(v) for v in r[1:]) for r in order_amounts(orders, items).collect()}
    assert got == {1: (10.46, 284.88, 0.0, 22.79, 318.13), 2: (3.0, 0.0, 0.0, 0.0, 3.0)}
