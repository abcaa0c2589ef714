"""Gold brought up to date by months equals gold built anew, whatever changed."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopgrain.plans import dims, facts, increments, marts
from shopgrain.rules import LOADED_AT, MONTH_OF
from shopgrain.sources import snapshots

ORDERS = ("order_id long, customer_id long, order_date timestamp, order_status string, shipping_country string, "
          "subtotal_amount decimal(18,2), discount_amount decimal(18,2), shipping_amount decimal(18,2), "
          "tax_amount decimal(18,2), total_amount decimal(18,2)")
ITEMS = ("order_item_id long, order_id long, product_id long, quantity int, unit_price double, "
         "discount_pct decimal(5,4), line_total decimal(18,2), created_at timestamp")
PAYMENTS = "payment_id long, order_id long, payment_date timestamp, payment_method string, payment_status string, amount decimal(18,2)"


def moment(rng):
    return rng.choice([None, *[datetime(2024, m, rng.randint(1, 28), 9) for m in (1, 2, 3, 4)]])


def order(rng, key):
    amount = Decimal(rng.randint(100, 999)) / 100
    return (key, rng.choice([None, 1, 2, 3]), moment(rng),
            rng.choice(["completed", "refunded", "cancelled", "pending"]), "N01",
            amount, Decimal(0), Decimal(0), Decimal(0), amount)


def item(rng, key):
    return (key, rng.randint(1, 14), rng.choice([1, 2, None]), rng.randint(1, 5), 1.0, Decimal(0),
            Decimal(rng.randint(1, 500)) / 100, moment(rng))


def payment(rng, key):
    return (key, key, moment(rng), "paypal", rng.choice(["failed", "succeeded"]), Decimal(1))


@pytest.fixture(scope="module")
def dimensions(spark):
    customers = spark.createDataFrame(
        [(k, f"{k}@x", "a", "b", "N01", "Land", "City", s, None, True) for k, s in ((1, "budget"), (2, "premium"), (3, None))],
        "customer_id long, email string, first_name string, last_name string, country_code string, country_name string, "
        "city string, customer_segment string, signup_date date, is_active boolean")
    products = spark.createDataFrame(
        [(k, "s", f"p{k}", "c", "d", "b", Decimal(1), Decimal(1), True) for k in (1, 2)],
        "product_id long, sku string, product_name string, category string, subcategory string, brand string, "
        "unit_price decimal(12,2), unit_cost decimal(12,2), is_active boolean")
    return {"dim_customers": dims.dim_customers(customers), "dim_products": dims.dim_products(products)}


def anew(spark, places, dimensions):
    silver = {e: snapshots.read_snapshot(spark, places.silver(e)) for e in increments.FACTS.values()}
    orders, items = facts.fct_orders(silver["orders"]), facts.fct_order_items(silver["order_items"])
    payments = facts.fct_payments(silver["payments"])
    return {
        "fct_orders": orders, "fct_order_items": items, "fct_payments": payments,
        "mart_daily_sales": marts.mart_daily_sales(orders, payments),
        "mart_monthly_revenue": marts.mart_monthly_revenue(orders),
        "mart_customer_lifetime_value": marts.mart_customer_lifetime_value(orders),
        "mart_product_performance": marts.mart_product_performance(items, dimensions["dim_products"], orders),
        "mart_customer_segments": marts.mart_customer_segments(orders, dimensions["dim_customers"]),
    }


def rows_of(frame):
    shown = sorted(c for c in frame.columns if c != LOADED_AT)
    return sorted(str(tuple(r)) for r in frame.select(*shown).collect())


def places_in(folder):
    return increments.Places(lambda e: f"{folder}/silver/{e}", lambda t: f"{folder}/gold/{t}", f"{folder}/gold/state")


def put(spark, places, entity, ddl, rows):
    key = ddl.split()[0]
    snapshots.upsert(spark.createDataFrame(rows, ddl), places.silver(entity), [key], verify=False,
                     month_of=MONTH_OF[entity])


@pytest.mark.parametrize("seed", [1, 2])
def test_any_change_equals_a_rebuild(spark, tmp_path, dimensions, seed):
    rng, places = random.Random(seed), places_in(tmp_path)
    put(spark, places, "orders", ORDERS, [order(rng, k) for k in range(1, 11)])
    put(spark, places, "order_items", ITEMS, [item(rng, k) for k in range(30)])
    put(spark, places, "payments", PAYMENTS, [payment(rng, k) for k in range(1, 11)])
    increments.refresh(spark, places, dimensions, str(tmp_path / "staged0"))
    for step in (1, 2):
        # Some orders change in any way, orders that lines were waiting for arrive.
        put(spark, places, "orders", ORDERS, [order(rng, k) for k in (2, 5, 10 + step)])
        if step == seed:
            put(spark, places, "order_items", ITEMS, [item(rng, k) for k in (3, 40)])
            put(spark, places, "payments", PAYMENTS, [payment(rng, 4)])
        increments.refresh(spark, places, dimensions, str(tmp_path / f"staged{step}"))
        for name, frame in anew(spark, places, dimensions).items():
            assert rows_of(snapshots.read_snapshot(spark, places.gold(name))) == rows_of(frame), name


def test_only_touched_months_are_read_and_written(spark, tmp_path, dimensions):
    rng, places = random.Random(3), places_in(tmp_path)
    rows = [order(rng, k) for k in range(1, 13)]
    rows = [(r[0], r[1], datetime(2024, 1 + r[0] % 4, 5), *r[3:]) for r in rows]
    put(spark, places, "orders", ORDERS, rows)
    put(spark, places, "order_items", ITEMS, [item(rng, k) for k in range(20)])
    put(spark, places, "payments", PAYMENTS, [payment(rng, k) for k in range(1, 5)])
    tables, touched = increments.refresh(spark, places, dimensions, str(tmp_path / "s0"))
    before = snapshots.month_parts(spark, places.gold("fct_orders"))
    assert touched["orders"] == set(before) == {f"m2024-0{m}" for m in (1, 2, 3, 4)}
    moved = [(r[0], r[1], r[2] + timedelta(days=31), *r[3:]) for r in rows if r[0] % 4 == 1]
    put(spark, places, "orders", ORDERS, moved)  # all orders of February move to March
    _, touched = increments.refresh(spark, places, dimensions, str(tmp_path / "s1"))
    assert touched == {"orders": {"m2024-02", "m2024-03"}, "order_items": set(), "payments": set()}
    now = snapshots.month_parts(spark, places.gold("fct_orders"))
    assert {m: f for m, f in now.items() if m != "m2024-03"} == {
        m: f for m, f in before.items() if m not in ("m2024-02", "m2024-03")}
    monthly = snapshots.read_snapshot(spark, places.gold("mart_monthly_revenue"))
    assert sorted(r.year_month for r in monthly.collect()) == ["2024-01", "2024-03", "2024-04"]
    files = snapshots.read_months(spark, places.gold("fct_orders"), touched["orders"]).inputFiles()
    assert files and all("state_month=m2024-03" in name for name in files)
    # Nothing changed: nothing is touched. A table replaced by another run is made anew.
    assert not any(increments.refresh(spark, places, dimensions, str(tmp_path / "s2"))[1].values())
    snapshots.overwrite(tables["fct_payments"].limit(1), places.gold("fct_payments"))
    _, touched = increments.refresh(spark, places, dimensions, str(tmp_path / "s3"))
    assert touched["orders"] == {"m2024-01", "m2024-03", "m2024-04"}
    for name, frame in anew(spark, places, dimensions).items():
        assert rows_of(snapshots.read_snapshot(spark, places.gold(name))) == rows_of(frame), name
