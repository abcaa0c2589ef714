"""Random tables against plain Python, with a hot key that holds a third of the rows and nulls."""

import random
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopgrain.operators import lookup as lk
from shopgrain.operators.latest import latest_per_key
from shopgrain.operators.quality import annotate, mark_orphans
from shopgrain.plans import facts, marts
from shopgrain.rules import ORDERS, REASON
from shopgrain.runtime import written
from shopgrain.sources import snapshots

STATUSES = ["completed", "cancelled", "refunded", "pending", "failed", "lost", None]
ORDER_DDL = (
    "order_id bigint, customer_id bigint, order_date timestamp_ntz, order_status string, "
    "shipping_country string, subtotal_amount decimal(14,2), discount_amount decimal(14,2), "
    "shipping_amount decimal(14,2), tax_amount decimal(14,2), total_amount decimal(14,2)"
)


def amount(rng, low=-5.0):
    return None if rng.random() < 0.05 else Decimal(f"{rng.uniform(low, 100):.2f}")


def random_orders(seed, count=2000, unique=False):
    rng = random.Random(seed)
    rows = []
    for number in range(count):
        order = number if unique or rng.random() < 0.9 else rng.choice([None, 7, 8])
        customer = 1 if rng.random() < 0.34 else rng.choice([None, *range(2, 120)])
        placed = datetime(2023, 1, 1) + timedelta(hours=rng.randrange(0, 24 * 500))
        rows.append(
            (
                order, customer, None if rng.random() < 0.03 else placed, rng.choice(STATUSES), "US",
                *[amount(rng, -1.0) for _ in range(4)], amount(rng),
            )
        )
    return rows


def expected_reason(row, copies, known):
    order, customer, placed, status, _, subtotal, discount, shipping, tax, total = row
    reasons = []
    for name, value in (("order_id", order), ("customer_id", customer), ("order_date", placed),
                        ("order_status", status), ("total_amount", total)):
        if value is None:
            reasons.append(f"null_{name}")
    if status == "lost":
        reasons.append("invalid_order_status")
    for name, value in (("subtotal", subtotal), ("discount", discount), ("shipping", shipping),
                        ("tax", tax), ("total", total)):
        if value is not None and value < 0:
            reasons.append(f"below_min_{name}_amount")
    if copies[order] > 1:
        reasons.append("duplicate_order_id")
    if not reasons and customer not in known:
        reasons.append("orphan_customer_id_references_customers.customer_id")
    return "|".join(reasons) or None


@pytest.mark.parametrize("broadcast", [True, False])
def test_reasons(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(lk, "fits_broadcast", lambda frame: False)
    rows, known = random_orders(1), set(range(1, 100))
    copies = defaultdict(int)
    for row in rows:
        copies[row[0]] += 1
    orders = spark.createDataFrame(rows, ORDER_DDL)
    parents = spark.createDataFrame([(k,) for k in known], "customer_id bigint")
    keep = lambda keys: written(keys, "keys")
    marked = mark_orphans(
        annotate(orders, ORDERS, settle=keep), ORDERS.foreign_keys[0], parents, key_source=orders,
        settle=keep,
    )
    columns = orders.columns
    got = sorted(str((*[r[c] for c in columns], r[REASON])) for r in marked.collect())
    want = sorted(str((*row, expected_reason(row, copies, known))) for row in rows)
    assert got == want


def test_latest(spark):
    rng = random.Random(2)
    rows = [
        (1 if rng.random() < 0.34 else rng.randrange(2, 50),
         rng.choice([None, "2024-01-01", "2024-01-02", "2024-01-03"]), rng.choice("abc"), n)
        for n in range(1500)
    ]
    frame = spark.createDataFrame(rows, "k bigint, ingested_at string, batch_id string, n bigint")
    best = {}
    for row in rows:
        rank = (row[1] or "", row[2], row[3])
        if row[0] not in best or rank > best[row[0]][0]:
            best[row[0]] = (rank, row)
    got = sorted(map(str, map(tuple, latest_per_key(frame, ["k"]).collect())))
    assert got == sorted(str(row) for _, row in best.values())


def test_marts(spark):
    rows = random_orders(3, unique=True)
    orders = facts.fct_orders(spark.createDataFrame(rows, ORDER_DDL)).cache()
    first, by_month, by_customer = {}, defaultdict(list), defaultdict(list)
    for row in rows:
        _, customer, placed, status, *_, total = row
        month = placed and placed.strftime("%Y-%m")
        earned = (total if status in ("completed", "refunded") else Decimal(0),
                  total if status == "completed" else Decimal(0))
        by_month[month].append((customer, earned))
        by_customer[customer].append((placed, earned))
        if placed and customer is not None:
            first[customer] = min(first.get(customer, month), month)

    def total(pairs, side):
        known = [earned[side] for _, earned in pairs if earned[side] is not None]
        return sum(known) if known else None

    monthly = {r.year_month: r for r in marts.mart_monthly_revenue(orders).collect()}
    assert set(monthly) == set(by_month)
    for month, pairs in by_month.items():
        active = {c for c, _ in pairs if c is not None}
        new = {c for c in active if month and first.get(c) == month}
        old = {c for c in active if month and first.get(c, month) != month}
        row = monthly[month]
        assert (row.gross_revenue, row.net_revenue) == (total(pairs, 0), total(pairs, 1))
        assert (row.order_count, row.monthly_active_customers) == (len(pairs), len(active))
        assert (row.new_customers, row.returning_customers) == (len(new), len(old))

    lifetime = {r.customer_key: r for r in marts.mart_customer_lifetime_value(orders).collect()}
    assert set(lifetime) == set(by_customer)
    for customer, pairs in by_customer.items():
        row, dates = lifetime[customer], [d for d, _ in pairs if d]
        assert row.total_orders == len(pairs) and row.net_revenue == total(pairs, 1)
        assert (row.first_order_date, row.last_order_date) == (min(dates), max(dates))
        assert row.repeat_purchase_rate == float(len(pairs) > 1)
    orders.unpersist()


@pytest.mark.parametrize("broadcast", [True, False])
def test_product_performance(spark, monkeypatch, broadcast):
    """One order holds a third of the lines, one product another third, with repeated pairs."""
    if not broadcast:
        monkeypatch.setattr(lk, "fits_broadcast", lambda frame: False)
    rng = random.Random(4)
    lines = [
        (n, 1 if rng.random() < 0.34 else rng.randrange(2, 300),
         1 if rng.random() < 0.34 else rng.randrange(2, 60), rng.randrange(0, 9),
         Decimal(f"{rng.uniform(0, 50):.2f}"))
        for n in range(3000)
    ]
    done = {key: rng.random() < 0.5 for key in range(1, 250)}  # later orders are unknown
    items = spark.createDataFrame(
        lines, "order_item_key bigint, order_key bigint, product_key bigint, quantity int, "
               "line_total decimal(18,2)")
    orders = spark.createDataFrame(list(done.items()), "order_key bigint, is_completed boolean")
    products = spark.createDataFrame(
        [(k, k, "c", "s", f"p{k}") for k in range(1, 50)],
        "product_key bigint, product_id bigint, category string, subcategory string, "
        "product_name string")
    want = defaultdict(lambda: [0, Decimal(0), Decimal(0), set()])
    for _, order, product, quantity, price in lines:
        if order in done and product < 50:
            entry = want[product]
            entry[0] += quantity
            entry[1] += price
            entry[2] += price if done[order] else 0
            entry[3].add(order)
    got = marts.mart_product_performance(items, products, orders).collect()
    assert {
        r.product_id: [r.total_quantity_sold, r.gross_revenue, r.net_revenue, r.order_count]
        for r in got
    } == {k: [q, g, n, len(o)] for k, (q, g, n, o) in want.items()}


@pytest.mark.parametrize("month_of", ["d", None])
def test_upserts_against_a_dict(spark, tmp_path, month_of):
    rng, state, path = random.Random(5), {}, str(tmp_path / "t")
    for step in range(4):
        batch = {
            rng.randrange(0, 60): (f"2024-0{rng.randrange(1, 5)}-11", step) for _ in range(25)
        }
        state |= batch
        rows = [(k, *v) for k, v in batch.items()]
        source = written(spark.createDataFrame(rows, "k bigint, d string, v int"), "batch")
        snapshots.upsert(source, path, ["k"], month_of=month_of)
        stored = snapshots.read_snapshot(spark, path).select("k", "d", "v").collect()
        assert {r.k: (r.d, r.v) for r in stored} == state and len(stored) == len(state)
    assert bool(snapshots.months(spark, path)) == (month_of == "d")


def test_null_and_hot_foreign_keys_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(lk, "fits_broadcast", lambda frame: False)
    orders = facts.fct_orders(spark.createDataFrame(random_orders(6, unique=True), ORDER_DDL))
    customers = spark.range(1, 80).select(
        F.col("id").alias("customer_key"), F.lit("s").alias("customer_segment"),
        F.lit("XX").alias("country_code"), F.lit("X").alias("country_name"),
        F.lit("c").alias("city"),
    )
    joined = marts.orders_enriched(orders, customers)
    assert joined.count() == orders.where("customer_key between 1 and 79").count()
