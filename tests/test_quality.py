from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from shopgrain.operators.latest import latest_per_key
from shopgrain.operators.quality import annotate, mark_orphans, split
from shopgrain.rules import CUSTOMERS, ORDER_ITEMS, ORDERS, PRODUCTS, REASON, Bounds
from shopgrain.runtime import written

CUSTOMER = (
    "customer_id bigint, email string, first_name string, last_name string, "
    "country_code string, customer_segment string"
)


def reasons(annotated, key):
    return {row[key]: row[REASON] for row in annotated.select(key, REASON).collect()}


def test_customer_rules(rows):
    frame = rows(
        CUSTOMER,
        (1, "a@x.test", "A", "B", "US", "standard"),
        (2, None, "A", "B", "US", "premium"),
        (3, "c@x.test", "A", "B", "US", "vip"),
        (4, "", "A", "B", "US", " budget "),
        (5, None, None, "B", "US", "vip"),
    )
    assert reasons(annotate(frame, CUSTOMERS), "customer_id") == {
        1: None,
        2: "null_email",
        3: "invalid_customer_segment",
        4: None,
        5: "null_email|null_first_name|invalid_customer_segment",
    }


def test_split_keeps_every_row(rows):
    frame = rows(CUSTOMER, (1, "a", "A", "B", "US", "standard"), (2, None, "A", "B", "US", "vip"))
    valid, rejected = split(annotate(frame, CUSTOMERS))
    assert [r.customer_id for r in valid.collect()] == [1]
    assert [r.customer_id for r in rejected.collect()] == [2]
    assert valid.schema[REASON].dataType.simpleString() == "string"


def test_order_item_limits(rows):
    ddl = (
        "order_item_id bigint, order_id bigint, product_id bigint, quantity int, "
        "unit_price decimal(12,2), discount_pct decimal(5,4), line_total decimal(14,2)"
    )
    frame = rows(ddl).sparkSession.sql(
        """select * from values
        (1L, 1L, 1L, 0, 1.00, 0.0, 1.00), (2L, 1L, 1L, 1, 1.00, 1.5, 1.00),
        (3L, 1L, 1L, 1, 0.00, -0.1, -1.00), (4L, 1L, 1L, 1, 1.00, null, 1.00),
        (5L, 1L, 1L, 1, 1.00, 1.0, 0.00)
        as t(order_item_id, order_id, product_id, quantity, unit_price, discount_pct, line_total)"""
    )
    assert reasons(annotate(frame, ORDER_ITEMS), "order_item_id") == {
        1: "below_min_exclusive_quantity",
        2: "above_max_discount_pct",
        3: "below_min_exclusive_unit_price|below_min_discount_pct|below_min_line_total",
        4: None,
        5: None,
    }


def test_negative_cost_and_missing_column(rows):
    ddl = "product_id bigint, sku string, product_name string, unit_price double, unit_cost double"
    frame = rows(ddl, (1, "s", "n", 1.0, -1.0), (2, "s", "n", 1.0, 0.0))
    assert reasons(annotate(frame, PRODUCTS), "product_id") == {
        1: "missing_category|below_min_unit_cost",
        2: "missing_category",
    }


def test_exclusive_upper_limit(rows):
    rules = replace(
        PRODUCTS, required=(), bounds=(Bounds("unit_price", max_exclusive=10, max_inclusive=20),)
    )
    frame = rows("product_id bigint, unit_price double", (1, 9.99), (2, 10.0), (3, 21.0))
    assert reasons(annotate(frame, rules), "product_id") == {
        1: None,
        2: "above_max_exclusive_unit_price",
        3: "above_max_unit_price|above_max_exclusive_unit_price",
    }


def _twice(rows, batches):
    one = ("a", "A", "B", "US", "standard")
    return rows(
        CUSTOMER + ", batch_id string", *[(key, *one, batch) for key, batch in batches]
    )


def test_duplicates_mark_all_copies(rows):
    frame = _twice(rows, [(1, "x"), (1, "x"), (2, "x")])
    found = [
        (r.customer_id, r[REASON]) for r in annotate(frame, CUSTOMERS).orderBy("customer_id").collect()
    ]
    assert found == [(1, "duplicate_customer_id"), (1, "duplicate_customer_id"), (2, None)]


def test_duplicate_scope(rows):
    frame = _twice(rows, [(1, "x"), (1, "y")])
    assert annotate(frame, CUSTOMERS).where(F.col(REASON).isNull()).count() == 2
    across = annotate(frame, CUSTOMERS, "all")
    assert {r[REASON] for r in across.collect()} == {"duplicate_customer_id"}
    with pytest.raises(ValueError):
        annotate(frame, CUSTOMERS, "week")


def test_null_keys_are_copies(rows):
    frame = _twice(rows, [(None, "x"), (None, "x"), (3, "x")])
    found = annotate(frame, CUSTOMERS, settle=lambda k: written(k, "keys")).collect()
    assert sorted(str(r[REASON]) for r in found) == [
        "None",
        "null_customer_id|duplicate_customer_id",
        "null_customer_id|duplicate_customer_id",
    ]


def test_orphans(rows):
    ddl = "order_id bigint, customer_id bigint, rejection_reason string"
    orders = rows(ddl, (1, 10, None), (2, 11, None), (3, None, None), (4, 11, "null_order_date"))
    known = rows("customer_id bigint", (10,), (10,))
    key = ORDERS.foreign_keys[0]
    assert reasons(mark_orphans(orders, key, known), "order_id") == {
        1: None,
        2: key.reason,
        3: key.reason,
        4: "null_order_date",
    }


def test_first_or_every_orphan(rows):
    items = rows(
        "order_item_id bigint, order_id bigint, product_id bigint, rejection_reason string",
        (1, 5, 6, None),
        (2, 5, 7, "null_quantity"),
    )
    nothing = rows("order_id bigint, product_id bigint")
    by_order, by_product = ORDER_ITEMS.foreign_keys
    first, every = items, items
    for key in (by_order, by_product):
        first = mark_orphans(first, key, nothing)
        every = mark_orphans(every, key, nothing, every_orphan=True)
    assert reasons(first, "order_item_id") == {1: by_order.reason, 2: "null_quantity"}
    assert reasons(every, "order_item_id") == {
        1: f"{by_order.reason}|{by_product.reason}",
        2: "null_quantity",
    }


def test_latest_per_key(rows):
    frame = rows(
        "customer_id bigint, email string, ingested_at string, batch_id string",
        (1, "old", "2024-01-01", "b"),
        (1, "new", "2024-01-02", "a"),
        (2, "low", "2024-01-01", "a"),
        (2, "high", "2024-01-01", "b"),
        (3, "known", None, "z"),
        (3, "dated", "2024-01-01", "a"),
    )
    latest = {r.customer_id: r.email for r in latest_per_key(frame, ["customer_id"]).collect()}
    assert latest == {1: "new", 2: "high", 3: "dated"}
    assert latest_per_key(frame, ["customer_id"]).columns == frame.columns


def test_latest_falls_back_to_processing_time(rows):
    frame = rows("k bigint, v string, processed_at string", (1, "a", "1"), (1, "b", "2"))
    assert latest_per_key(frame, ["k"]).first().v == "b"
