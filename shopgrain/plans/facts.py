"""Facts. Money stays an exact decimal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.functions.expressions import (
    MONEY,
    date_key,
    loaded_now,
    moment,
    money_if,
    status_in,
)
from shopgrain.rules import LOADED_AT, TABLES, BusinessRules

_HEADER_AMOUNTS = (
    "subtotal_amount",
    "discount_amount",
    "shipping_amount",
    "tax_amount",
    "total_amount",
)


def fct_orders(
    orders: DataFrame, rules: BusinessRules = BusinessRules(), keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per order. A refunded order counts in gross revenue but not in net revenue. `keep`
    names further columns to go along."""
    placed, status = moment(orders, "order_date"), F.col("order_status")
    total = F.col("total_amount").cast(MONEY)
    completed = status_in(status, rules.completed)
    refunded = status_in(status, rules.refunded)
    return orders.select(
        F.col("order_id").alias("order_key"),
        F.col("customer_id").alias("customer_key"),
        date_key(placed).alias("order_date_key"),
        placed.alias("order_timestamp"),
        status,
        "shipping_country",
        *[F.col(name).cast(MONEY).alias(name) for name in _HEADER_AMOUNTS],
        completed.alias("is_completed"),
        status_in(status, rules.cancelled).alias("is_cancelled"),
        refunded.alias("is_refunded"),
        money_if(completed | refunded, total).alias("gross_revenue"),
        money_if(completed, total).alias("net_revenue"),
        loaded_now().alias(LOADED_AT),
        *keep,
    )


def fct_order_items(order_items: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    renamed = order_items.withColumnsRenamed(
        {"order_item_id": "order_item_key", "order_id": "order_key", "product_id": "product_key"}
    )
    typed = renamed.withColumns(
        {
            "quantity": F.col("quantity").cast("int"),
            "line_total": F.col("line_total").cast(MONEY),
            LOADED_AT: loaded_now(),
        }
    )
    return typed.select(*TABLES["fct_order_items"].columns, *keep)


def fct_payments(
    payments: DataFrame, rules: BusinessRules = BusinessRules(), keep: tuple[str, ...] = ()
) -> DataFrame:
    paid, status = moment(payments, "payment_date"), F.col("payment_status")
    return payments.select(
        F.col("payment_id").alias("payment_key"),
        F.col("order_id").alias("order_key"),
        date_key(paid).alias("payment_date_key"),
        paid.alias("payment_timestamp"),
        "payment_method",
        status,
        F.col("amount").cast(MONEY).alias("amount"),
        status_in(status, rules.payment_succeeded).alias("is_successful"),
        status_in(status, rules.payment_failed).alias("is_failed"),
        loaded_now().alias(LOADED_AT),
        *keep,
    )
