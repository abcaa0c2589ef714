"""Order header amounts from order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.functions.expressions import MONEY, round_money
from shopgrain.rules import TAX_RATE

AMOUNTS = ("subtotal_amount", "discount_amount", "tax_amount", "total_amount")


def order_amounts(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Replace the amounts of each order by those its lines add up to; no lines means zero.

    `orders` brings `order_id` and `shipping_amount`. Lines are added up per order before the
    join, so both sides have one row per order. All sums are exact decimals.
    """
    per_order = items.groupBy("order_id").agg(
        F.sum("line_total").alias("__net"),
        F.sum(F.col("unit_price") * F.col("quantity")).alias("__list"),
    )
    zero = F.lit(0).cast(MONEY)
    net, listed = F.coalesce("__net", zero), F.coalesce("__list", zero)
    tax = round_money(net * F.lit(TAX_RATE).cast("decimal(3,2)"))
    headers = orders.drop(*AMOUNTS)
    return headers.join(per_order, "order_id", "left").select(
        *headers.columns,
        round_money(net).alias("subtotal_amount"),
        round_money(F.greatest(listed - net, zero)).alias("discount_amount"),
        tax.alias("tax_amount"),
        round_money(net + F.col("shipping_amount") + tax).alias("total_amount"),
    )
