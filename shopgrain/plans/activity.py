"""Active customers of any period, from exact bitmaps per day and segment.

A day's customers are bits of bitmaps, one for each range of 32,768 customer numbers. Bitmaps of
several days are combined by OR, so a customer who comes back counts once, and no order is read
again for another period. The bitmaps of one segment and range meet once, in order of their days, and
every window slides over them there: what moves is a bitmap for each day, whatever the windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.operators.lookup import lookup_join

_GROUP = ("activity_date", "customer_segment", "bucket")


def daily_bitmaps(
    fct_orders: DataFrame, dim_customers: DataFrame, under: str | None = None
) -> DataFrame:
    """(activity_date, customer_segment, bucket, customers): who ordered on a day, as bitmaps.

    Worth keeping as a table: a new day adds rows and changes none. Customer keys must be whole
    numbers. Orders without a date, a customer or a known customer take no part.
    """
    days = fct_orders.select(
        "customer_key", F.col("order_timestamp").cast("date").alias("activity_date")
    ).where("customer_key is not null and activity_date is not null")
    known = dim_customers.select("customer_key", "customer_segment")
    placed = lookup_join(days, known, ["customer_key"], under=under).withColumn(
        "bucket", F.bitmap_bucket_number("customer_key")
    )
    # Orders are dealt by group first: a bitmap, 4 KB however few its bits, is built once and complete
    # instead of once in every task that meets its group.
    return placed.repartition(*_GROUP).groupBy(*_GROUP).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("customer_key")).alias("customers")
    )


def active_customers(bitmaps: DataFrame, windows: tuple[int, ...] = (7, 30, 90)) -> DataFrame:
    """(activity_date, customer_segment, window_days, active_customers): customers with an order in
    the `window_days` days that end with the date.

    Dates without any are left out; dates go on to the last day with an order.
    """
    spans = sorted(set(windows))
    if spans[0] < 1:
        raise ValueError("a window has at least one day")
    last = bitmaps.agg(F.unix_date(F.max("activity_date")).alias("last"))
    group = Window.partitionBy("customer_segment", "bucket").orderBy("day")
    after = F.lead("day").over(group)
    # Days on which the group has no bitmap, as far as the longest window reaches into them.
    until = F.least(F.col("after") - 1, F.col("day") + spans[-1] - 1, F.col("last"))
    days = (
        bitmaps.where(F.col("activity_date").isNotNull())
        .select(F.unix_date("activity_date").alias("day"), *_GROUP[1:], "customers")
        .withColumn("after", after)
        .join(F.broadcast(last))
        .select(
            F.explode(F.sequence("day", F.greatest("day", until))).alias("at"), *_GROUP[1:],
            F.col("day").alias("from_day"), "customers",
            # Of several bitmaps of a day, one shows the day.
            (~F.col("after").eqNullSafe(F.col("day"))).alias("shown"),
        )
        .select(
            F.col("at").alias("day"), *_GROUP[1:], "shown",
            F.when(F.col("at") == F.col("from_day"), F.col("customers")).alias("customers"),
        )
    )
    active = {
        span: F.bitmap_count(F.bitmap_or_agg("customers").over(group.rangeBetween(1 - span, 0)))
        for span in spans
    }
    counted = days.select(
        "day", "customer_segment", "shown",
        F.array(*[
            F.struct(F.lit(span).alias("window_days"), count.alias("active_customers"))
            for span, count in active.items()
        ]).alias("counts"),
    ).where("shown")
    return (
        counted.select(
            F.date_from_unix_date("day").alias("activity_date"), "customer_segment",
            F.inline("counts"),
        )
        .where("active_customers > 0")
        .groupBy("activity_date", "customer_segment", "window_days")
        .agg(F.sum("active_customers").alias("active_customers"))
    )
