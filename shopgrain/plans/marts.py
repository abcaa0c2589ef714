"""Business marts.

Every mart aggregates before it joins or counts distinct values: rows are combined on the map side
down to one per (customer, month), (order, product) or customer, so that neither a hot customer nor
a hot product meets in one task, and `count(distinct ...)` becomes a plain count of groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.functions.expressions import (
    count_where,
    loaded_now,
    month_number,
    month_text,
    ratio,
)
from shopgrain.operators.lookup import lookup_join
from shopgrain.rules import LOADED_AT, TABLES
from shopgrain.runtime import tasks_for


def _finish(table: str, frame: DataFrame, **computed: Column) -> DataFrame:
    return frame.withColumns({**computed, LOADED_AT: loaded_now()}).select(*TABLES[table].columns)


def _revenue() -> list[Column]:
    return [F.sum(name).alias(name) for name in ("gross_revenue", "net_revenue")]


def mart_daily_sales(fct_orders: DataFrame, fct_payments: DataFrame) -> DataFrame:
    """Sales, cancellations and payment failures per order day.

    Payments on a day without orders have no row to go to.
    """
    sales = orders_daily(fct_orders)
    return _finish(
        "mart_daily_sales",
        sales.join(payments_daily(fct_payments), "sale_date", "left").fillna(
            0, ["payment_failure_count", "payment_attempt_count"]
        ),
        average_order_value=ratio(F.col("net_revenue"), F.col("order_count")),
        payment_failure_rate=ratio(
            F.col("payment_failure_count"), F.col("payment_attempt_count")
        ),
        cancellation_rate=ratio(F.col("cancelled_order_count"), F.col("order_count")),
    )


def orders_daily(fct_orders: DataFrame) -> DataFrame:
    return fct_orders.groupBy(F.col("order_timestamp").cast("date").alias("sale_date")).agg(
        *_revenue(),
        F.count("order_key").alias("order_count"),
        count_where(F.col("is_cancelled")).alias("cancelled_order_count"),
        count_where(F.col("is_refunded")).alias("refunded_order_count"),
    )


def payments_daily(fct_payments: DataFrame) -> DataFrame:
    return fct_payments.groupBy(F.col("payment_timestamp").cast("date").alias("sale_date")).agg(
        count_where(F.col("is_failed")).alias("payment_failure_count"),
        F.count("payment_key").alias("payment_attempt_count"),
    )


def mart_monthly_revenue(fct_orders: DataFrame) -> DataFrame:
    """Revenue, active, new and returning customers per month.

    One row per (customer, month) carries all the mart needs. The window that finds a customer's
    first month therefore sees at most one row per month, however many orders there are.
    """
    # Months are numbers until the end: they make for smaller shuffle rows than text.
    activity = fct_orders.groupBy(
        "customer_key", month_number(F.col("order_timestamp")).alias("month")
    ).agg(*_revenue(), F.count("order_key").alias("order_count"))
    first_month = F.min("month").over(Window.partitionBy("customer_key"))
    known = F.col("customer_key").isNotNull()
    debut = F.col("month") == F.col("first_month")
    months = (
        activity.withColumn("first_month", first_month)
        .groupBy("month")
        .agg(
            *_revenue(),
            F.sum("order_count").alias("order_count"),
            count_where(known).alias("monthly_active_customers"),
            count_where(known & debut).alias("new_customers"),
            count_where(known & ~debut).alias("returning_customers"),
        )
    )
    return months_of(months)


def months_of(months: DataFrame) -> DataFrame:
    """The mart from one row per month number: revenue, order count and customer counts."""
    return _finish(
        "mart_monthly_revenue",
        months,
        year_month=month_text(F.col("month")),
        average_order_value=ratio(F.col("net_revenue"), F.col("order_count")),
    )


def mart_customer_lifetime_value(fct_orders: DataFrame) -> DataFrame:
    customers = fct_orders.groupBy("customer_key").agg(
        F.count("order_key").alias("order_count"),
        *_revenue(),
        F.min("order_timestamp").alias("first_order_date"),
        F.max("order_timestamp").alias("last_order_date"),
    )
    return lifetime_of(customers)


def lifetime_of(customers: DataFrame) -> DataFrame:
    """The mart from one row per customer: order count, revenue, first and last order."""
    named = customers.withColumnsRenamed(
        {"order_count": "total_orders", "gross_revenue": "total_revenue"}
    )
    return _finish(
        "mart_customer_lifetime_value",
        named,
        avg_order_value=ratio(F.col("net_revenue"), F.col("total_orders")),
        repeat_purchase_rate=(F.col("total_orders") > 1).cast("int").cast("double"),
    )


# Planned bytes of the lines a task adds up per order and product: about a million lines.
PAIR_BYTES = 4 << 20


def product_totals(
    fct_order_items: DataFrame, fct_orders: DataFrame, under: str | None = None
) -> DataFrame:
    """Quantities, revenue and order count per product key, for lines whose order exists.

    Lines are combined per (order, product) first. After that a product's order count is a
    row count, and the orders join meets each (order, product) pair once. One hashing of the lines
    by order serves both, into tasks of even size however many lines there are: each holds its pairs
    in memory.
    """
    lines = fct_order_items.select("order_key", "product_key", "quantity", "line_total")
    pairs = lines.repartition(tasks_for(lines, PAIR_BYTES), "order_key").groupBy("order_key", "product_key").agg(
        F.sum("quantity").alias("__quantity"), F.sum("line_total").alias("__total")
    )
    orders = fct_orders.select("order_key", "is_completed")
    return (
        lookup_join(pairs, orders, ["order_key"], key_source=fct_order_items, under=under)
        .groupBy("product_key")
        .agg(
            F.sum("__quantity").alias("total_quantity_sold"),
            F.sum("__total").alias("gross_revenue"),
            F.sum(F.when(F.col("is_completed"), F.col("__total")).otherwise(F.lit(0))).alias(
                "net_revenue"
            ),
            F.count(F.lit(1)).alias("order_count"),
        )
    )


def mart_product_performance(
    fct_order_items: DataFrame, dim_products: DataFrame, fct_orders: DataFrame,
    under: str | None = None,
) -> DataFrame:
    """Sales per product. Gross revenue adds the lines of orders of every status. What is staged
    goes below `under`, where given."""
    products = dim_products.select(
        "product_key", "product_id", "category", "subcategory", "product_name"
    )
    return products_of(product_totals(fct_order_items, fct_orders, under), products)


def products_of(totals: DataFrame, products: DataFrame) -> DataFrame:
    """The mart from one row of totals per product key."""
    return _finish(
        "mart_product_performance",
        totals.join(products, "product_key"),
        avg_unit_revenue=ratio(F.col("net_revenue"), F.col("total_quantity_sold")),
    )


def customer_totals(fct_orders: DataFrame) -> DataFrame:
    return (
        fct_orders.where(F.col("customer_key").isNotNull())
        .groupBy("customer_key")
        .agg(
            *_revenue(),
            F.count("order_key").alias("order_count"),
            count_where(F.col("is_cancelled")).alias("cancelled_orders"),
        )
    )


def mart_customer_segments(fct_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Revenue and engagement per segment and country, for customers that have orders.

    Orders are added up per customer before the customers join. Repeat counts belong to (segment,
    country code); a code with two names shows the same repeat counts under both.
    """
    return segments_of(customer_totals(fct_orders), dim_customers)


def segments_of(totals: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """The mart from one row of totals per customer."""
    customers = dim_customers.select(
        "customer_key", "customer_segment", "country_code", "country_name"
    )
    groups = (
        totals.join(customers, "customer_key")
        .groupBy("customer_segment", "country_code", "country_name")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.sum("gross_revenue").alias("total_revenue"),
            F.sum("net_revenue").alias("net_revenue"),
            F.sum("order_count").alias("order_count"),
            F.sum("cancelled_orders").alias("cancelled_orders"),
            count_where(F.col("order_count") > 1).alias("__repeat"),
        )
    )
    # At most one row per (segment, country name) reaches this window.
    per_code = Window.partitionBy("customer_segment", "country_code")
    named = F.col("customer_segment").isNotNull() & F.col("country_code").isNotNull()
    repeat = F.when(named, F.sum("__repeat").over(per_code)).otherwise(F.lit(0))
    ordering = F.when(named, F.sum("customer_count").over(per_code)).otherwise(F.lit(0))
    counted = groups.withColumns(
        {
            "ordering_customers": F.col("customer_count"),
            "repeat_customers": repeat,
            "customers_with_orders": ordering,
        }
    )
    return _finish(
        "mart_customer_segments",
        counted,
        avg_order_value=ratio(F.col("net_revenue"), F.col("order_count")),
        repeat_purchase_rate=ratio(
            F.col("repeat_customers"), F.col("customers_with_orders")
        ),
        cancellation_rate=ratio(F.col("cancelled_orders"), F.col("order_count")),
    )


def category_revenue(mart_products: DataFrame) -> DataFrame:
    """Revenue by category and subcategory with subtotals; null marks a total.

    `level` is 0 for a subcategory, 1 for a category, 3 for the grand total.
    """
    return mart_products.rollup("category", "subcategory").agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("gross_revenue").alias("gross_revenue"),
        F.sum("net_revenue").alias("net_revenue"),
        F.sum("total_quantity_sold").alias("total_quantity_sold"),
    )


def segment_country_revenue(mart_segments: DataFrame) -> DataFrame:
    """Revenue by segment, by country, by both and overall; `level` tells them apart."""
    return mart_segments.cube("customer_segment", "country_code").agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("net_revenue").alias("net_revenue"),
        F.sum("customer_count").alias("customer_count"),
        F.sum("order_count").alias("order_count"),
    )


def orders_enriched(fct_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Every order with its customer's segment, country and city."""
    customers = dim_customers.select(
        "customer_key", "customer_segment", "country_code", "country_name", "city"
    )
    return lookup_join(fct_orders, customers, ["customer_key"])


def order_items_enriched(
    fct_order_items: DataFrame, fct_orders: DataFrame, dim_products: DataFrame
) -> DataFrame:
    """Every line with its order's revenue and its product's names."""
    orders = fct_orders.select(
        "order_key",
        "is_completed",
        F.col("gross_revenue").alias("order_gross_revenue"),
        F.col("net_revenue").alias("order_net_revenue"),
    )
    products = dim_products.select(
        "product_key", "product_id", "category", "subcategory", "product_name"
    )
    with_orders = lookup_join(fct_order_items, orders, ["order_key"])
    return lookup_join(with_orders, products, ["product_key"], key_source=fct_order_items)


def first_orders(fct_orders: DataFrame) -> DataFrame:
    return fct_orders.groupBy("customer_key").agg(
        F.min("order_timestamp").alias("first_order_timestamp")
    )
