"""The given tables as the retail entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.functions.expressions import MONEY, padded_code

# Columns of the given tables (fixed values); declared, so that opening a table reads no footers.
GIVEN: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}

FEED_TIME = "2024-02-01T00:00:00"


class Inputs:
    """Lazy access to the entity frames of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.schema(GIVEN[table]).parquet(f"{self.folder}/{table}.parquet")

    def customers(self) -> DataFrame:
        # Nations and regions are small files; the planner broadcasts them by their size.
        return (
            self.raw("customer")
            .join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.concat(
                    F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.test")
                ).alias("email"),
                F.lit("Customer").alias("first_name"),
                F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
                padded_code("N", F.col("c_nationkey"), 2).alias("country_code"),
                F.col("n_name").alias("country_name"),
                F.col("r_name").alias("city"),
                F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), "budget")
                .when(F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD"), "standard")
                .otherwise("premium")
                .alias("customer_segment"),
                F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int"))
                .alias("signup_date"),
                (F.col("c_acctbal") > 0).alias("is_active"),
            )
        )

    def products(self) -> DataFrame:
        price = F.col("p_retailprice").cast("decimal(12,2)")
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            padded_code("SKU-", F.col("p_partkey"), 6).alias("sku"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.split_part("p_name", F.lit(" "), F.lit(2)).alias("subcategory"),
            F.col("p_brand").alias("brand"),
            price.alias("unit_price"),
            (price * F.lit("0.6").cast("decimal(2,1)")).cast("decimal(12,2)").alias("unit_cost"),
            (F.col("p_size") > 2).alias("is_active"),
        )

    def orders(self) -> DataFrame:
        open_order = F.col("o_orderstatus") == "O"
        priority = F.col("o_orderpriority")
        total = F.col("o_totalprice").cast(MONEY)
        tax = (total * F.lit("0.08").cast("decimal(3,2)")).cast(MONEY)
        shipping = F.lit("4.99").cast(MONEY)
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_date"),
            F.when(open_order & (priority == "5-LOW"), "cancelled")
            .when(open_order & (priority == "4-NOT SPECIFIED"), "refunded")
            .when(open_order, "pending")
            .when((F.col("o_orderstatus") == "P") & (priority == "1-URGENT"), "failed")
            .otherwise("completed")
            .alias("order_status"),
            padded_code("N", F.col("o_custkey") % 25, 2).alias("shipping_country"),
            (total - tax - shipping).cast(MONEY).alias("subtotal_amount"),
            F.lit("0.00").cast(MONEY).alias("discount_amount"),
            shipping.alias("shipping_amount"),
            tax.alias("tax_amount"),
            total.alias("total_amount"),
            F.col("o_orderdate").alias("updated_at"),
        )

    def payments(self) -> DataFrame:
        """One payment per order, one to 119 minutes after it."""
        number, status = F.col("order_id"), F.col("order_status")
        methods = ("credit_card", "debit_card", "paypal", "bank_transfer", "gift_card")
        minutes = (number % 119 + 1).cast("int")
        return self.orders().select(
            number.alias("payment_id"),
            number,
            (F.col("order_date") + F.make_dt_interval(mins=minutes)).alias("payment_date"),
            F.element_at(F.array(*map(F.lit, methods)), (number % 5 + 1).cast("int")).alias(
                "payment_method"
            ),
            F.when(status.isin("failed", "refunded"), status)
            .when(status == "cancelled", F.when(number % 10 < 7, "failed").otherwise("pending"))
            .when(status == "pending", F.when(number % 10 < 8, "pending").otherwise("succeeded"))
            .otherwise(F.when(number % 100 < 7, "failed").otherwise("succeeded"))
            .alias("payment_status"),
            F.col("total_amount").alias("amount"),
        )

    def order_items(self) -> DataFrame:
        listed = F.col("l_extendedprice").cast(MONEY)
        kept = F.lit(1) - F.col("l_discount").cast("decimal(5,2)")
        return self.raw("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
            F.col("l_discount").cast("decimal(5,4)").alias("discount_pct"),
            (listed * kept).cast("decimal(14,2)").alias("line_total"),
            F.col("l_shipdate"),
        )

    def website_events(self) -> DataFrame:
        """Events with feed names; `error` is no feed type and stays, to be rejected."""
        kind = F.col("event_type")
        return self.raw("events").select(
            F.col("event_id").cast("string").alias("event_id"),
            F.when(kind == "view", "page_view")
            .when(kind == "click", "product_view")
            .when(kind == "signup", "checkout_start")
            .otherwise(kind)
            .alias("event_type"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_timestamp"),
            F.col("user_id").alias("customer_id"),
            F.concat(
                padded_code("sess_", F.col("user_id"), 6),
                F.lit("_"),
                F.date_format("ts", "yyyy-MM-dd"),
            ).alias("session_id"),
            F.when(kind == "purchase", F.col("value")).alias("order_value"),
        )

    def product_updates(self) -> DataFrame:
        """A ten percent price rise for every product."""
        price = F.col("p_retailprice").cast("decimal(12,2)")
        raised = (price * F.lit("1.1").cast("decimal(2,1)")).cast("decimal(12,2)")
        return self.raw("part").select(
            F.col("p_partkey").alias("update_id"),
            F.col("p_partkey").alias("product_id"),
            padded_code("SKU-", F.col("p_partkey"), 6).alias("sku"),
            F.lit("price_change").alias("update_type"),
            F.lit(FEED_TIME).alias("effective_at"),
            F.lit("unit_price").alias("field_name"),
            price.cast("string").alias("old_value"),
            raised.cast("string").alias("new_value"),
        )
