"""One query per operator, each over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from catalogue.adapters import Inputs
from shopgrain.functions.expressions import MONEY, status_in
from shopgrain.operators import checks, compare, reconcile
from shopgrain.operators.amounts import order_amounts
from shopgrain.operators.latest import latest_per_key
from shopgrain.operators.quality import annotate, mark_orphans, split
from shopgrain.plans import activity, dims, facts, jobs, marts, sqlmodels
from shopgrain.rules import (
    CORRUPT,
    CUSTOMERS,
    ENTITIES,
    LINEAGE_COLUMNS,
    LOADED_AT,
    MART_METRICS,
    ORDER_ITEMS,
    ORDERS,
    PROCESSED_AT,
    PRODUCTS,
    REASON,
    TABLES,
    WEBSITE_EVENTS,
    Bounds,
    BusinessRules,
    EntityRules,
)
from shopgrain.runtime import work_folder, written
from shopgrain.schemas import entity_schema
from shopgrain.sources import feeds, landing, manifests, snapshots
from shopgrain.sources.batchkeys import BatchKeys
from shopgrain.sources.landing import Batch
from shopgrain.sources.manifests import TableRun
from shopgrain.streaming import feed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

FIRST = Batch("retail_first", "2024-01-01", "2024-01-01T02:00:00+00:00")
SECOND = Batch("retail_second", "2024-01-02", "2024-01-02T02:00:00+00:00")


def query(function: Callable[[Inputs], DataFrame]):
    """Register a function of the inputs under its own name."""
    QUERIES[function.__name__] = lambda spark, folder: function(Inputs(spark, folder))
    return function


def edge(frame: DataFrame) -> DataFrame:
    """Decimals as doubles, without audit times. Sums are exact, so the doubles are the same in
    any engine, and so are quotients of them."""
    return frame.select(
        *[
            F.col(item.name).cast("double").alias(item.name)
            if isinstance(item.dataType, DecimalType)
            else F.col(item.name)
            for item in frame.schema.fields
            if item.name not in (LOADED_AT, PROCESSED_AT)
        ]
    )


class Curated:
    """Dimensions, facts and marts over the inputs, each built when it is asked for."""

    def __init__(self, inputs: Inputs):
        i = inputs
        self._make: dict[str, Callable[[], DataFrame]] = {
            "dim_date": lambda: dims.calendar_covering(i.orders(), "order_date"),
            "dim_country": lambda: dims.dim_country(i.customers()),
            "dim_customers": lambda: dims.dim_customers(i.customers()),
            "dim_products": lambda: dims.dim_products(i.products()),
            "fct_orders": lambda: facts.fct_orders(i.orders()),
            "fct_order_items": lambda: facts.fct_order_items(i.order_items()),
            "fct_payments": lambda: facts.fct_payments(i.payments()),
            "mart_daily_sales": lambda: marts.mart_daily_sales(
                self["fct_orders"], self["fct_payments"]
            ),
            "mart_monthly_revenue": lambda: marts.mart_monthly_revenue(self["fct_orders"]),
            "mart_customer_lifetime_value": lambda: marts.mart_customer_lifetime_value(
                self["fct_orders"]
            ),
            "mart_product_performance": lambda: marts.mart_product_performance(
                self["fct_order_items"], self["dim_products"], self["fct_orders"]
            ),
            "mart_customer_segments": lambda: marts.mart_customer_segments(
                self["fct_orders"], self["dim_customers"]
            ),
        }

    def __getitem__(self, name: str) -> DataFrame:
        return self._make[name]()

    def all(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in TABLES}


# --- dimensions, facts, marts -------------------------------------------------------------------


def _register_tables() -> None:
    for name in TABLES:
        QUERIES[name] = lambda spark, folder, name=name: edge(Curated(Inputs(spark, folder))[name])


_register_tables()


@query
def category_revenue_rollup(inputs: Inputs) -> DataFrame:
    return edge(marts.category_revenue(Curated(inputs)["mart_product_performance"]))


@query
def segment_country_revenue_cube(inputs: Inputs) -> DataFrame:
    return edge(marts.segment_country_revenue(Curated(inputs)["mart_customer_segments"]))


@query
def orders_by_status_any_case(inputs: Inputs) -> DataFrame:
    """Case-insensitive status test over statuses in mixed case."""
    mixed = inputs.orders().withColumn(
        "order_status",
        F.when(F.col("total_amount") > 100000, F.upper("order_status")).otherwise(
            F.col("order_status")
        ),
    )
    wanted = BusinessRules().completed
    return mixed.groupBy("order_status").agg(
        F.count_if(status_in(F.col("order_status"), wanted)).alias("exact_matches"),
        F.count_if(status_in(F.col("order_status"), wanted, ignore_case=True)).alias(
            "any_case_matches"
        ),
        F.count_if(F.expr(sqlmodels.sql_status_in("order_status", wanted))).alias("sql_matches"),
    )


@query
def fct_orders_null_status(inputs: Inputs) -> DataFrame:
    """An unknown status leaves the flags null and earns nothing."""
    unknown = inputs.orders().withColumn(
        "order_status", F.nullif("order_status", F.lit("pending"))
    )
    return edge(
        facts.fct_orders(unknown)
        .groupBy("is_completed", "is_cancelled", "is_refunded")
        .agg(
            F.count("order_key").alias("order_count"),
            F.sum("gross_revenue").alias("gross_revenue"),
            F.sum("net_revenue").alias("net_revenue"),
        )
    )


# --- intermediate frames, staging and SQL models ------------------------------------------------


@query
def int_orders_enriched(inputs: Inputs) -> DataFrame:
    t = Curated(inputs)
    return edge(marts.orders_enriched(t["fct_orders"], t["dim_customers"]))


@query
def int_order_items_enriched(inputs: Inputs) -> DataFrame:
    t = Curated(inputs)
    return edge(
        marts.order_items_enriched(t["fct_order_items"], t["fct_orders"], t["dim_products"])
    )


@query
def int_orders_daily(inputs: Inputs) -> DataFrame:
    return edge(marts.orders_daily(Curated(inputs)["fct_orders"]))


@query
def int_payments_daily(inputs: Inputs) -> DataFrame:
    return edge(marts.payments_daily(Curated(inputs)["fct_payments"]))


@query
def int_customer_first_order(inputs: Inputs) -> DataFrame:
    return marts.first_orders(Curated(inputs)["fct_orders"])


def _sql_model(inputs: Inputs, name: str) -> DataFrame:
    t = Curated(inputs)
    tables = {table: t[table] for table in sqlmodels.tables_behind(name)}
    sqlmodels.create_views(inputs.spark, tables, only=name)
    return edge(inputs.spark.table(name))


def _register_models() -> None:
    names = [f"stg_{table}" for table in sqlmodels.STAGED]
    names += ["int_customer_segment_orders", *sqlmodels.MARTS]
    for name in names:
        QUERIES[name] = lambda s, d, name=name: _sql_model(Inputs(s, d), name)
    for name in sqlmodels.INTERMEDIATE:
        if name not in QUERIES:
            QUERIES[name] = lambda s, d, name=name: _sql_model(Inputs(s, d), name)
    for name in ("int_orders_enriched", "int_order_items_enriched"):
        QUERIES[f"sql_{name}"] = lambda s, d, name=name: _sql_model(Inputs(s, d), name)


_register_models()


@query
def mart_parity(inputs: Inputs) -> DataFrame:
    """Days that only one of the two daily-sales builds has, after the later year is withheld
    from the SQL build; equal builds would give no rows to compare."""
    t = Curated(inputs)
    cut = F.lit("2001-01-01").cast("timestamp_ntz")
    shorter = t["fct_orders"].where(F.col("order_timestamp") < cut)
    sqlmodels.create_views(
        inputs.spark,
        {"fct_orders": shorter, "fct_payments": t["fct_payments"]},
        only="sql_mart_daily_sales",
    )
    built = Curated(inputs)["mart_daily_sales"].select("sale_date")
    modelled = inputs.spark.table("sql_mart_daily_sales").select("sale_date")
    return checks.only_in_one(built, modelled)


@query
def mart_parity_all(inputs: Inputs) -> DataFrame:
    """Rows in which any mart differs between the DataFrame and the SQL build."""
    t = Curated(inputs)
    sqlmodels.create_views(inputs.spark, {table: t[table] for table in sqlmodels.STAGED})
    compared = []
    for name, contract in TABLES.items():
        if contract.layer == "marts":
            modelled = edge(inputs.spark.table(f"sql_{name}"))
            compared.append(checks.difference(name, edge(Curated(inputs)[name]), modelled))
    return checks.report(compared)


# --- quality rules ------------------------------------------------------------------------------


def _settle(label: str):
    return lambda keys: written(keys, label)


def _reasons(frame: DataFrame, rules: EntityRules, *shown: str) -> DataFrame:
    annotated = annotate(frame, rules, settle=_settle(f"{rules.name}-repeated"))
    return annotated.select(*shown, REASON)


@query
def dq_reasons_order_items(inputs: Inputs) -> DataFrame:
    """Every line with its reasons; order line numbers repeat naturally."""
    return edge(
        _reasons(
            inputs.order_items(), ORDER_ITEMS, "order_item_id", "product_id", "quantity",
            "line_total",
        )
    )


@query
def dq_reasons_orders(inputs: Inputs) -> DataFrame:
    """Small orders have a negative subtotal once tax and shipping are taken off."""
    return _reasons(inputs.orders(), ORDERS, "order_id")


@query
def dq_reasons_customers(inputs: Inputs) -> DataFrame:
    """Customers in debt lose their e-mail, so `null_email` shows."""
    broken = inputs.customers().withColumn("email", F.when(F.col("is_active"), F.col("email")))
    return _reasons(broken, CUSTOMERS, "customer_id")


@query
def dq_reasons_payments(inputs: Inputs) -> DataFrame:
    """Two unknown methods, shown with spaces that standardising removes."""
    renamed = inputs.payments().withColumn(
        "payment_method",
        F.when(F.col("payment_method") == "paypal", " wallet ").otherwise(
            F.concat(F.lit("  "), "payment_method")
        ),
    )
    return _reasons(renamed, ENTITIES["payments"], "payment_id", "payment_method")


@query
def dq_reasons_product_updates(inputs: Inputs) -> DataFrame:
    """The feed delivered twice in one batch: every update is a duplicate of the other copy."""
    updates = inputs.product_updates()
    return _reasons(
        updates.unionByName(updates), ENTITIES["product_updates"], "update_id", "new_value"
    )


@query
def dq_null_keys(inputs: Inputs) -> DataFrame:
    """Null keys count as copies of each other, on top of being missing values."""
    broken = inputs.customers().withColumn(
        "customer_id", F.when(F.col("is_active"), F.col("customer_id"))
    )
    return (
        _reasons(broken, CUSTOMERS, "customer_id", "email")
        .groupBy(REASON)
        .agg(F.count(F.lit(1)).alias("row_count"), F.min("email").alias("first_email"))
    )


@query
def dq_invalid_events(inputs: Inputs) -> DataFrame:
    annotated = annotate(inputs.website_events(), WEBSITE_EVENTS, settle=_settle("events-repeated"))
    rejected = split(annotated)[1]
    return rejected.select("event_id", "event_type", "session_id", REASON)


@query
def dq_missing_column(inputs: Inputs) -> DataFrame:
    """A feed without the cost column: each row names it."""
    return _reasons(inputs.products().drop("unit_cost"), PRODUCTS, "product_id")


@query
def dq_bounds_all(inputs: Inputs) -> DataFrame:
    """All four kinds of limit, each placed so that some products break it."""
    limits = EntityRules(
        name="products",
        key="product_id",
        source_type="postgres",
        file_format="parquet",
        required=("product_id",),
        bounds=(
            Bounds("unit_price", min_inclusive=1000, max_exclusive=1500),
            Bounds("unit_cost", min_exclusive=620, max_inclusive=850),
        ),
    )
    return edge(_reasons(inputs.products(), limits, "product_id", "unit_price", "unit_cost"))


@query
def dq_scope_all_batches(inputs: Inputs) -> DataFrame:
    """A table landed twice: duplicates across batches, none within one."""
    once = inputs.products()
    landed = once.withColumn("batch_id", F.lit("a")).unionByName(
        once.withColumn("batch_id", F.lit("b"))
    )
    parts = []
    for scope in ("batch", "all"):
        annotated = annotate(landed, PRODUCTS, scope, settle=_settle(f"products-{scope}"))
        parts.append(
            annotated.groupBy("batch_id", REASON)
            .agg(F.count(F.lit(1)).alias("row_count"))
            .withColumn("scope", F.lit(scope))
        )
    return parts[0].unionByName(parts[1])


def _with_orphans(inputs: Inputs) -> DataFrame:
    """Orders checked against only those customers that have a positive balance."""
    orders, known = inputs.orders(), inputs.customers().where("is_active")
    annotated = annotate(orders, ORDERS, settle=_settle("orders-repeated"))
    return mark_orphans(
        annotated, ORDERS.foreign_keys[0], known, key_source=orders, settle=_settle("orphans")
    )


@query
def fk_orphans(inputs: Inputs) -> DataFrame:
    return split(_with_orphans(inputs))[1].select("order_id", "customer_id", REASON)


@query
def fk_valid(inputs: Inputs) -> DataFrame:
    return split(_with_orphans(inputs))[0].select("order_id", "customer_id", REASON)


@query
def fk_every_orphan(inputs: Inputs) -> DataFrame:
    """Lines without a known order and without a known product name both."""
    items = inputs.order_items().withColumn(REASON, F.lit(None).cast("string"))
    orders = inputs.orders().where(F.col("order_status") == "completed")
    products = inputs.products().where("is_active")
    by_order, by_product = ORDER_ITEMS.foreign_keys
    marked = items
    for key, parent in ((by_order, orders), (by_product, products)):
        marked = mark_orphans(
            marked, key, parent, every_orphan=True, key_source=items, settle=_settle("orphans")
        )
    return edge(marked.select("order_item_id", "product_id", "line_total", REASON))


@query
def dedupe_latest(inputs: Inputs) -> DataFrame:
    order = ("l_shipdate", "product_id", "quantity", "line_total", "unit_price")
    latest = latest_per_key(inputs.order_items(), ["order_item_id"], order)
    return edge(
        latest.select("order_item_id", "l_shipdate", "product_id", "quantity", "line_total")
    )


@query
def dedupe_latest_batch(inputs: Inputs) -> DataFrame:
    """Products landed twice, the second time with new prices: the later batch wins."""
    first = landing.with_lineage(inputs.products(), FIRST, "shop", "products")
    raised = inputs.products().withColumn("unit_price", F.col("unit_price") + 1)
    second = landing.with_lineage(
        raised.withColumn("unit_price", F.col("unit_price").cast("decimal(12,2)")),
        SECOND, "shop", "products",
    )
    latest = latest_per_key(first.unionByName(second), ["product_id"])
    return edge(latest.select("product_id", "unit_price", "batch_id"))


# --- writes, upserts, landing -------------------------------------------------------------------


@query
def upsert_snapshot(inputs: Inputs) -> DataFrame:
    """Large products change their price, and reappear once more under new keys."""
    path = work_folder(inputs.spark, "upsert")
    snapshots.upsert(inputs.products(), path, ["product_id", "sku"], verify=False)
    big = inputs.raw("part").where("p_size > 25").select(F.col("p_partkey").alias("product_id"))
    changed = (
        inputs.products()
        .join(big, "product_id", "left_semi")
        .withColumn("unit_price", (F.col("unit_price") + 5).cast("decimal(12,2)"))
    )
    copies = changed.withColumns(
        {"product_id": F.col("product_id") * 1000000, "sku": F.concat("sku", F.lit("-NEW"))}
    )
    # A new key can be that of another product; the sku tells the two apart.
    state = snapshots.upsert(changed.unionByName(copies), path, ["product_id", "sku"])
    return edge(state.state)


@query
def upsert_by_month(inputs: Inputs) -> DataFrame:
    """Refunds change orders of some months, and some of those orders move to another month."""
    path = work_folder(inputs.spark, "upsert-month")
    orders = inputs.orders().select("order_id", "order_date", "order_status")
    by_month = {"month_of": "order_date"}
    snapshots.upsert(orders, path, ["order_id"], verify=False, **by_month)
    refunded = orders.where("order_status = 'refunded'").withColumns(
        {
            "order_status": F.lit("closed"),
            "order_date": F.when(
                F.month("order_date") == 12, F.col("order_date") + F.expr("interval 40 days")
            ).otherwise(F.col("order_date")),
        }
    )
    return snapshots.upsert(refunded, path, ["order_id"], **by_month).state


@query
def upsert_by_directory(inputs: Inputs) -> DataFrame:
    """Refunds, some of which move to another month, then changes to the orders of one customer: the
    months they touch come from the key directory."""
    path = work_folder(inputs.spark, "upsert-directory")
    orders = inputs.orders().select("order_id", "customer_id", "order_date", "order_status")
    by_month = {"month_of": "order_date", "key_buckets": 8}
    snapshots.upsert(orders, path, ["order_id"], verify=False, **by_month)
    refunded = orders.where("order_status = 'refunded'").withColumns(
        {
            "order_status": F.lit("closed"),
            "order_date": F.when(
                F.month("order_date") == 12, F.col("order_date") + F.expr("interval 40 days")
            ).otherwise(F.col("order_date")),
        }
    )
    snapshots.upsert(refunded, path, ["order_id"], **by_month)
    own = orders.where("customer_id = 4").withColumns(
        {"order_status": F.lit("held"), "order_date": F.col("order_date") + F.expr("interval 1 day")}
    )
    return snapshots.upsert(own, path, ["order_id"], **by_month).state


@query
def upsert_newest_only(inputs: Inputs) -> DataFrame:
    """An older delivery does not overwrite newer rows."""
    path = work_folder(inputs.spark, "upsert-newest")
    now = inputs.orders().select("order_id", "order_status", "updated_at")
    snapshots.upsert(now, path, ["order_id"], verify=False)
    old = now.withColumns(
        {
            "order_status": F.lit("restored"),
            "updated_at": F.when(
                F.col("order_status") == "completed", F.col("updated_at") - F.expr("interval 1 day")
            ).otherwise(F.col("updated_at") + F.expr("interval 1 day")),
        }
    )
    return snapshots.upsert(old, path, ["order_id"], newer_by=("updated_at",)).state


@query
def quarantine_append(inputs: Inputs) -> DataFrame:
    """Two runs append their rejected rows; the second run is repeated and still counted once."""
    path = work_folder(inputs.spark, "quarantine")
    events = annotate(inputs.website_events(), WEBSITE_EVENTS, settle=_settle("events-repeated"))
    rejected = split(events)[1].select("event_id", "event_type", REASON)
    orders = annotate(inputs.orders(), ORDERS, settle=_settle("orders-repeated"))
    others = split(orders)[1].select(
        F.col("order_id").cast("string").alias("event_id"),
        F.col("order_status").alias("event_type"),
        REASON,
    )
    snapshots.append_rejected(rejected, path, FIRST.batch_id, FIRST.ingestion_date)
    for _ in range(2):
        snapshots.append_rejected(others, path, SECOND.batch_id, SECOND.ingestion_date)
    return snapshots.read_rejected(inputs.spark, path)


@query
def landing_roundtrip(inputs: Inputs) -> DataFrame:
    """Orders landed in two batches; only the second one is read back, by partition."""
    root = work_folder(inputs.spark, "landing")
    for batch in (FIRST, SECOND):
        landing.land(
            landing.with_lineage(inputs.orders(), batch, "retail_postgres", "orders"), root, ORDERS
        )
    back = landing.read_landed(inputs.spark, root, ORDERS, batch_id=SECOND.batch_id)
    return edge(back.select("order_id", "order_status", "total_amount", *LINEAGE_COLUMNS))


@query
def csv_feed(inputs: Inputs) -> DataFrame:
    """The product feed as CSV: written, landed with lineage, read back by name and type."""
    spark = inputs.spark
    folder, root = work_folder(spark, "csv-feed"), work_folder(spark, "csv-landed")
    feeds.export_csv({"product_updates": inputs.product_updates()}, folder)
    rules = ENTITIES["product_updates"]
    delivered = feeds.with_file_name(feeds.read_csv(spark, f"{folder}/product_updates"))
    landing.land(landing.with_lineage(delivered, FIRST, "retail_product_feed"), root, rules)
    back = landing.read_landed(spark, root, rules, entity_schema("product_updates"))
    return back.select(
        "update_id", "product_id", "sku", "update_type", "effective_at", "old_value", "new_value",
        F.col("source_file").endswith(".csv").alias("names_its_file"),
        "batch_id", "source_system", "ingestion_date",
    )


@query
def csv_tables_by_name(inputs: Inputs) -> DataFrame:
    """Customers exported as CSV with their columns in another order, bound by name."""
    spark = inputs.spark
    folder = work_folder(spark, "csv-tables")
    reordered = inputs.customers().select(*reversed(inputs.customers().columns))
    feeds.export_csv({"customers": reordered}, folder)
    schemas = {"customers": entity_schema("customers")}
    typed = feeds.read_csv_tables(spark, folder, schemas)["customers"]
    return typed.select(*inputs.customers().columns)


@query
def json_feed_array_and_lines(inputs: Inputs) -> DataFrame:
    """Event files of both shapes, a folder each: purchases as arrays over many lines, the rest as
    one record per line."""
    spark = inputs.spark
    folder = work_folder(spark, "json-feed")
    events = inputs.website_events()
    bought = F.col("event_type") == "purchase"
    feeds.write_json_lines(events.where(~bought), folder)
    # At most 5000 rows share an array; one text row becomes one file.
    number = F.floor(F.monotonically_increasing_id() / 5000)
    record = F.to_json(F.struct(*events.columns))
    arrays = (
        events.where(bought)
        .withColumn("file", number)
        .groupBy("file")
        .agg(F.array_join(F.collect_list(record), ",\n").alias("body"))
        .select(F.concat(F.lit("[\n"), "body", F.lit("\n]")).alias("value"))
    )
    staged = work_folder(spark, "json-arrays")
    arrays.write.option("maxRecordsPerFile", 1).text(staged)
    schema = entity_schema("website_events")
    from_lines = feeds.read_json(spark, folder, schema)
    from_arrays = feeds.read_json(spark, staged, schema, pattern="*.txt")
    both = from_lines.unionByName(from_arrays)
    return both.select(
        "event_id", "event_type", "event_timestamp", "customer_id", "session_id", "order_value",
        "search_query",
    )


@query
def events_as_json_lines(inputs: Inputs) -> DataFrame:
    """Events as JSON text and back; absent fields are left out of the text."""
    text = feeds.json_lines(inputs.website_events())
    record = F.from_json("value", entity_schema("website_events")).alias("r")
    return text.select(record, F.col("value").contains("order_value").alias("has_value")).select(
        "r.event_id", "r.event_type", "r.order_value", "has_value"
    )


@query
def standardised_products(inputs: Inputs) -> DataFrame:
    """Text columns padded with blanks come out trimmed."""
    padded = inputs.products().withColumns(
        {name: F.concat(F.lit("  "), name, F.lit(" ")) for name in ("sku", "brand", "category")}
    )
    annotated = annotate(padded, PRODUCTS, settle=_settle("products-repeated"))
    return annotated.select("product_id", "sku", "brand", "category", REASON)


@query
def watermark_extract(inputs: Inputs) -> DataFrame:
    """Orders changed after the mark. The bound is pushed into the scan."""
    mark = F.lit("1998-06-01 00:00:00").cast("timestamp_ntz")
    changed = landing.changed_since(inputs.orders(), "orders", mark)
    return edge(changed.select("order_id", "order_status", "total_amount", "updated_at"))


@query
def order_amounts_from_lines(inputs: Inputs) -> DataFrame:
    """Header amounts recomputed from the lines, with the line's list price per unit in cents."""
    lines = inputs.raw("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.lit(1).alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("unit_price"),
        (
            F.col("l_extendedprice").cast(MONEY)
            * (F.lit(1) - F.col("l_discount").cast("decimal(5,2)"))
        )
        .cast("decimal(14,2)")
        .alias("line_total"),
    )
    headers = inputs.orders().select("order_id", "customer_id", "shipping_amount")
    return edge(order_amounts(headers, lines))


# --- table tests and reconciliation -------------------------------------------------------------


@query
def source_checks(inputs: Inputs) -> DataFrame:
    return checks.source_checks(
        inputs.customers(),
        inputs.products(),
        inputs.orders(),
        inputs.order_items(),
        inputs.payments(),
    )


@query
def source_checks_with_faults(inputs: Inputs) -> DataFrame:
    """The same checks with parents withheld and e-mails shared, so that every check finds some."""
    return checks.source_checks(
        inputs.customers().where("is_active").withColumn("email", F.col("city")),
        inputs.products().where("is_active"),
        inputs.orders().where(F.col("order_status") != "failed"),
        inputs.order_items(),
        inputs.payments(),
    )


@query
def table_counts(inputs: Inputs) -> DataFrame:
    return checks.table_counts(
        {
            "customers": inputs.raw("customer"),
            "products": inputs.raw("part"),
            "orders": inputs.raw("orders"),
            "order_items": inputs.raw("lineitem"),
            "payments": inputs.payments(),
        }
    )


@query
def test_unique(inputs: Inputs) -> DataFrame:
    t = Curated(inputs)
    return checks.report(
        [
            checks.unique("orders", t["fct_orders"], "order_key"),
            checks.unique("order_items", t["fct_order_items"], "order_item_key"),
            checks.unique("customers", t["dim_customers"], "customer_key"),
            checks.unique("customer_cities", t["dim_customers"], "city"),
        ]
    )


@query
def test_not_null(inputs: Inputs) -> DataFrame:
    t = Curated(inputs)
    events = inputs.website_events()
    return checks.report(
        [
            checks.not_null("orders", t["fct_orders"], "order_key"),
            checks.not_null("event_order_value", events, "order_value"),
            checks.not_null("customers", t["dim_customers"], "customer_key"),
        ]
    )


@query
def test_relationships(inputs: Inputs) -> DataFrame:
    t = Curated(inputs)
    known = t["dim_customers"].where("is_active")
    open_orders = t["fct_orders"].where("not is_completed")
    sometimes = t["fct_orders"].withColumn(
        "customer_key", F.when(F.col("is_completed"), F.col("customer_key"))
    )
    return checks.report(
        [
            checks.orphans("orders", t["fct_orders"], "customer_key", known, "customer_key", False),
            checks.orphans("null_child", sometimes, "customer_key", known, "customer_key", False),
            checks.orphans(
                "items", t["fct_order_items"], "order_key", open_orders, "order_key", False
            ),
            checks.orphans("payments", t["fct_payments"], "order_key", open_orders, "order_key",
                           False),
        ]
    )


@query
def test_unique_combination(inputs: Inputs) -> DataFrame:
    products = Curated(inputs)["mart_product_performance"]
    segments = Curated(inputs)["mart_customer_segments"]
    lines = inputs.raw("lineitem")
    return checks.report(
        [
            checks.unique("products", products, "product_id", "category", "subcategory"),
            checks.unique("segments", segments, "customer_segment", "country_code"),
            checks.unique("lines", lines, "l_orderkey", "l_linenumber"),
        ]
    )


@query
def curated_tests(inputs: Inputs) -> DataFrame:
    """Every declared table test, over curated tables written once."""
    curated = {
        name: written(frame, name) for name, frame in Curated(inputs).all().items()
    }
    return jobs.data_tests(curated)


@query
def layer_counts(inputs: Inputs) -> DataFrame:
    source = {"customers": inputs.raw("customer"), "orders": inputs.raw("orders")}
    landed = {
        "customers": inputs.raw("customer").where("c_acctbal > 0"),
        "orders": inputs.raw("orders"),
        "payments": None,
    }
    return (
        reconcile.layer_counts("source", source)
        .unionAll(reconcile.layer_counts("bronze", landed))
        .select("layer", "entity", "row_count", "status")
    )


@query
def layer_mismatch(inputs: Inputs) -> DataFrame:
    counts = reconcile.layer_counts(
        "source", {"customers": inputs.raw("customer"), "orders": inputs.raw("orders"),
                   "products": inputs.raw("part")},
    ).unionAll(
        reconcile.layer_counts(
            "bronze", {"customers": inputs.raw("customer").where("c_acctbal > 0"),
                       "orders": inputs.raw("orders"), "products": None},
        )
    )
    return reconcile.compare(counts, "source", "bronze").unionAll(reconcile.unreadable(counts))


@query
def latest_manifest(inputs: Inputs) -> DataFrame:
    """Two runs recorded; the later one's counts are found."""
    spark, root = inputs.spark, work_folder(inputs.spark, "manifests")
    active = inputs.raw("customer").where("c_acctbal > 0")
    for batch, customers in ((FIRST, active), (SECOND, inputs.raw("customer"))):
        runs = [
            TableRun("customers", customers.count()),
            TableRun("orders", inputs.raw("orders").count(), rejected_count=3),
        ]
        manifests.write_manifest(spark, root, "gold", batch.batch_id, batch.ingestion_date, runs)
    totals = manifests.run_totals(spark, root)
    newest = manifests.latest_run(spark, root, "gold").select("batch_id", F.inline("tables"))
    return newest.join(totals, "batch_id").select(
        "batch_id", "table_name", "row_count", "rejected_count", "total_rows",
        "total_rejected_rows",
    )


@query
def schema_check(inputs: Inputs) -> DataFrame:
    """Curated tables have their audit column, marts also their metrics; one lost its dates."""
    tables = Curated(inputs).all()
    tables["fct_orders"] = tables["fct_orders"].drop("order_timestamp")
    wanted = {
        name: MART_METRICS.get(name, TABLES[name].columns) + (LOADED_AT,) for name in tables
    }
    wanted["fct_orders"] = TABLES["fct_orders"].columns
    return checks.schema_report(tables, wanted)


@query
def silver_schema_check(inputs: Inputs) -> DataFrame:
    """Checked rows carry every required column and the processing time; products lost theirs."""
    frames = {
        "customers": annotate(inputs.customers(), CUSTOMERS),
        "orders": annotate(inputs.orders(), ORDERS),
        "products": annotate(inputs.products().drop("sku", "unit_cost"), PRODUCTS),
    }
    wanted = {name: (*ENTITIES[name].required, PROCESSED_AT) for name in frames}
    return checks.schema_report(frames, wanted)


@query
def published_matches_curated(inputs: Inputs) -> DataFrame:
    """Rows of published tables against the rows of the tables they were loaded from."""
    spark = inputs.spark
    location = work_folder(spark, "warehouse")
    database = "shop_" + location.rsplit("-", 1)[1]
    spark.sql(f"create database {database} location '{location}'")
    t = Curated(inputs)
    curated = {name: t[name] for name in ("dim_products", "fct_payments")}
    for name, frame in curated.items():
        jobs.publish_table(spark, frame, f"{database}.{name}", "append")
    jobs.publish_table(spark, curated["dim_products"], f"{database}.dim_products", "append")
    loaded = {name: spark.table(f"{database}.{name}") for name in curated}
    return checks.same_counts(checks.table_counts(curated), checks.table_counts(loaded))


@query
def published_tables(inputs: Inputs) -> DataFrame:
    """Dimensions loaded into a catalog database: overwritten twice, the countries appended twice."""
    spark = inputs.spark
    location = work_folder(spark, "warehouse")
    database = "shop_" + location.rsplit("-", 1)[1]
    spark.sql(f"create database {database} location '{location}'")
    t = Curated(inputs)
    counts = {}
    for name, mode in (("dim_country", "append"), ("dim_customers", "overwrite"),
                       ("fct_payments", "overwrite")):
        for _ in range(2):
            jobs.publish_table(spark, t[name], f"{database}.{name}", mode)
        loaded = spark.table(f"{database}.{name}")
        counts[name] = loaded.where(F.col(loaded.columns[0]).isNotNull())
    return checks.table_counts(counts)


@query
def published_customers(inputs: Inputs) -> DataFrame:
    """Customers as published, under upper-case names."""
    spark = inputs.spark
    location = work_folder(spark, "warehouse")
    database = "shop_" + location.rsplit("-", 1)[1]
    spark.sql(f"create database {database} location '{location}'")
    jobs.publish_table(spark, Curated(inputs)["dim_customers"], f"{database}.dim_customers")
    return spark.table(f"{database}.dim_customers").drop(LOADED_AT.upper())


# --- whole jobs ---------------------------------------------------------------------------------


def _source_tables(inputs: Inputs) -> dict[str, DataFrame]:
    return {
        "customers": inputs.customers(),
        "products": inputs.products(),
        "orders": inputs.orders(),
        "order_items": inputs.order_items(),
        "payments": inputs.payments(),
    }


def _daily_run(inputs: Inputs) -> jobs.Paths:
    """Ingest, silver and gold over all five tables."""
    paths = jobs.Paths.under(work_folder(inputs.spark, "lake"))
    run = jobs.run_ingest(inputs.spark, paths, _source_tables(inputs))
    jobs.run_silver(inputs.spark, paths, run.batch_id, run.ingestion_date)
    jobs.run_gold(inputs.spark, paths)
    return paths


@query
def daily_run_sales(inputs: Inputs) -> DataFrame:
    """Daily sales after landing, checking and modelling the tables."""
    paths = _daily_run(inputs)
    return edge(snapshots.read_snapshot(inputs.spark, paths.gold_table("mart_daily_sales")))


@query
def incremental_marts(inputs: Inputs) -> DataFrame:
    """All marts after a second batch, brought up to date from the months it touched: orders of two
    months change status, customer or day (one day loses all its orders), some payments fail."""
    spark, paths = inputs.spark, jobs.Paths.under(work_folder(inputs.spark, "lake"))
    jobs.run_ingest(spark, paths, _source_tables(inputs), watermarks={}, batch=FIRST)
    jobs.run_silver(spark, paths)
    jobs.run_gold(spark, paths, mode="incremental")
    late = inputs.orders().where("order_date >= '1995-03-01' and order_date < '1995-05-01'")
    changed = late.withColumns({
        "order_status": F.when(F.col("order_id") % 2 == 0, "refunded").otherwise(
            F.col("order_status")),
        "customer_id": F.when(F.col("order_id") % 3 == 0, F.lit(1).cast("bigint")).otherwise(
            F.col("customer_id")),
        "order_date": F.when(
            F.dayofmonth("order_date") == 15, F.col("order_date") + F.expr("interval 20 days")
        ).otherwise(F.col("order_date")),
    })
    failed = inputs.payments().where("payment_date < '1995-06-01' and payment_id % 11 = 0").withColumn(
        "payment_status", F.lit("failed")
    )
    jobs.run_ingest(
        spark, paths, {"orders": changed, "payments": failed}, watermarks={}, batch=SECOND
    )
    jobs.run_silver(spark, paths)
    jobs.run_gold(spark, paths, mode="incremental")
    shown = {
        "mart_daily_sales": ("sale_date", "gross_revenue", "order_count", "payment_failure_count"),
        "mart_monthly_revenue": ("year_month", "gross_revenue", "order_count", "new_customers"),
        "mart_customer_lifetime_value": (
            "customer_key", "total_revenue", "total_orders", "repeat_purchase_rate"),
        "mart_product_performance": (
            "product_id", "gross_revenue", "order_count", "total_quantity_sold"),
        "mart_customer_segments": (
            "concat_ws('/', customer_segment, country_code)", "total_revenue", "order_count",
            "repeat_customers"),
    }
    parts = [
        snapshots.read_snapshot(spark, paths.gold_table(mart)).selectExpr(
            f"'{mart}' as mart", f"cast({group} as string) as item",
            f"cast({gross} as double) as gross_revenue", "cast(net_revenue as double) as net_revenue",
            f"cast({orders} as bigint) as order_count", f"cast({more} as bigint) as measure",
        )
        for mart, (group, gross, orders, more) in shown.items()
    ]
    return reduce(DataFrame.unionAll, parts)


@query
def daily_run_counts(inputs: Inputs) -> DataFrame:
    """Rows per layer and table of a whole run, with the rejected ones."""
    paths = _daily_run(inputs)
    parts = [
        manifests.latest_counts(inputs.spark, root, layer)
        for layer, root in (("bronze", paths.bronze), ("silver", paths.silver),
                            ("gold", paths.gold))
    ]
    counts = parts[0].unionAll(parts[1]).unionAll(parts[2])
    # The calendar of the run is configured, not taken from the tables.
    return counts.where(F.col("table_name") != "dim_date").select(
        "layer", "table_name", "row_count", "rejected_count"
    )


@query
def daily_run_issues(inputs: Inputs) -> DataFrame:
    """Reconciliation after a run in which one landed customer table was cut short."""
    spark, paths = inputs.spark, jobs.Paths.under(work_folder(inputs.spark, "lake"))
    landed = _source_tables(inputs) | {"customers": inputs.customers().where("is_active")}
    run = jobs.run_ingest(spark, paths, landed)
    jobs.run_silver(spark, paths, run.batch_id, run.ingestion_date)
    _, issues = jobs.run_reconcile(
        spark, paths, {**landed, "customers": inputs.customers()}, batch_id=run.batch_id
    )
    return issues


@query
def daily_run_quarantine(inputs: Inputs) -> DataFrame:
    """Rejected rows of a run in which orders of unknown customers were landed."""
    spark, paths = inputs.spark, jobs.Paths.under(work_folder(inputs.spark, "lake"))
    run = jobs.run_ingest(
        spark,
        paths,
        _source_tables(inputs) | {"customers": inputs.customers().where("is_active")},
        batch=FIRST,
    )
    jobs.run_silver(spark, paths, run.batch_id, run.ingestion_date)
    rejected = snapshots.read_rejected(spark, paths.rejected("orders"))
    return rejected.select("order_id", "customer_id", REASON, "batch_id", "ingestion_date")


@query
def landed_matches_source(inputs: Inputs) -> DataFrame:
    """Rows landed against rows at the source, and lineage columns that are absent."""
    spark, root = inputs.spark, work_folder(inputs.spark, "landed")
    source = {"customers": inputs.customers(), "orders": inputs.orders()}
    short = {"customers": inputs.customers().where("is_active"), "orders": inputs.orders()}
    back = {}
    for name, frame in short.items():
        landing.land(landing.with_lineage(frame, FIRST, "shop", name), root, ENTITIES[name])
        back[name] = landing.read_landed(spark, root, ENTITIES[name])
    back["orders"] = back["orders"].drop("source_file")
    rows = checks.same_counts(checks.table_counts(source), checks.table_counts(back))
    lineage = checks.schema_report(back, {name: LINEAGE_COLUMNS for name in back})
    return rows.withColumnRenamed("passed", "same_rows").join(
        lineage.select("table_name", "missing_columns"), "table_name"
    )


@query
def backlog_run(inputs: Inputs) -> DataFrame:
    """Two batches of orders landed, then one silver run: where each order of both ended up."""
    spark, paths = inputs.spark, jobs.Paths.under(work_folder(inputs.spark, "lake"))
    odd = F.col("order_id") % 2 == 1
    first = _source_tables(inputs) | {"orders": inputs.orders().where(~odd)}
    jobs.run_ingest(spark, paths, first, watermarks={}, batch=FIRST)
    jobs.run_ingest(spark, paths, {"orders": inputs.orders().where(odd)}, watermarks={}, batch=SECOND)
    jobs.run_silver(spark, paths)
    return _accepted_and_rejected(inputs, paths, "orders", "order_id")


@query
def partial_silver(inputs: Inputs) -> DataFrame:
    """One batch of all five tables: a silver run over the orders, one over the lines, then one over
    the rest. Orders and lines wait for their parents, and none is lost."""
    spark, paths = inputs.spark, jobs.Paths.under(work_folder(inputs.spark, "lake"))
    tables = _source_tables(inputs)
    tables["customers"] = inputs.customers().where("is_active")
    jobs.run_ingest(spark, paths, tables, watermarks={}, batch=FIRST)
    taken = []
    for entities in (["customers"], ["orders"], ["order_items"], None, None):
        taken += jobs.run_silver(spark, paths, entities=entities).tables
    sums: dict[str, list[int]] = {}
    for table in taken:
        held = sums.setdefault(table.table_name, [0, 0])
        held[0] += table.row_count
        held[1] += table.rejected_count
    return spark.createDataFrame(
        [(name, *held) for name, held in sums.items()],
        "entity string, accepted_rows bigint, rejected_rows bigint",
    )


@query
def replayed_batch(inputs: Inputs) -> DataFrame:
    """An older batch worked on again after a newer one: the newer rows stay, and so do those that
    only the older batch has."""
    spark, paths = inputs.spark, jobs.Paths.under(work_folder(inputs.spark, "lake"))
    raised = inputs.orders().where("order_id % 3 = 0").withColumn(
        "total_amount", (F.col("total_amount") + 1).cast(MONEY)
    )
    first = _source_tables(inputs)
    jobs.run_ingest(spark, paths, first, watermarks={}, batch=FIRST)
    jobs.run_ingest(spark, paths, {"orders": raised}, watermarks={}, batch=SECOND)
    jobs.run_silver(spark, paths)
    jobs.run_silver(spark, paths, FIRST.batch_id, FIRST.ingestion_date)
    stored = snapshots.read_snapshot(spark, paths.silver_table("orders"))
    return edge(stored.select("order_id", "batch_id", "total_amount"))


def _accepted_and_rejected(
    inputs: Inputs, paths: jobs.Paths, entity: str, key: str
) -> DataFrame:
    stored = snapshots.read_snapshot(inputs.spark, paths.silver_table(entity))
    found = stored.select(key, "batch_id", F.lit("accepted").alias("outcome"))
    if not snapshots.has_rejected(inputs.spark, paths.rejected(entity)):
        return found
    aside = snapshots.read_rejected(inputs.spark, paths.rejected(entity))
    return found.unionAll(aside.select(key, "batch_id", F.col(REASON)))


@query
def late_parent(inputs: Inputs) -> DataFrame:
    """Orders landed a day before some of their customers: they come back from the rows set aside."""
    spark, paths = inputs.spark, jobs.Paths.under(work_folder(inputs.spark, "lake"))
    early = _source_tables(inputs) | {"customers": inputs.customers().where("is_active")}
    jobs.run_ingest(spark, paths, early, watermarks={}, batch=FIRST)
    jobs.run_silver(spark, paths)
    jobs.run_ingest(spark, paths, {"customers": inputs.customers()}, watermarks={}, batch=SECOND)
    jobs.run_silver(spark, paths)
    return _accepted_and_rejected(inputs, paths, "orders", "order_id")


@query
def upsert_new_column(inputs: Inputs) -> DataFrame:
    """A column that arrives with a later batch, in a table divided by month: older rows lack it."""
    path = work_folder(inputs.spark, "upsert-column")
    orders = inputs.orders().select("order_id", "order_date", "order_status")
    snapshots.upsert(orders, path, ["order_id"], verify=False, month_of="order_date")
    noted = orders.where("order_status = 'refunded' and month(order_date) = 5").withColumn(
        "note", F.concat(F.lit("refund of "), F.col("order_id"))
    )
    snapshots.upsert(noted, path, ["order_id"], month_of="order_date")
    return snapshots.read_snapshot(inputs.spark, path).select("order_id", "order_status", "note")


@query
def quarantine_rerun(inputs: Inputs) -> DataFrame:
    """A batch landed with wrong statuses, then landed again as it should be, under a numeric id."""
    spark, paths = inputs.spark, jobs.Paths.under(work_folder(inputs.spark, "lake"))
    batch = Batch("007", "2024-01-01", "2024-01-01T02:00:00+00:00")
    for status in (F.lit("odd"), F.col("order_status")):
        landed = {
            "customers": inputs.customers(),
            "orders": inputs.orders().withColumn("order_status", status),
        }
        jobs.run_ingest(spark, paths, landed, watermarks={}, batch=batch)
        jobs.run_silver(spark, paths, batch.batch_id, batch.ingestion_date)
    return _accepted_and_rejected(inputs, paths, "orders", "order_id")


@query
def csv_line_breaks(inputs: Inputs) -> DataFrame:
    """A feed whose quoted fields hold line breaks, landed and read back."""
    spark = inputs.spark
    folder, root = work_folder(spark, "csv-breaks"), work_folder(spark, "csv-breaks-landed")
    broken = inputs.product_updates().withColumn(
        "new_value", F.concat("new_value", F.lit("\nper piece, \"net\""))
    )
    broken.write.option("header", True).option("escape", '"').csv(folder)
    rules = replace(ENTITIES["product_updates"], multi_line=True)
    read = feeds.read_csv(spark, folder, quote_escape='"', lines=True)
    landing.land(
        landing.with_lineage(feeds.with_file_name(read), FIRST, "retail_product_feed"), root, rules
    )
    back = landing.read_landed(
        spark, root, rules, entity_schema("product_updates"), FIRST.batch_id
    )
    return back.select("update_id", "sku", "old_value", "new_value")


@query
def json_corrupt_records(inputs: Inputs) -> DataFrame:
    """Events of which one kind was cut off in mid-record: those are rejected with their text."""
    spark = inputs.spark
    folder, root = work_folder(spark, "json-corrupt"), work_folder(spark, "json-corrupt-landed")
    records = feeds.json_lines(inputs.website_events()).withColumn(
        "value",
        F.when(F.col("value").contains("checkout_start"), F.expr("left(value, 40)")).otherwise(
            F.col("value")
        ),
    )
    records.write.text(folder)
    read = feeds.read_json(spark, folder, entity_schema("website_events"), "*.txt", "lines")
    landing.land(landing.with_lineage(read, FIRST, "retail_web_analytics"), root, WEBSITE_EVENTS)
    back = landing.read_landed(spark, root, WEBSITE_EVENTS, entity_schema("website_events"))
    checked = annotate(back, WEBSITE_EVENTS, "none")
    return checked.select(
        "event_id", F.length(CORRUPT).cast("long").alias("kept_text"),
        F.split(REASON, "[|]")[0].alias("first_reason"),
    )


@query
def feeds_through_jobs(inputs: Inputs) -> DataFrame:
    """Both feeds and their parents through ingest and silver: rows by outcome."""
    spark, paths = inputs.spark, jobs.Paths.under(work_folder(inputs.spark, "lake"))
    base = work_folder(spark, "feeds")
    feeds.export_csv({"updates": inputs.product_updates()}, base)
    feeds.write_json_lines(inputs.website_events(), f"{base}/events")
    parents = {"customers": inputs.customers().where("is_active"), "products": inputs.products()}
    folders = {"product_updates": f"{base}/updates", "website_events": f"{base}/events"}
    jobs.run_ingest(
        spark, paths, parents, folders, watermarks={}, batch=FIRST,
        feed_shapes={"website_events": "lines"},
    )
    jobs.run_silver(spark, paths)
    events = _accepted_and_rejected(inputs, paths, "website_events", "event_id")
    updates = snapshots.read_snapshot(spark, paths.silver_table("product_updates")).select(
        F.col("update_id").cast("string"), "batch_id", F.lit("accepted")
    )
    return events.withColumn("entity", F.lit("website_events")).unionAll(
        updates.withColumn("entity", F.lit("product_updates"))
    ).withColumnRenamed("event_id", "id").select("entity", "id", "outcome")


@query
def layer_counts_unreadable(inputs: Inputs) -> DataFrame:
    """A source that cannot be opened is reported, not raised; empty tables are told apart."""
    spark = inputs.spark
    nowhere = work_folder(spark, "nowhere")
    counts = reconcile.layer_counts("source", {
        "customers": lambda: spark.read.parquet(nowhere),
        "orders": inputs.raw("orders"),
        "products": inputs.raw("part").where("p_partkey < 0"),
    })
    root = work_folder(spark, "manifests")
    manifests.write_manifest(spark, root, "silver", "b", "d", [
        TableRun("customers", inputs.raw("customer").count()), TableRun("orders", 0),
    ])
    recorded = reconcile.manifest_counts(spark, root, "silver")
    return counts.unionAll(recorded).select("layer", "entity", "row_count", "status")


@query
def silver_gold_issues(inputs: Inputs) -> DataFrame:
    """Gold built before the rest of the customers came: what lags behind the silver state."""
    spark, paths = inputs.spark, jobs.Paths.under(work_folder(inputs.spark, "lake"))
    tables = _source_tables(inputs)
    some = tables | {"customers": inputs.customers().where("is_active")}
    jobs.run_ingest(spark, paths, some, watermarks={})
    jobs.run_silver(spark, paths)
    jobs.run_gold(spark, paths)
    late = {"customers": inputs.customers()}
    jobs.run_ingest(spark, paths, late, watermarks={})
    jobs.run_silver(spark, paths, entities=["customers", "orders"])
    _, issues = jobs.run_reconcile(spark, paths, late)
    return issues


def _published(inputs: Inputs) -> tuple[jobs.Paths, str]:
    paths = _daily_run(inputs)
    location = work_folder(inputs.spark, "warehouse")
    database = "shop_" + location.rsplit("-", 1)[1]
    inputs.spark.sql(f"create database {database} location '{location}'")
    jobs.run_publish(inputs.spark, paths, database)
    return paths, database


@query
def published_run(inputs: Inputs) -> DataFrame:
    """All curated tables of a run in the catalog, in load order, with their rows."""
    paths, database = _published(inputs)
    counts = checks.table_counts(
        {name: inputs.spark.table(f"{database}.{name}") for name in TABLES}
    )
    order = F.element_at(F.map_from_arrays(
        F.array(*map(F.lit, TABLES)), F.array(*[F.lit(n) for n in range(len(TABLES))])
    ), F.col("table_name"))
    # The calendar of the run is configured, not taken from the tables.
    return counts.withColumn("place", order).where("table_name <> 'dim_date'")


@query
def sql_models_of_run(inputs: Inputs) -> DataFrame:
    """The SQL layer over the curated tables of a run, and every declared table test."""
    return jobs.run_sql_models(inputs.spark, _daily_run(inputs))


@query
def report_of_run(inputs: Inputs) -> DataFrame:
    """The reconciliation report of a run with one customer too few at the source, read back."""
    spark, paths = inputs.spark, jobs.Paths.under(work_folder(inputs.spark, "lake"))
    report = work_folder(spark, "report")
    tables = {"customers": inputs.customers(), "products": inputs.products()}
    jobs.run_ingest(spark, paths, tables, watermarks={})
    jobs.run_silver(spark, paths)
    cut = tables | {"customers": inputs.customers().where("is_active")}
    jobs.run_reconcile(spark, paths, cut, report_path=report)
    body = spark.read.schema(
        "passed boolean, issues array<string>, "
        "counts array<struct<layer string, entity string, row_count bigint>>"
    ).json(report)
    counted = body.select(
        "passed", F.size("issues").alias("n_issues"), F.inline("counts")
    )
    return counted.where("row_count is not null")


@query
def missing_curated(inputs: Inputs) -> DataFrame:
    """Curated tables still to be built when only those without faults are stored."""
    spark, paths = inputs.spark, jobs.Paths.under(work_folder(inputs.spark, "lake"))
    t = Curated(inputs)
    for name in ("dim_customers", "dim_products", "fct_orders"):
        snapshots.overwrite(t[name], paths.gold_table(name))
    absent = jobs.missing_tables(spark, paths)
    stored = {
        name: snapshots.read_snapshot(spark, paths.gold_table(name))
        for name in TABLES if name not in absent
    }
    return checks.table_counts(stored).withColumn(
        "missing", F.lit(len(absent)).cast("long")
    )


@query
def order_amounts_by_quantity(inputs: Inputs) -> DataFrame:
    """Header amounts from the true quantity of each line and a price per unit in cents."""
    price = (F.col("l_tax").cast("decimal(5,2)") + F.lit("12.34").cast("decimal(5,2)")).cast(MONEY)
    quantity = F.col("l_quantity").cast("int")
    kept = F.lit(1) - F.col("l_discount").cast("decimal(5,2)")
    lines = inputs.raw("lineitem").select(
        F.col("l_orderkey").alias("order_id"), quantity.alias("quantity"),
        price.alias("unit_price"),
        (price * quantity * kept).cast("decimal(14,2)").alias("line_total"),
    )
    headers = inputs.orders().select("order_id", "customer_id", "shipping_amount")
    return edge(order_amounts(headers, lines))


def _streamed(inputs: Inputs, parts: list[DataFrame], parents: str | None = None) -> DataFrame:
    """Each part as one delivery, taken in one after the other: what is stored in the end."""
    spark, base = inputs.spark, work_folder(inputs.spark, "stream")
    schema = entity_schema("website_events")
    for part in parts:
        feeds.write_json_lines(part, f"{base}/in")
        feed.ingest_available(
            feed.file_stream(spark, f"{base}/in", schema, "*.json"), WEBSITE_EVENTS,
            f"{base}/valid", f"{base}/rejected", f"{base}/checkpoint", "retail_web_analytics",
            parent_path=None if parents is None else lambda name: parents,
        )
    columns = ["event_id", "event_type", "event_timestamp", REASON]
    found = snapshots.read_snapshot(spark, f"{base}/valid").select(*columns)
    if snapshots.has_snapshot(spark, f"{base}/rejected"):
        aside = snapshots.read_snapshot(spark, f"{base}/rejected")
        found = found.unionByName(aside.select(*columns))
    return found


@query
def event_stream_dedupe(inputs: Inputs) -> DataFrame:
    """The event file as a stream, delivered twice: each event is stored once."""
    events = inputs.website_events()
    return _streamed(inputs, [events, events]).drop("event_timestamp")


@query
def event_stream_correction(inputs: Inputs) -> DataFrame:
    """Events delivered with an unknown type and then corrected: all are stored in the end."""
    events = inputs.website_events()
    wrong = events.where("event_type <> 'error'").withColumn("event_type", F.lit("unheard_of"))
    found = _streamed(inputs, [wrong, events])
    return found.drop("event_timestamp")


@query
def event_stream_retimed(inputs: Inputs) -> DataFrame:
    """Purchases delivered again with a time in another month: each is stored once, as corrected."""
    events = inputs.website_events()
    moved = events.where("event_type = 'purchase'").withColumn(
        "event_timestamp", F.concat(F.lit("2031"), F.substring("event_timestamp", 5, 30))
    )
    return _streamed(inputs, [events, moved, events])


@query
def event_stream_orphans(inputs: Inputs) -> DataFrame:
    """Streamed events against the stored customers, as in a batch run."""
    parents = work_folder(inputs.spark, "stream-customers")
    snapshots.overwrite(inputs.customers().where("is_active"), parents)
    return _streamed(inputs, [inputs.website_events()], parents).drop("event_timestamp")


@query
def event_stream_repeats(inputs: Inputs) -> DataFrame:
    """All events delivered again, purchases with another time, through the state store and the key
    directory: whether an event was stored from the second delivery. Only purchases were; the others
    are dropped before they reach a table, and rejected ones stay as they were stored first."""
    spark, base = inputs.spark, work_folder(inputs.spark, "stream")
    events = inputs.website_events()
    later = F.concat(F.lit("2031"), F.substring("event_timestamp", 5, 30))
    again = events.withColumn(
        "event_timestamp",
        F.when(F.col("event_type") == "purchase", later).otherwise(F.col("event_timestamp")),
    )
    for part in (events, again):
        feeds.write_json_lines(part, f"{base}/in")
        feed.ingest_available(
            feed.file_stream(spark, f"{base}/in", entity_schema("website_events"), "*.json"),
            WEBSITE_EVENTS, f"{base}/valid", f"{base}/rejected", f"{base}/checkpoint",
            "retail_web_analytics", key_buckets=4, repeats_within="1 day",
        )
    columns = ["event_id", "event_type", "event_timestamp", REASON]
    shown = [*columns, (~F.col("batch_id").startswith("stream-0_")).alias("stored_again")]
    return snapshots.read_snapshot(spark, f"{base}/valid").select(*shown).unionByName(
        snapshots.read_snapshot(spark, f"{base}/rejected").select(*shown)
    )


# --- rows that differ, active customers, late commits, publishing in one step -------------------


@query
def differing_rows(inputs: Inputs) -> DataFrame:
    """Orders against a copy with as many rows: some changed, some under another key."""
    orders = facts.fct_orders(inputs.orders())
    copy = orders.withColumns({
        "order_key": F.when(F.col("order_key") % 101 == 0, -F.col("order_key") - 1).otherwise(
            F.col("order_key")),
        "shipping_country": F.when(F.col("order_key") % 97 == 0, F.lit(None)).otherwise(
            F.col("shipping_country")),
    })
    return compare.differing_rows(orders, copy, ["order_key"], ignore=(LOADED_AT,))


@query
def active_customers_by_window(inputs: Inputs) -> DataFrame:
    """Customers with an order in the last 7, 30 and 90 days, per day and segment."""
    curated = Curated(inputs)
    bitmaps = activity.daily_bitmaps(curated["fct_orders"], curated["dim_customers"])
    return activity.active_customers(written(bitmaps, "bitmaps"), (7, 30, 90))


@query
def late_commits(inputs: Inputs) -> DataFrame:
    """Orders that the source commits after later ones were landed: those within 60 days of the mark
    are landed with the next batch, once, however often it looks back."""
    spark, paths = inputs.spark, jobs.Paths.under(work_folder(inputs.spark, "lake"))
    tables = _source_tables(inputs)
    early = tables | {"orders": inputs.orders().where("order_id % 20 <> 0")}
    jobs.run_ingest(spark, paths, early, watermarks={}, batch=FIRST)
    jobs.run_ingest(spark, paths, tables, batch=SECOND, look_back="60 days")
    third = replace(SECOND, batch_id="retail_third", ingestion_date="2024-01-03")
    jobs.run_ingest(spark, paths, tables, batch=third, look_back="60 days")
    landed = landing.read_landed(spark, paths.bronze, ORDERS)
    return landed.select("order_id", "batch_id")


@query
def duplicates_across_batches(inputs: Inputs) -> DataFrame:
    """Three batches of orders that share keys, the first landed again with fewer rows before the
    third: the keys each batch shares with those there are when it arrives."""
    spark, root = inputs.spark, work_folder(inputs.spark, "landed")
    kept = BatchKeys(spark, root, ORDERS, work_folder(spark, "batch-keys"), 8)
    third = replace(SECOND, batch_id="retail_third", ingestion_date="2024-01-03")
    parts = []
    for batch, which in (
        (FIRST, "order_id % 2 = 0"), (SECOND, "order_id % 2 = 1 or order_id % 10 = 0"),
        (FIRST, "order_id % 4 = 0"), (third, "order_id % 3 = 0"),
    ):
        rows = landing.with_lineage(inputs.orders().where(which), batch, "shop", "orders")
        landing.land(rows, root, ORDERS)
        parts.append(kept.repeated(batch.batch_id))
    # The first batch is asked about twice, the second time against the second batch.
    return reduce(DataFrame.unionAll, parts)


@query
def interrupted_publish(inputs: Inputs) -> DataFrame:
    """Twelve tables published, then a second load that stops at its last table: all show the rows
    of the first."""
    spark, paths = inputs.spark, _daily_run(inputs)
    database = f"switched_{uuid.uuid4().hex[:8]}"
    jobs.run_publish(spark, paths, database, mode="switch")
    before = {name: paths.gold_table(name) for name in TABLES}
    kept = {name: written(snapshots.read_snapshot(spark, path), "published")
            for name, path in before.items()}
    for name in TABLES:
        frame = snapshots.read_snapshot(spark, paths.gold_table(name))
        # The last table lacks a column it must have.
        fresh = frame.drop(MART_METRICS[name][0]) if name == list(TABLES)[-1] else frame.limit(1)
        snapshots.overwrite(fresh, paths.gold_table(name))
    try:
        jobs.run_publish(spark, paths, database, mode="switch")
        stopped = False
    except Exception:  # the load of the last table
        stopped = True
    rows = []
    for name in TABLES:
        shown = spark.table(f"{database}.{name}")
        shown = shown.toDF(*[c.lower() for c in shown.columns])
        rows.append(compare.differing_rows(shown, kept[name], list(TABLES[name].key)).agg(
            F.lit(name).alias("table_name"), F.lit(stopped).alias("stopped"),
            F.count(F.lit(1)).alias("differing_rows"),
        ))
    return reduce(DataFrame.unionAll, rows)
