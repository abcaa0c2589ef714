"""Quality rules, foreign keys, status lists and table contracts.

Everything here is a fixed value: changing one changes the results.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Lineage and bookkeeping columns (fixed values) ---------------------------

LINEAGE_COLUMNS = ("batch_id", "source_system", "source_file", "ingested_at", "ingestion_date")
PROCESSED_AT = "processed_at"
LOADED_AT = "gold_loaded_at"
REASON = "rejection_reason"
# Column with the text of a feed record that could not be parsed, and the reason it is rejected for.
CORRUPT = "corrupt_record"
REASON_SEPARATOR = "|"
LATEST_ORDER = ("ingested_at", "batch_id")
BATCH_PREFIX = "retail"


@dataclass(frozen=True)
class Bounds:
    """Numeric limits of one column; a limit left as None is not checked."""

    column: str
    min_inclusive: float | None = None
    min_exclusive: float | None = None
    max_inclusive: float | None = None
    max_exclusive: float | None = None


@dataclass(frozen=True)
class ForeignKey:
    """`column` of the child must exist as `parent_column` of `parent`."""

    column: str
    parent: str
    parent_column: str

    @property
    def reason(self) -> str:
        return f"orphan_{self.column}_references_{self.parent}.{self.parent_column}"


@dataclass(frozen=True)
class EntityRules:
    """Row rules of one landed entity."""

    name: str
    key: str
    source_type: str
    file_format: str
    required: tuple[str, ...]
    accepted: dict[str, tuple[str, ...]] = field(default_factory=dict)
    bounds: tuple[Bounds, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    dedupe_keys: tuple[str, ...] = ()
    # CSV whose fields may hold line breaks: files are then read whole, not split.
    multi_line: bool = False
    # Shape of a JSON feed: "lines", "arrays", or "auto" to tell its files apart by a scan.
    shape: str = "auto"

    @property
    def identity(self) -> tuple[str, ...]:
        return self.dedupe_keys or (self.key,)


# --- Entity rules, in processing order: parents come first (fixed values) -------

CUSTOMERS = EntityRules(
    name="customers",
    key="customer_id",
    source_type="postgres",
    file_format="parquet",
    required=("customer_id", "email", "first_name", "last_name", "country_code", "customer_segment"),
    accepted={"customer_segment": ("budget", "standard", "premium")},
)

PRODUCTS = EntityRules(
    name="products",
    key="product_id",
    source_type="postgres",
    file_format="parquet",
    required=("product_id", "sku", "product_name", "category", "unit_price", "unit_cost"),
    bounds=(Bounds("unit_price", min_exclusive=0), Bounds("unit_cost", min_inclusive=0)),
)

ORDERS = EntityRules(
    name="orders",
    key="order_id",
    source_type="postgres",
    file_format="parquet",
    required=("order_id", "customer_id", "order_date", "order_status", "total_amount"),
    accepted={"order_status": ("completed", "cancelled", "refunded", "pending", "failed")},
    bounds=(
        Bounds("subtotal_amount", min_inclusive=0),
        Bounds("discount_amount", min_inclusive=0),
        Bounds("shipping_amount", min_inclusive=0),
        Bounds("tax_amount", min_inclusive=0),
        Bounds("total_amount", min_inclusive=0),
    ),
    foreign_keys=(ForeignKey("customer_id", "customers", "customer_id"),),
)

ORDER_ITEMS = EntityRules(
    name="order_items",
    key="order_item_id",
    source_type="postgres",
    file_format="parquet",
    required=("order_item_id", "order_id", "product_id", "quantity", "unit_price", "line_total"),
    bounds=(
        Bounds("quantity", min_exclusive=0),
        Bounds("unit_price", min_exclusive=0),
        Bounds("discount_pct", min_inclusive=0, max_inclusive=1),
        Bounds("line_total", min_inclusive=0),
    ),
    foreign_keys=(
        ForeignKey("order_id", "orders", "order_id"),
        ForeignKey("product_id", "products", "product_id"),
    ),
)

PAYMENTS = EntityRules(
    name="payments",
    key="payment_id",
    source_type="postgres",
    file_format="parquet",
    required=("payment_id", "order_id", "payment_method", "payment_status", "amount"),
    accepted={
        "payment_method": ("credit_card", "debit_card", "paypal", "bank_transfer", "gift_card"),
        "payment_status": ("succeeded", "failed", "pending", "refunded"),
    },
    bounds=(Bounds("amount", min_inclusive=0),),
    foreign_keys=(ForeignKey("order_id", "orders", "order_id"),),
)

PRODUCT_UPDATES = EntityRules(
    name="product_updates",
    key="update_id",
    source_type="file",
    file_format="csv",
    required=("update_id", "product_id", "sku", "update_type", "effective_at"),
    accepted={
        "update_type": ("price_change", "category_change", "status_change", "description_change")
    },
    foreign_keys=(ForeignKey("product_id", "products", "product_id"),),
)

WEBSITE_EVENTS = EntityRules(
    name="website_events",
    key="event_id",
    source_type="file",
    file_format="json",
    required=("event_id", "event_type", "event_timestamp", "customer_id", "session_id"),
    accepted={
        "event_type": (
            "page_view",
            "product_view",
            "add_to_cart",
            "checkout_start",
            "purchase",
            "search",
        )
    },
    foreign_keys=(ForeignKey("customer_id", "customers", "customer_id"),),
)

ENTITIES: dict[str, EntityRules] = {
    rules.name: rules
    for rules in (
        CUSTOMERS,
        PRODUCTS,
        ORDERS,
        ORDER_ITEMS,
        PAYMENTS,
        PRODUCT_UPDATES,
        WEBSITE_EVENTS,
    )
}

# Entities of one group need only parents from earlier groups (fixed values).
ENTITY_GROUPS: tuple[tuple[str, ...], ...] = (
    ("customers", "products"),
    ("orders", "product_updates", "website_events"),
    ("order_items", "payments"),
)

# --- Source tables: load mode and watermark column (fixed values) ---------------

SOURCE_TABLES: dict[str, tuple[str, str | None]] = {
    "customers": ("full", "updated_at"),
    "products": ("incremental", "updated_at"),
    "orders": ("incremental", "updated_at"),
    "order_items": ("full", None),
    "payments": ("incremental", "updated_at"),
}

# Entities whose stored state is divided by the month of a column, so that a day's changes rewrite
# only the months they touch.
MONTH_OF: dict[str, str] = {
    "orders": "order_date",
    "order_items": "created_at",
    "payments": "payment_date",
    "website_events": "event_timestamp",
}

# Feed -> (source system, file pattern)
SOURCE_FEEDS: dict[str, tuple[str, str]] = {
    "product_updates": ("retail_product_feed", "*.csv"),
    "website_events": ("retail_web_analytics", "*.json"),
}
TABLE_SOURCE_SYSTEM = "retail_postgres"


@dataclass(frozen=True)
class BusinessRules:
    """Status lists behind the revenue and payment flags (fixed values)."""

    completed: tuple[str, ...] = ("completed",)
    cancelled: tuple[str, ...] = ("cancelled",)
    refunded: tuple[str, ...] = ("refunded",)
    payment_succeeded: tuple[str, ...] = ("succeeded",)
    payment_failed: tuple[str, ...] = ("failed",)
    calendar_start: str = "2023-01-01"
    calendar_end: str = "2026-12-31"


TAX_RATE = "0.08"

# --- Curated tables: layer, merge key, columns in order (fixed values) ----------


@dataclass(frozen=True)
class TableContract:
    layer: str
    key: tuple[str, ...]
    columns: tuple[str, ...]


# Silver entity -> the gold table that has a row for each of its rows.
GOLD_OF: dict[str, str] = {
    "customers": "dim_customers",
    "products": "dim_products",
    "orders": "fct_orders",
    "order_items": "fct_order_items",
    "payments": "fct_payments",
}

# In publish order: dimensions, facts, marts.
TABLES: dict[str, TableContract] = {
    "dim_date": TableContract(
        "dimensions",
        ("date_key",),
        ("date_key", "full_date", "year", "quarter", "month", "month_name", "day",
         "day_of_week", "day_name", "week_of_year", "is_weekend", LOADED_AT),
    ),
    "dim_country": TableContract(
        "dimensions",
        ("country_key",),
        ("country_key", "country_code", "country_name", LOADED_AT),
    ),
    "dim_customers": TableContract(
        "dimensions",
        ("customer_key",),
        ("customer_key", "customer_id", "email", "first_name", "last_name", "country_code",
         "country_name", "city", "customer_segment", "signup_date", "is_active", LOADED_AT),
    ),
    "dim_products": TableContract(
        "dimensions",
        ("product_key",),
        ("product_key", "product_id", "sku", "product_name", "category", "subcategory",
         "brand", "unit_price", "unit_cost", "is_active", LOADED_AT),
    ),
    "fct_orders": TableContract(
        "facts",
        ("order_key",),
        ("order_key", "customer_key", "order_date_key", "order_timestamp", "order_status",
         "shipping_country", "subtotal_amount", "discount_amount", "shipping_amount",
         "tax_amount", "total_amount", "is_completed", "is_cancelled", "is_refunded",
         "gross_revenue", "net_revenue", LOADED_AT),
    ),
    "fct_order_items": TableContract(
        "facts",
        ("order_item_key",),
        ("order_item_key", "order_key", "product_key", "quantity", "unit_price",
         "discount_pct", "line_total", LOADED_AT),
    ),
    "fct_payments": TableContract(
        "facts",
        ("payment_key",),
        ("payment_key", "order_key", "payment_date_key", "payment_timestamp",
         "payment_method", "payment_status", "amount", "is_successful", "is_failed", LOADED_AT),
    ),
    "mart_daily_sales": TableContract(
        "marts",
        ("sale_date",),
        ("sale_date", "gross_revenue", "net_revenue", "order_count", "cancelled_order_count",
         "refunded_order_count", "payment_failure_count", "payment_attempt_count",
         "average_order_value", "payment_failure_rate", "cancellation_rate", LOADED_AT),
    ),
    "mart_monthly_revenue": TableContract(
        "marts",
        ("year_month",),
        ("year_month", "gross_revenue", "net_revenue", "order_count",
         "monthly_active_customers", "new_customers", "returning_customers",
         "average_order_value", LOADED_AT),
    ),
    "mart_customer_lifetime_value": TableContract(
        "marts",
        ("customer_key",),
        ("customer_key", "total_orders", "total_revenue", "net_revenue", "first_order_date",
         "last_order_date", "avg_order_value", "repeat_purchase_rate", LOADED_AT),
    ),
    "mart_product_performance": TableContract(
        "marts",
        ("product_id",),
        ("product_id", "category", "subcategory", "product_name", "total_quantity_sold",
         "gross_revenue", "net_revenue", "order_count", "avg_unit_revenue", LOADED_AT),
    ),
    "mart_customer_segments": TableContract(
        "marts",
        ("customer_segment", "country_code", "country_name"),
        ("customer_segment", "country_code", "country_name", "customer_count", "total_revenue",
         "net_revenue", "order_count", "cancelled_orders", "ordering_customers",
         "repeat_customers", "customers_with_orders", "avg_order_value",
         "repeat_purchase_rate", "cancellation_rate", LOADED_AT),
    ),
}

# Metric columns every mart must show (fixed values).
MART_METRICS: dict[str, tuple[str, ...]] = {
    "mart_daily_sales": ("gross_revenue", "net_revenue", "order_count", "average_order_value",
                         "payment_failure_rate", "cancellation_rate"),
    "mart_monthly_revenue": ("gross_revenue", "net_revenue", "monthly_active_customers",
                             "new_customers", "returning_customers"),
    "mart_customer_lifetime_value": ("total_orders", "total_revenue", "net_revenue",
                                     "avg_order_value", "repeat_purchase_rate"),
    "mart_product_performance": ("total_quantity_sold", "gross_revenue", "net_revenue"),
    "mart_customer_segments": ("customer_count", "total_revenue", "net_revenue",
                               "repeat_purchase_rate", "cancellation_rate"),
}

# Table tests beyond keys (fixed values): (child, column, parent with the same column) ...
FOREIGN_KEY_TESTS: tuple[tuple[str, str, str], ...] = (
    ("fct_orders", "customer_key", "dim_customers"),
    ("fct_order_items", "order_key", "fct_orders"),
    ("fct_payments", "order_key", "fct_orders"),
)
# ... and mart -> (columns unique together, columns without nulls).
MART_TESTS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "mart_daily_sales": (("sale_date",), ("sale_date", "gross_revenue", "net_revenue")),
    "mart_monthly_revenue": (("year_month",), ("year_month",)),
    "mart_customer_lifetime_value": (("customer_key",), ("customer_key",)),
    "mart_product_performance": (("product_id", "category", "subcategory"), ("product_id",)),
    "mart_customer_segments": (
        ("customer_segment", "country_code"),
        ("customer_segment", "country_code"),
    ),
}
