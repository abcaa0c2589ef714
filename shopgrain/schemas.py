"""Column types of the landed entities (fixed values)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ENTITY_DDL: dict[str, str] = {
    "customers": (
        "customer_id bigint, email string, first_name string, last_name string, phone string, "
        "country_code string, country_name string, city string, postal_code string, "
        "customer_segment string, signup_date date, is_active boolean, created_at timestamp, "
        "updated_at timestamp, source_system string"
    ),
    "products": (
        "product_id bigint, sku string, product_name string, category string, subcategory string, "
        "brand string, unit_price decimal(12,2), unit_cost decimal(12,2), currency string, "
        "is_active boolean, created_at timestamp, updated_at timestamp, source_system string"
    ),
    "orders": (
        "order_id bigint, customer_id bigint, order_date timestamp, order_status string, "
        "shipping_country string, shipping_city string, currency string, "
        "subtotal_amount decimal(14,2), discount_amount decimal(14,2), "
        "shipping_amount decimal(14,2), tax_amount decimal(14,2), total_amount decimal(14,2), "
        "created_at timestamp, updated_at timestamp, source_system string"
    ),
    "order_items": (
        "order_item_id bigint, order_id bigint, product_id bigint, quantity int, "
        "unit_price decimal(12,2), discount_pct decimal(5,4), line_total decimal(14,2), "
        "created_at timestamp, source_system string"
    ),
    "payments": (
        "payment_id bigint, order_id bigint, payment_date timestamp, payment_method string, "
        "payment_status string, amount decimal(14,2), currency string, transaction_ref string, "
        "created_at timestamp, updated_at timestamp, source_system string"
    ),
    "product_updates": (
        "update_id bigint, product_id bigint, sku string, update_type string, "
        "effective_at string, updated_by string, field_name string, old_value string, "
        "new_value string, source_system string"
    ),
    "website_events": (
        "event_id string, event_type string, event_timestamp string, customer_id bigint, "
        "session_id string, device_type string, traffic_channel string, country_code string, "
        "page_url string, source_system string, product_id bigint, sku string, "
        "product_name string, search_query string, order_value double"
    ),
}


def entity_schema(entity: str) -> StructType:
    return StructType.fromDDL(ENTITY_DDL[entity])


def bind_by_name(frame: DataFrame, schema: StructType) -> DataFrame:
    """Give the columns `frame` has their declared type; text that does not parse becomes null.

    Columns missing from `frame` stay missing, so that the quality rules can name them.
    Columns the schema does not know are kept as they are.
    """
    declared = {field.name: field.dataType for field in schema.fields}
    return frame.select(
        *[
            F.col(name).try_cast(declared[name]).alias(name) if name in declared else F.col(name)
            for name in frame.columns
        ]
    )
