"""Table tests. Every test is a frame `(check_name, violations)`, so tests union into one report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.runtime import tasks_for

# Planned bytes of the keys a task tells apart: about a million.
KEY_BYTES = 4 << 20


def report(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, checks)


def _violations(name: str, frame: DataFrame, measure: Column) -> DataFrame:
    return frame.agg(F.coalesce(measure, F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(name).alias("check_name"), "violations"
    )


def unique(name: str, frame: DataFrame, *keys: str) -> DataFrame:
    """How many keys occur more than once. A single null key is not a key."""
    groups = frame.where(F.col(keys[0]).isNotNull()) if len(keys) == 1 else frame
    counted = groups.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    return _violations(name, counted, F.count_if(F.col("__rows") > 1))


def _together(measures: dict[str, Column], frame: DataFrame) -> DataFrame:
    """Several violation counts from one aggregate over `frame`."""
    rows = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.coalesce(measure, F.lit(0)).cast("bigint").alias("violations"),
        )
        for name, measure in measures.items()
    ]
    return frame.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def key_tests(table: str, frame: DataFrame, key: str) -> DataFrame:
    """Uniqueness and presence of a key.

    Keys hardly ever repeat, so counting them before they travel would hold nearly every row in
    memory. They are dealt as they are, into tasks of even size however many there are. Nulls are
    counted where they lie.
    """
    keys = frame.select(key).where(F.col(key).isNotNull())
    dealt = keys.repartition(tasks_for(keys, KEY_BYTES), key)
    return report(
        [unique(f"unique_{table}_{key}", dealt, key), nulls(table, frame, (key,))]
    )


def nulls(table: str, frame: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows without a value, per column, from one scan."""
    return _together(
        {f"not_null_{table}_{name}": F.count_if(F.col(name).isNull()) for name in columns}, frame
    )


def matching(name: str, frame: DataFrame, condition: Column) -> DataFrame:
    """How many rows meet a condition that no row should meet."""
    return _violations(name, frame, F.count_if(F.coalesce(condition, F.lit(False))))


def not_null(name: str, frame: DataFrame, column: str) -> DataFrame:
    return matching(name, frame, F.col(column).isNull())


def orphans(
    name: str,
    child: DataFrame,
    column: str,
    parent: DataFrame,
    parent_column: str,
    count_null: bool = True,
) -> DataFrame:
    """How many child rows have no parent. `count_null=False` passes over null keys.

    Keys of both meet in one grouping, which sorts neither side and holds a row per key. Rows are
    counted per key before they travel: a key with a third of the rows is one row.
    """
    rows = child if count_null else child.where(F.col(column).isNotNull())
    key = F.col(parent_column).cast(child.schema[column].dataType)
    children = rows.select(F.col(column).alias("__key"), F.lit(1).alias("__row"))
    parents = parent.select(key.alias("__key"), F.lit(0).alias("__row"))
    # A null key has no parent, whatever the parents' keys are.
    both = children.unionAll(parents.where(F.col("__key").isNotNull()))
    per_key = both.groupBy("__key").agg(
        F.sum("__row").alias("__rows"), F.min("__row").alias("__without")
    )
    return _violations(name, per_key.where(F.col("__without") == 1), F.sum("__rows"))


def difference(name: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """How many distinct rows are in only one of two frames."""
    return _violations(name, only_in_one(left, right), F.count(F.lit(1)))


def only_in_one(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of (left - right) and (right - left), from one grouping of both."""
    names = left.columns
    both = left.select(*names, F.lit(1).alias("__l"), F.lit(0).alias("__r")).unionByName(
        right.select(*names, F.lit(0).alias("__l"), F.lit(1).alias("__r"))
    )
    return (
        both.groupBy(*names)
        .agg(F.max("__l").alias("__l"), F.max("__r").alias("__r"))
        .where(F.col("__l") != F.col("__r"))
        .select(*names)
    )


def source_checks(
    customers: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    order_items: DataFrame,
    payments: DataFrame,
) -> DataFrame:
    """The seven checks of the operational tables."""
    order_ids = order_items.select("order_id").distinct()
    return report(
        [
            orphans("orphan_orders", orders, "customer_id", customers, "customer_id"),
            orphans("orphan_order_items_orders", order_items, "order_id", orders, "order_id"),
            orphans(
                "orphan_order_items_products", order_items, "product_id", products, "product_id"
            ),
            orphans("orphan_payments", payments, "order_id", orders, "order_id"),
            matching(
                "negative_order_totals",
                orders,
                (F.col("total_amount") < 0) | (F.col("subtotal_amount") < 0),
            ),
            duplicate_values("duplicate_customer_emails", customers, "email"),
            matching(
                "orders_without_items",
                orders.select("order_id").join(order_ids, "order_id", "left_anti"),
                F.lit(True),
            ),
        ]
    )


def duplicate_values(name: str, frame: DataFrame, column: str) -> DataFrame:
    """How many values occur more than once, null counted as a value."""
    counted = frame.groupBy(column).agg(F.count(F.lit(1)).alias("__rows"))
    return _violations(name, counted, F.count_if(F.col("__rows") > 1))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count), ordered by name."""
    return report(
        [
            frame.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, frame in tables.items()
        ]
    ).orderBy("table_name")


def schema_report(
    tables: dict[str, DataFrame], required: dict[str, tuple[str, ...]]
) -> DataFrame:
    """(table_name, missing_columns, row_count, passed): required columns exist, rows exist."""
    parts = []
    for name, frame in tables.items():
        missing = [column for column in required[name] if column not in frame.columns]
        rows = F.count(F.lit(1))
        parts.append(
            frame.agg(rows.alias("row_count")).select(
                F.lit(name).alias("table_name"),
                F.lit(",".join(missing)).alias("missing_columns"),
                "row_count",
                ((F.col("row_count") > 0) & F.lit(not missing)).alias("passed"),
            )
        )
    return report(parts)


def same_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """(table_name, left_rows, right_rows, passed) for two `table_counts` frames."""
    a = left.select("table_name", F.col("row_count").alias("left_rows"))
    b = right.select("table_name", F.col("row_count").alias("right_rows"))
    return a.join(b, "table_name", "full").withColumn(
        "passed", F.col("left_rows").eqNullSafe(F.col("right_rows"))
    )
