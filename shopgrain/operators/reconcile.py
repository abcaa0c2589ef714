"""Layer counts and their comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.runtime import for_each_table, literal_rows
from shopgrain.sources.manifests import latest_counts

LAYERS = ("source", "bronze", "silver", "gold", "warehouse")

COUNT_SCHEMA = "layer string, entity string, row_count bigint, status string, detail string"


Table = DataFrame | Callable[[], DataFrame | None] | None


def layer_counts(
    layer: str, tables: dict[str, Table], spark: SparkSession | None = None
) -> DataFrame:
    """(layer, entity, row_count, status, detail) per table; None stands for a missing table.

    A table may be a function that opens it. Each is counted on its own, so that one that cannot
    be read has the status `error`, with the first line of the message, and spoils nothing else.
    Counting Parquet reads footers only.
    """

    def count(entity: str) -> tuple:
        try:
            table = tables[entity]
            frame = table() if callable(table) else table
            if frame is None:
                return layer, entity, None, "missing", ""
            rows = frame.count()
        except Exception as error:  # whatever keeps a table from being read is what to report
            lines = str(error).splitlines()
            return layer, entity, None, "error", lines[0][:200] if lines else type(error).__name__
        return layer, entity, rows, "ok" if rows else "empty", ""

    session = spark or SparkSession.active()
    return literal_rows(session, for_each_table(session, count, list(tables)), COUNT_SCHEMA)


def unavailable(spark: SparkSession, layer: str, status: str, detail: str) -> DataFrame:
    """A layer that could not be read at all: `error`, `missing` or `skipped`."""
    return literal_rows(spark, [(layer, layer, None, status, detail)], COUNT_SCHEMA)


def manifest_counts(spark: SparkSession, root: str, layer: str) -> DataFrame:
    """Counts of a layer as its newest run recorded them."""
    return latest_counts(spark, root, layer).select(
        "layer",
        F.col("table_name").alias("entity"),
        "row_count",
        F.when(F.col("row_count") > 0, "ok").otherwise("empty").alias("status"),
        F.lit("manifest").alias("detail"),
    )


def compare(
    counts: DataFrame,
    left: str,
    right: str,
    rejected: DataFrame | None = None,
) -> DataFrame:
    """(entity, issue) for every entity of `left` whose count differs in `right`, or is missing.

    `rejected` `(entity, rejected_count)` explains rows that were meant to be left out.
    """
    usable = counts.where(F.col("row_count").isNotNull())
    a = usable.where(F.col("layer") == left).select("entity", F.col("row_count").alias("l"))
    b = usable.where(F.col("layer") == right).select("entity", F.col("row_count").alias("r"))
    joined = a.join(b, "entity", "left")
    if rejected is not None:
        joined = joined.join(rejected, "entity", "left")
    else:
        joined = joined.withColumn("rejected_count", F.lit(0))
    expected = F.col("l") - F.coalesce("rejected_count", F.lit(0))
    text = F.when(
        F.col("r").isNull(), F.format_string(f"%s: {right} count unavailable", "entity")
    ).otherwise(F.format_string(f"%s: {left}=%d {right}=%d", "entity", expected, "r"))
    return joined.where(~F.col("r").eqNullSafe(expected)).select("entity", text.alias("issue"))


def unreadable(counts: DataFrame) -> DataFrame:
    """(entity, issue) for tables that are missing or failed."""
    return counts.where(F.col("status").isin("error", "missing")).select(
        "entity", F.concat_ws(": ", "entity", F.concat_ws(" ", "status", "detail")).alias("issue")
    )


def write_report(counts: DataFrame, issues: DataFrame, path: str) -> None:
    """One JSON row: passed flag, issue list and all counts. Its size is the number of tables."""
    entry = F.struct(*counts.columns)
    counted = counts.select(entry.alias("entry"), F.lit(None).cast("string").alias("issue"))
    issued = issues.select(F.lit(None).cast(counted.schema["entry"].dataType).alias("entry"), "issue")
    (
        counted.unionAll(issued)
        .agg(
            F.sort_array(F.collect_list("issue")).alias("issues"),
            F.sort_array(F.collect_list("entry")).alias("counts"),
        )
        .select(
            F.current_timestamp().alias("generated_at"),
            (F.size("issues") == 0).alias("passed"),
            "issues",
            "counts",
        )
        .coalesce(1)
        .write.mode("append")
        .json(path)
    )
