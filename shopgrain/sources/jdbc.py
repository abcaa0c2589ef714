"""Operational database access through Spark's JDBC source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.rules import ENTITIES
from shopgrain.sources.landing import changed_since

# Parents before children (fixed values).
LOAD_ORDER = ("customers", "products", "orders", "order_items", "payments")
INSERT_BATCH = 1000


def read_options(
    url: str,
    table: str,
    properties: dict[str, str],
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> dict[str, str]:
    """Options of a table scan; with key bounds, one range of the key per partition."""
    options = {"url": url, "dbtable": table, "fetchsize": "10000", **properties}
    if key and bounds and partitions > 1:
        options |= {
            "partitionColumn": key,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_table(
    spark: SparkSession,
    url: str,
    entity: str,
    schema: str = "retail",
    watermark: object | None = None,
    partitions: int | None = None,
    **properties: str,
) -> DataFrame:
    """A source table, read in parallel key ranges; incremental tables only past the watermark.

    The key range is one aggregate the database answers from its primary-key index. Without a
    number of `partitions` there are as many as the session's default parallelism.
    """
    if partitions is None:
        partitions = spark.sparkContext.defaultParallelism
    table, key = f"{schema}.{entity}", ENTITIES[entity].key
    source = spark.read.format("jdbc")
    bounds = None
    if partitions > 1:
        ends = (
            source.options(**read_options(url, table, properties))
            .load()
            .agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
            .first()
        )
        bounds = None if ends.lo is None else (int(ends.lo), int(ends.hi))
    options = read_options(url, table, properties, key, bounds, partitions)
    return changed_since(spark.read.format("jdbc").options(**options).load(), entity, watermark)


def row_count(
    spark: SparkSession, url: str, entity: str, schema: str = "retail", **properties: str
) -> int:
    options = read_options(url, f"{schema}.{entity}", properties)
    return spark.read.format("jdbc").options(**options).load().count()


def write_table(frame: DataFrame, url: str, table: str, mode: str = "append", **properties: str):
    """`append` inserts; `overwrite` empties the table first and keeps its definition."""
    (
        frame.write.format("jdbc")
        .options(url=url, dbtable=table, batchsize=str(INSERT_BATCH), truncate="true", **properties)
        .mode(mode)
        .save()
    )


def load_all(
    tables: dict[str, DataFrame],
    url: str,
    schema: str = "retail",
    truncate_first: bool = False,
    **properties: str,
) -> None:
    """Append every table in foreign-key order, after emptying them in reverse order if asked."""
    absent = [name for name in LOAD_ORDER if name not in tables]
    if absent:
        raise KeyError(f"missing datasets: {absent}")
    if truncate_first:
        for name in reversed(LOAD_ORDER):
            write_table(tables[name].limit(0), url, f"{schema}.{name}", "overwrite", **properties)
    for name in LOAD_ORDER:
        write_table(tables[name], url, f"{schema}.{name}", "append", **properties)
