"""Run manifests: one JSON row per run with the row counts of its tables."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopgrain.runtime import literal_rows
from shopgrain.sources.files import exists, join, write_text

RUN_DDL = (
    "layer string, batch_id string, ingestion_date string, written_at string, total_rows bigint"
)
TABLE_DDL = (
    "table_name string, row_count bigint, rejected_count bigint, path string, watermark string"
)
SCHEMA = f"{RUN_DDL}, tables array<struct<{TABLE_DDL}>>"


@dataclass(frozen=True)
class TableRun:
    """What a run did to one table. A manifest has a handful of these."""

    table_name: str
    row_count: int
    rejected_count: int = 0
    path: str = ""
    watermark: str | None = None


def write_manifest(
    spark: SparkSession,
    root: str,
    layer: str,
    batch_id: str,
    ingestion_date: str,
    tables: list[TableRun],
) -> None:
    written_at = datetime.now(timezone.utc).isoformat(timespec="microseconds")
    total = sum(t.row_count for t in tables)
    rows = [(t.table_name, t.row_count, t.rejected_count, t.path, t.watermark) for t in tables]
    entries = literal_rows(spark, rows, TABLE_DDL)
    listed = entries.agg(F.collect_list(F.struct(*entries.columns)).alias("tables"))
    run = {
        "layer": layer,
        "batch_id": batch_id,
        "ingestion_date": ingestion_date,
        "written_at": written_at,
        "total_rows": total,
    }
    listed.select(*[F.lit(value).alias(name) for name, value in run.items()], "tables").write.mode(
        "append"
    ).json(_folder(root))


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(_folder(root))


def latest_run(spark: SparkSession, root: str, layer: str) -> DataFrame:
    """The newest manifest of a layer, as at most one row."""
    runs = read_manifests(spark, root).where(F.col("layer") == layer)
    newest = runs.groupBy().agg(
        F.max_by(F.struct(*runs.columns), F.struct("written_at", "batch_id")).alias("run")
    )
    return newest.where(F.col("run").isNotNull()).select("run.*")


def latest_counts(spark: SparkSession, root: str, layer: str) -> DataFrame:
    """(layer, table_name, row_count, rejected_count, watermark) of the newest run."""
    return latest_run(spark, root, layer).select("layer", F.inline("tables"))


def run_totals(spark: SparkSession, root: str) -> DataFrame:
    """Total rows and rejected rows of every run."""
    return (
        read_manifests(spark, root)
        .select("layer", "batch_id", F.inline("tables"))
        .groupBy("layer", "batch_id")
        .agg(
            F.sum("row_count").alias("total_rows"),
            F.sum("rejected_count").alias("total_rejected_rows"),
        )
    )


LEDGER_DDL = "entity string, batch_id string, ingestion_date string, newest string, taken_at string"


@dataclass(frozen=True)
class Pending:
    """A landed batch with the entities of it that are not taken in yet."""

    batch_id: str
    ingestion_date: str
    entities: tuple[str, ...]


def record_intake(
    spark: SparkSession, silver: str, entity: str, batches: list[tuple[str, str]], newest: str | None
) -> None:
    """Enter in the ledger that the entity's rows of (batch, day) are in the silver state.

    `newest` is the latest ingest time among the rows taken in.
    """
    now = datetime.now(timezone.utc).isoformat(timespec="microseconds")
    names = StructType.fromDDL(LEDGER_DDL).names
    rows = [dict(zip(names, (entity, batch, day, newest, now))) for batch, day in batches]
    # A file of its own: tables that run side by side enter themselves at the same time.
    target = join(_ledger(silver), f"{entity}-{uuid.uuid4().hex[:12]}.json")
    write_text(spark, target, "\n".join(json.dumps(row) for row in rows))


def intake(spark: SparkSession, silver: str) -> DataFrame:
    """The ledger: a row for each entity of a batch that was taken in."""
    if not exists(spark, _ledger(silver)):
        return literal_rows(spark, [], LEDGER_DDL)
    return spark.read.schema(LEDGER_DDL).json(_ledger(silver))


def landed_entities(spark: SparkSession, bronze: str) -> DataFrame:
    """(entity, batch_id, ingestion_date, written_at) of everything that was landed."""
    landed = read_manifests(spark, bronze).where(F.col("layer") == "bronze")
    return landed.select("batch_id", "ingestion_date", "written_at", F.inline("tables")).groupBy(
        F.col("table_name").alias("entity"), "batch_id"
    ).agg(F.max("ingestion_date").alias("ingestion_date"), F.min("written_at").alias("written_at"))


def pending_batches(
    spark: SparkSession, bronze: str, silver: str, entities: list[str] | None = None
) -> list[Pending]:
    """Landed batches with the entities that no silver run took in, oldest first.

    What counts is the pair of batch and entity: a run over some entities leaves the others
    pending. `entities` limits what is looked at. One entry for each batch of the backlog.
    """
    if not exists(spark, _folder(bronze)):
        return []
    ledger = intake(spark, silver).select("entity", "batch_id")
    left = landed_entities(spark, bronze).join(ledger, ["entity", "batch_id"], "left_anti")
    if exists(spark, _folder(silver)):  # batches from before there was a ledger
        done = read_manifests(spark, silver).where(F.col("layer") == "silver").join(
            ledger, "batch_id", "left_anti"
        )
        left = left.join(
            done.select("batch_id", F.inline("tables")).select(
                "batch_id", F.col("table_name").alias("entity")
            ), ["entity", "batch_id"], "left_anti",
        )
    if entities is not None:
        left = left.where(F.col("entity").isin(entities))
    found = left.groupBy("batch_id").agg(
        F.max("ingestion_date").alias("ingestion_date"), F.min("written_at").alias("written_at"),
        F.array_sort(F.collect_set("entity")).alias("entities"),
    )
    return [
        Pending(row.batch_id, row.ingestion_date, tuple(row.entities))
        for row in found.orderBy("written_at", "batch_id").collect()
    ]


def newest_intake(spark: SparkSession, silver: str) -> dict[str, str]:
    """The latest ingest time among the rows each entity took in; a handful of entries."""
    rows = intake(spark, silver).where(F.col("newest").isNotNull()).groupBy("entity").agg(
        F.max("newest").alias("newest")
    )
    return {row.entity: row.newest for row in rows.collect()}


def newest_batch(spark: SparkSession, root: str) -> tuple[str, str]:
    """(batch_id, ingestion_date) of the newest landed batch."""
    if not exists(spark, _folder(root)):
        raise FileNotFoundError(f"no manifests under {root}; ingest first")
    row = latest_run(spark, root, "bronze").select("batch_id", "ingestion_date").first()
    if row is None:
        raise FileNotFoundError(f"no landed batch under {root}; ingest first")
    return row.batch_id, row.ingestion_date


def stored_watermarks(spark: SparkSession, root: str) -> dict[str, str]:
    """Highest watermark ever recorded per table; a handful of entries."""
    if not exists(spark, _folder(root)):
        return {}
    marks = (
        read_manifests(spark, root)
        .where(F.col("layer") == "bronze")
        .select(F.inline("tables"))
        .where(F.col("watermark").isNotNull())
        .groupBy("table_name")
        .agg(F.max("watermark").alias("watermark"))
    )
    return {row.table_name: row.watermark for row in marks.collect()}


def _folder(root: str) -> str:
    return join(root, "_manifests")


def _ledger(root: str) -> str:
    return join(root, "_intake")
