"""Landing zone: lineage columns, partitioned writes, and readers for what was landed."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shopgrain.rules import BATCH_PREFIX, CORRUPT, ENTITIES, LINEAGE_COLUMNS, SOURCE_TABLES, EntityRules
from shopgrain.schemas import bind_by_name
from shopgrain.sources import feeds
from shopgrain.sources.files import exists, join, matches

_PARTITIONS = ("ingestion_date", "batch_id")
# Names that a folder bears as they are.
_PLAIN_NAME = re.compile(r"[A-Za-z0-9_.-]+")


@dataclass(frozen=True)
class Batch:
    """Identity of one ingest run."""

    batch_id: str
    ingestion_date: str
    ingested_at: str

    @classmethod
    def start(cls, ingestion_date: date | None = None, prefix: str = BATCH_PREFIX) -> Batch:
        now = datetime.now(timezone.utc)
        return cls(
            f"{prefix}_{uuid.uuid4().hex[:12]}",
            (ingestion_date or now.date()).isoformat(),
            now.isoformat(),
        )


def with_lineage(
    frame: DataFrame, batch: Batch, source_system: str, source_file: str | None = None
) -> DataFrame:
    """Append the five lineage columns. Feed rows already carry their `source_file`."""
    values = {
        "batch_id": F.lit(batch.batch_id),
        "source_system": F.lit(source_system),
        "source_file": F.col("source_file") if source_file is None else F.lit(source_file),
        "ingested_at": F.lit(batch.ingested_at),
        "ingestion_date": F.lit(batch.ingestion_date),
    }
    return frame.withColumns({name: values[name] for name in LINEAGE_COLUMNS})


def entity_path(root: str, source_type: str, entity: str) -> str:
    return join(root, source_type, entity)


def land(frame: DataFrame, root: str, rules: EntityRules) -> str:
    """Write lineage-bearing rows below `ingestion_date=/batch_id=` and return the entity path.

    Only the partitions in `frame` are replaced, so running a batch again does not double it.
    """
    path = entity_path(root, rules.source_type, rules.name)
    writer = (
        frame.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*_PARTITIONS)
    )
    if rules.file_format == "parquet":
        writer.parquet(path)
    elif rules.file_format == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    elif rules.file_format == "json":
        writer.json(path)
    else:
        raise ValueError(f"unsupported format: {rules.file_format}")
    return path


def is_landed(spark: SparkSession, root: str, rules: EntityRules) -> bool:
    return exists(spark, entity_path(root, rules.source_type, rules.name))


def read_landed(
    spark: SparkSession,
    root: str,
    rules: EntityRules,
    schema: StructType | None = None,
    batch_id: str | None = None,
) -> DataFrame:
    """Landed rows of every batch, or of one batch, of which only its own folder is listed.

    Table batches are Parquet and bring their own types; `schema` overrides them. Feed batches
    are text: CSV columns are bound by name, JSON is read with the schema of the feed. Partition
    values are text, whatever they look like.
    """
    path = entity_path(root, rules.source_type, rules.name)
    where = path
    if batch_id is not None and _PLAIN_NAME.fullmatch(batch_id):
        where = join(path, "ingestion_date=*", f"batch_id={batch_id}")
        if not matches(spark, where):
            where = path  # no such batch: the filter below gives no rows
    reader = spark.read.option("basePath", path)
    if rules.file_format == "parquet":
        if schema is None:
            # A table of which only empty batches were landed has no file to tell its columns.
            filled = matches(spark, join(where, "*.parquet") if where != path else join(
                path, "ingestion_date=*", "batch_id=*", "*.parquet"
            ))
            schema = reader.parquet(where).schema if filled else StructType([])
        full = _with_lineage_fields(schema)
        frame = reader.schema(full).parquet(where)
    elif rules.file_format == "csv":
        frame = feeds.read_csv(spark, where, quote_escape='"', base=path, lines=rules.multi_line)
        if schema is not None:
            frame = bind_by_name(frame, schema)
    elif rules.file_format == "json":
        if schema is None:
            raise ValueError("reading a JSON feed needs its schema")
        if CORRUPT not in schema.names:
            schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
        frame = reader.schema(_with_lineage_fields(schema)).json(where)
    else:
        raise ValueError(f"unsupported format: {rules.file_format}")
    return frame if batch_id is None else frame.where(F.col("batch_id") == batch_id)


def _with_lineage_fields(schema: StructType) -> StructType:
    """The schema with all lineage columns, partition values as text."""
    known = [
        StructField(field.name, StringType()) if field.name in _PARTITIONS else field
        for field in schema.fields
    ]
    names = {field.name for field in known}
    extra = [StructField(name, StringType()) for name in LINEAGE_COLUMNS if name not in names]
    return StructType([*known, *extra])


def changed_since(
    frame: DataFrame,
    entity: str,
    watermark: object | None = None,
    look_back: str | None = None,
    landed: DataFrame | None = None,
) -> DataFrame:
    """Rows past the high-water mark, strictly; the whole frame for full loads.

    A plain comparison on the column reaches a Parquet scan or a JDBC source as a pushed filter.

    A source may commit a row after others with later change times were extracted. With `look_back`,
    an interval such as "2 days", rows that changed within it before the mark are looked at again,
    and those `landed` does not have, by key and change time, are taken as well. Only the keys
    and times of that stretch are read from `landed`.
    """
    mode, column = SOURCE_TABLES[entity]
    if mode != "incremental" or column is None or watermark is None:
        return frame
    if look_back is None or landed is None:
        return frame.where(F.col(column) > F.lit(watermark))
    mark = F.lit(watermark).cast(frame.schema[column].dataType)
    since = F.col(column) > mark - F.expr(f"interval {look_back}")
    key = [rules_of(entity).key, column]
    known = landed.where(since).select(*[
        F.col(name).cast(frame.schema[name].dataType).alias(name) for name in key
    ])
    late = frame.where(since & (F.col(column) <= mark)).join(known, key, "left_anti")
    return frame.where(F.col(column) > mark).unionByName(late.select(*frame.columns))


def rules_of(entity: str) -> EntityRules:
    if entity not in ENTITIES:
        raise KeyError(f"unknown entity: {entity}")
    return ENTITIES[entity]
