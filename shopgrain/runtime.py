"""Session, shared work folder and plan-size helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from shopgrain.sources import files

T = TypeVar("T")
R = TypeVar("R")

# Independent tables worked on at the same time.
TABLES_AT_ONCE = 5

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where an aggregate would have reused its partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Building a plan takes half the time without a Python stack trace per column.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Sizes from here on are what Catalyst gives sources without statistics, and products of them.
_UNKNOWN_BYTES = 1 << 50

_BYTE_UNITS = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def get_session(app: str = "shopgrain", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect. `conf` keys use `__` in place of dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the folder the cluster shares (`spark.checkpoint.dir`).

    A machine-local folder is used only in local mode, where no other machine has to see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="shopgrain-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/shopgrain/{label}-{uuid.uuid4().hex[:12]}"


def written(
    frame: DataFrame, label: str, partition_by: tuple[str, ...] = (), under: str | None = None
) -> DataFrame:
    """Write `frame` once to the work folder and continue from the files.

    Later steps neither recompute the plan nor depend on executors that may be lost, and the
    planner knows the true size of what it reads. `under` is a folder of `staging`.
    """
    spark = frame.sparkSession
    path = work_folder(spark, label) if under is None else f"{under}/{label}-{uuid.uuid4().hex[:8]}"
    writer = frame.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession, label: str) -> Iterator[str]:
    """A work folder for the duration of a job step; its files are removed afterwards."""
    folder = work_folder(spark, label)
    try:
        yield folder
    finally:
        files.delete(spark, folder)


def broadcast_limit(spark: SparkSession) -> int:
    """`spark.sql.autoBroadcastJoinThreshold` in bytes; -1 when broadcasting is off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    digits = text.rstrip("bkmgt")
    unit = text[len(digits):].replace("b", "") or "b"
    return int(digits) * _BYTE_UNITS[unit]


def planned_bytes(frame: DataFrame) -> int | None:
    """Catalyst's size estimate of `frame`, or None where the session does not expose it."""
    java_frame = getattr(frame, "_jdf", None)
    if java_frame is None:
        return None
    return int(str(java_frame.queryExecution().optimizedPlan().stats().sizeInBytes()))


def tasks_for(frame: DataFrame, bytes_each: int) -> int:
    """Tasks to deal `frame` to, so that each gets about `bytes_each` of the size Catalyst expects.

    At least as many as the cluster runs at once. A size it does not know counts as the session's
    number of shuffle partitions.
    """
    spark = frame.sparkSession
    at_once = spark.sparkContext.defaultParallelism
    size = planned_bytes(frame)
    if size is None or size >= _UNKNOWN_BYTES:
        return max(at_once, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(at_once, -(-size // bytes_each))


# A broadcast may take so many times the session's limit of bytes as a hash table in memory.
HELD_TIMES = 4


def held_bytes(schema: StructType, rows: int) -> int:
    """About what the hash table of a broadcast of so many rows takes, on the driver and on every
    executor: 16 bytes for each row, and 40 for each value, which lies there as key and as row."""

    def values(kind: DataType) -> int:
        return sum(values(f.dataType) for f in kind.fields) if isinstance(kind, StructType) else 1

    return rows * (16 + 40 * values(schema))


def fits_broadcast(frame: DataFrame) -> bool:
    """Whether the planner itself would broadcast `frame` in a join."""
    size = planned_bytes(frame)
    return size is not None and size <= broadcast_limit(frame.sparkSession)


def too_long(frame: DataFrame, rows: int | None) -> bool:
    """Whether so many rows, where known, are too much for a broadcast. The planner goes by the size
    of files, which hold keys in a fraction of the memory."""
    if rows is None:
        return False
    return held_bytes(frame.schema, rows) > HELD_TIMES * max(broadcast_limit(frame.sparkSession), 0)


def unless_long(lookup: DataFrame, rows: int) -> DataFrame:
    """`lookup`, which has so many rows, for a join that is not to broadcast it where it is longer
    than its files suggest."""
    return lookup.hint("merge") if too_long(lookup, rows) and fits_broadcast(lookup) else lookup


def for_each_table(
    spark: SparkSession, work: Callable[[T], R], tables: Iterable[T], at_once: int = TABLES_AT_ONCE
) -> list[R]:
    """Run `work` for independent tables, a few at a time; results come in the order of `tables`.

    Spark runs jobs submitted from several threads side by side, so a small table does not leave
    the executors idle while the next one waits. The first failure is raised.
    """
    target = inheritable_thread_target(spark)(work)
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return list(pool.map(target, list(tables)))


def literal_rows(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A small frame of literals that needs no Python worker to read."""
    schema = StructType.fromDDL(ddl)
    if not rows:
        return spark.range(0).select(
            *[F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields]
        )
    structs = [
        F.struct(
            *[
                F.lit(value).cast(field.dataType).alias(field.name)
                for field, value in zip(schema.fields, row, strict=True)
            ]
        )
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
