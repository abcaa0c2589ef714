"""Incremental intake of the event feed with Structured Streaming.

Each micro-batch is checked like a landed batch and upserted into the same silver table, so no
event is too late to be taken in. The stream's only state are fingerprints of recent deliveries, so
that one that comes again unchanged goes no further; they expire, and state does not grow with the
history.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopgrain.operators.latest import latest_per_key
from shopgrain.operators.quality import annotate, mark_orphans, split
from shopgrain.rules import CORRUPT, LINEAGE_COLUMNS, PROCESSED_AT, EntityRules
from shopgrain.runtime import staging, written
from shopgrain.sources import files, snapshots
from shopgrain.sources.directory import KEY, MONTH, KeyDirectory
from shopgrain.sources.landing import Batch, with_lineage

# Key of the rejected deliveries: a hash of what was delivered.
DELIVERY = "delivery"
ARRIVED = "_arrived"
# Times to the microsecond: deliveries that differ in less are one.
_EXACT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _fingerprint(columns: list[str], *more: str) -> Column:
    """SHA-256 of the columns' values, under which unequal deliveries are not taken for one."""
    given = F.to_json(F.struct(*columns), _EXACT_TIMES)
    return F.sha2(F.concat_ws("\n", given, *[F.lit(text) for text in more]), 256)


def without_repeats(stream: DataFrame, within: str, judged_by: str = "") -> DataFrame:
    """Deliveries that did not arrive before, unchanged, in about the last `within`.

    The state store holds a fingerprint for each delivery until that time after its arrival is
    over. Time is that of arrival, so no delivery is late, whatever its event time. Deliveries
    judged by something else than the ones before, which `judged_by` names, are not repeats.
    """
    return (
        stream.withColumns({
            DELIVERY: _fingerprint(stream.columns, judged_by), ARRIVED: F.current_timestamp(),
        })
        .withWatermark(ARRIVED, within)
        .dropDuplicatesWithinWatermark([DELIVERY])
        .drop(DELIVERY, ARRIVED)
    )


def _add_rejected(marked: DataFrame, path: str, part: str, key_buckets: int, folder: str) -> None:
    """Add the rejected deliveries that are not stored yet, as the micro-batch's own part.

    With `key_buckets` a directory of (delivery, part) tells which are stored; otherwise the keys of the
    stored ones are read. What the same micro-batch stored when it ran before does not count and is
    replaced. Pairs follow the rows: a stop between the two is made good when the batch runs again.
    """
    spark = marked.sparkSession
    fresh = latest_per_key(marked, [DELIVERY])
    directory = KeyDirectory(spark, files.join(path, "keys"), key_buckets) if key_buckets else None
    if snapshots.has_snapshot(spark, path):
        if directory is not None and directory.exists():
            fresh = written(fresh, "rejected", under=folder)
            known = directory.of(fresh.select(DELIVERY)).where(F.col(MONTH) != part)
            known = known.select(F.col(KEY).alias(DELIVERY))
        else:
            known = snapshots.read_snapshot(spark, path, without=part).select(DELIVERY)
        fresh = fresh.join(known, DELIVERY, "left_anti")
    fresh = written(fresh, "fresh", under=folder)
    if fresh.isEmpty():
        return
    snapshots.append(fresh, path, part)
    if directory is not None:
        if directory.exists():
            directory.add(fresh.select(DELIVERY, F.lit(part)))
        else:  # also for what was stored before there was a directory
            stored = snapshots.read_snapshot(spark, path, without=part)
            directory.build(
                stored.select(DELIVERY, F.lit("")).union(fresh.select(DELIVERY, F.lit(part)))
            )


def ingest_available(
    stream: DataFrame,
    rules: EntityRules,
    accepted_path: str,
    rejected_path: str,
    checkpoint: str,
    source_system: str,
    event_time: str = "event_timestamp",
    parent_path: Callable[[str], str] | None = None,
    key_buckets: int = 0,
    repeats_within: str | None = None,
) -> None:
    """Take in every file that arrived since the last run, then stop.

    Every delivery goes through the row rules of a batch run and, with `parent_path`, its foreign
    keys are checked against the parents stored when the run starts. Of the accepted deliveries of an
    event the one with the latest time counts, ties settled by its other columns; it is upserted into
    the snapshot at `accepted_path`, which is the silver table. Rejected deliveries are added at
    `rejected_path`, each different one once; a corrected delivery is accepted like any other. So
    both tables are the same however the files are cut into micro-batches, and a micro-batch that
    runs twice changes nothing.

    A landed batch rejects all copies of a key, because a table extract must not hold any. A feed
    may deliver an event again, so here copies are no fault. With `key_buckets` the months of events
    delivered before, and the rejected deliveries that are stored, come from key directories instead of
    the tables (see `snapshots.upsert`).

    `repeats_within`, such as "7 days", has the state store drop deliveries that come again unchanged
    within that time, before anything else is done with them. A delivery counts as changed where the
    rules or the stored parents are others than before, as it may be accepted now. State is divided by
    the shuffle partitions of the first run. A checkpoint is either with or without it from the start.
    """
    spark = stream.sparkSession
    parents, states = {}, []
    for key in rules.foreign_keys if parent_path else ():
        path = parent_path(key.parent)
        state = snapshots.current_version(spark, path)
        states.append(state.number if state else None)
        if state:
            parents[key.parent] = snapshots.read_snapshot(spark, path)
    if repeats_within is not None:
        stream = without_repeats(stream, repeats_within, f"{rules}{states}")

    def store(rows: DataFrame, epoch: int) -> None:
        spark = rows.sparkSession
        landed = with_lineage(rows, Batch.start(prefix=f"stream-{epoch}"), source_system, "stream")
        with staging(spark, "stream") as folder:
            if repeats_within is not None:
                landed = written(landed, "landed", under=folder)  # the state store runs once
                if landed.isEmpty():
                    return
            checked = annotate(landed, rules, "none")
            for key in rules.foreign_keys:
                if key.parent in parents:
                    checked = mark_orphans(
                        checked, key, parents[key.parent], key_source=landed,
                        settle=lambda keys: written(keys, "orphans", under=folder), under=folder,
                    )
            valid, rejected = split(written(checked, "checked", under=folder))
            newest = latest_per_key(valid.drop(CORRUPT), [rules.key], (event_time,))
            snapshots.upsert(
                newest, accepted_path, [rules.key], newer_by=(event_time,), verify=False,
                month_of=event_time, key_buckets=key_buckets,
            )
            given = [c for c in rejected.columns if c not in (*LINEAGE_COLUMNS, PROCESSED_AT)]
            # The checkpoint's own name keeps the parts of different streams apart.
            stream_id = json.loads(files.read_text(spark, files.join(checkpoint, "metadata")))["id"]
            _add_rejected(
                rejected.withColumn(DELIVERY, _fingerprint(given)), rejected_path,
                f"{stream_id}-{epoch}", key_buckets, folder,
            )

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
    )
    query.awaitTermination()


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    pattern: str,
    fmt: str = "json",
    files_at_once: int | None = None,
) -> DataFrame:
    """Files of a folder as a stream; `files_at_once` limits a micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern).format(fmt)
    if files_at_once is not None:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    return reader.load(folder)


def as_event_time(stream: DataFrame, column: str) -> DataFrame:
    return stream.withColumn(column, F.try_to_timestamp(F.col(column)))
