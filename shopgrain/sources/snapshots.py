"""Current-state tables: keyed upsert, overwrite and append on plain Parquet folders.

A snapshot is a folder of parts and a folder of versions. A version is a small file, written last,
that lists the part folders of the state and its schema; the highest one is current. Parts are
never changed, so readers of a version are not disturbed, and a write that stops half way leaves
nothing but a folder that no version lists. Running it again completes it.

A table's registry entry says whether it is divided by the month of a column: then an upsert
writes new parts for the months it touches and goes on listing the others. All other tables are one
part.

Where the catalog has tables with row-level operations, `merge_into` uses those.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shopgrain.operators.latest import latest_per_key
from shopgrain.runtime import staging, unless_long, written
from shopgrain.sources.directory import KeyDirectory
from shopgrain.sources.files import delete, join, matches, names, read_text, write_text

# Folder column of a part; not part of the table's own columns.
MONTH = "state_month"
# The letter keeps partition discovery from reading the value as a date.
MONTH_FORMAT = "'m'yyyy-MM"
# The part name of tables that are not divided.
WHOLE = "all"
# Prefix of parts that were appended one by one and put together since.
TOGETHER = "together-"
# Appended parts that lie side by side before they are put together.
APPENDED_PARTS = 64

# Partition columns of rejected rows.
REJECTED_BY = ("ingestion_date", "batch_id")

# The current version and the one before it, which running readers may still use.
KEPT_VERSIONS = 2


class DuplicateKeys(ValueError):
    """The rows to upsert hold a key more than once."""


@dataclass(frozen=True)
class Upserted:
    """The state after an upsert, None if there has never been a row, and the rows it took in."""

    state: DataFrame | None
    rows: int


@dataclass(frozen=True)
class Version:
    """One state: its number, schema and part folders relative to the snapshot."""

    number: int
    schema: StructType
    parts: dict[str, str]


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of committed versions, oldest first."""
    found = names(spark, join(path, "versions"))
    return sorted(int(name[1:9]) for name in found if name.endswith(".json"))


def _version(spark: SparkSession, path: str, number: int) -> Version:
    entry = json.loads(read_text(spark, join(path, "versions", f"v{number:08d}.json")))
    return Version(number, StructType.fromJson(entry["schema"]), entry["parts"])


def current_version(spark: SparkSession, path: str) -> Version | None:
    committed = versions(spark, path)
    return _version(spark, path, committed[-1]) if committed else None


def months(spark: SparkSession, path: str) -> list[str]:
    """Month values of a snapshot that is divided by month."""
    version = current_version(spark, path)
    return sorted(set(version.parts) - {WHOLE}) if version else []


def month_parts(spark: SparkSession, path: str) -> dict[str, str]:
    """The part folder of each month; a month that was written anew has a new one."""
    version = current_version(spark, path)
    return {} if version is None else {m: f for m, f in version.parts.items() if m != WHOLE}


def read_months(spark: SparkSession, path: str, wanted: set[str]) -> DataFrame:
    """Rows of some months, with their month in the column `MONTH`."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no snapshot at {path}")
    rows = None
    # Months written together lie below one folder and are read as one table.
    below: dict[str, list[str]] = {}
    for month in sorted(wanted & set(version.parts)):
        below.setdefault(version.parts[month].rsplit("/", 1)[0], []).append(version.parts[month])
    schema = StructType([*version.schema.fields, StructField(MONTH, StringType())])
    for base, folders in below.items():
        part = spark.read.schema(schema).option("basePath", join(path, base)).parquet(
            *[join(path, folder) for folder in folders]
        )
        rows = part if rows is None else rows.unionByName(part)
    return spark.createDataFrame([], schema) if rows is None else rows


def replace_months(frame: DataFrame, path: str, touched: set[str]) -> DataFrame:
    """Put the rows of `frame`, which has the column `MONTH`, in place of the months `touched`.

    All its months must be among those. One without rows is no longer listed. A table that was
    not divided before is replaced as a whole. A single month needs no rebalancing.
    """
    spark = frame.sparkSession
    before = current_version(spark, path)
    parts = {} if before is None else {
        m: f for m, f in before.parts.items() if m != WHOLE and m not in touched
    }
    number = _next_number(spark, path)
    folder = f"parts/v{number:08d}"
    by_month = frame.hint("rebalance", MONTH) if len(touched) > 1 else frame
    by_month.write.mode("errorifexists").partitionBy(MONTH).parquet(join(path, folder))
    prefix = f"{MONTH}="
    for name in names(spark, join(path, folder)):
        if name.startswith(prefix):
            parts[name.removeprefix(prefix)] = f"{folder}/{name}"
    version = Version(number, frame.drop(MONTH).schema, parts)
    _commit(spark, path, version)
    return _state(spark, path, version)


def has_snapshot(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path))


def read_snapshot(spark: SparkSession, path: str, without: str | None = None) -> DataFrame:
    """The current state; `without` leaves out the part of that name."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no snapshot at {path}")
    return _read(spark, path, version, [part for part in version.parts if part != without])


def append(source: DataFrame, path: str, part: str, side_by_side: int = APPENDED_PARTS) -> None:
    """Add rows as a part of their own, in place of an earlier part of that name.

    No other part is read, but for once in `side_by_side` appends: then those that were appended since
    become one, which is never written again.
    """
    spark = source.sparkSession
    before = current_version(spark, path)
    parts: dict[str, str] = {} if before is None else dict(before.parts)
    schema = source.schema
    number = _next_number(spark, path)
    folder = f"parts/v{number:08d}"
    source.write.mode("errorifexists").parquet(join(path, folder, "added"))
    if before is not None:
        later = [f for f in schema.fields if f.name not in before.schema.fieldNames()]
        schema = StructType([*before.schema.fields, *later])
        small = [name for name in parts if name != part and not name.startswith(TOGETHER)]
        if len(small) >= side_by_side:
            _read(spark, path, before, small).write.mode("errorifexists").parquet(
                join(path, folder, "together")
            )
            parts = {name: at for name, at in parts.items() if name not in small}
            parts[f"{TOGETHER}{number:08d}"] = f"{folder}/together"
    parts[part] = f"{folder}/added"
    _commit(spark, path, Version(number, schema, parts))


def _read(spark: SparkSession, path: str, version: Version, parts: list[str]) -> DataFrame:
    """Rows of some parts with the version's schema: a part written before a column was added has
    nulls there."""
    folders = [join(path, version.parts[part]) for part in parts]
    reader = spark.read.schema(version.schema)
    return reader.parquet(*folders) if folders else spark.createDataFrame([], version.schema)


def _next_number(spark: SparkSession, path: str) -> int:
    """Above every version and every part folder, committed or not."""
    parts = [int(name[1:]) for name in names(spark, join(path, "parts")) if name[1:].isdigit()]
    return max([0, *versions(spark, path), *parts]) + 1


def _commit(spark: SparkSession, path: str, version: Version) -> None:
    entry = {"schema": version.schema.jsonValue(), "parts": version.parts}
    target = join(path, "versions", f"v{version.number:08d}.json")
    write_text(spark, target, json.dumps(entry, sort_keys=True))
    committed = versions(spark, path)
    kept = [_version(spark, path, n) for n in committed[-KEPT_VERSIONS:]]
    listed = {folder for v in kept for folder in v.parts.values()}
    for number in committed[:-KEPT_VERSIONS]:
        old = _version(spark, path, number)
        for folder in set(old.parts.values()) - listed:
            delete(spark, join(path, folder))
        delete(spark, join(path, "versions", f"v{number:08d}.json"))


def overwrite(frame: DataFrame, path: str) -> DataFrame | None:
    """Write a new version and return the current state; rows of the old one are replaced.

    A frame without rows changes nothing: its part is taken back after the write, which costs
    less than running the whole plan once more beforehand to see whether it yields anything.
    """
    spark = frame.sparkSession
    number = _next_number(spark, path)
    part = f"parts/v{number:08d}"
    frame.write.mode("errorifexists").parquet(join(path, part))
    state = spark.read.schema(frame.schema).parquet(join(path, part))
    if state.isEmpty():
        delete(spark, join(path, part))
        return read_snapshot(spark, path) if has_snapshot(spark, path) else None
    _commit(spark, path, Version(number, frame.schema, {WHOLE: part}))
    return state


def merged(target: DataFrame, source: DataFrame, key: list[str], rows: int) -> DataFrame:
    """Source rows, of which there are `rows`, and the target rows whose key the source does not have."""
    kept = target.join(unless_long(source.select(*key), rows), key, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def upsert(
    source: DataFrame,
    path: str,
    key: list[str],
    newer_by: tuple[str, ...] = (),
    verify: bool = True,
    month_of: str | None = None,
    settled: bool = False,
    rows: int | None = None,
    key_buckets: int = 0,
) -> Upserted:
    """Update rows by key and insert new ones.

    `month_of` names the date column that divides the table by month; it must stay the same for a
    table. An empty source changes nothing. `newer_by` keeps a stored row that is newer than the
    incoming one. `verify` refuses a source that repeats a key; skip it for a source that was
    deduplicated on that key. A merge reads the source more than once, so it is written once first,
    unless it is `settled`: read from files as it is. `rows` is how many there are, where known.
    With `key_buckets`, a table divided by month and with one key column keeps a directory of its keys
    in that many buckets, and an upsert finds the months it touches there instead of in the table.
    """
    spark = source.sparkSession
    before = current_version(spark, path)
    if before is not None and (WHOLE in before.parts) == (month_of is not None):
        raise ValueError(f"{path}: divided by month or not must stay as it is")
    with staging(spark, "upsert") as folder:
        if not settled:
            source = written(source, "source", under=folder)
        if verify and not repeated_rows(source, key).isEmpty():
            raise DuplicateKeys(f"{path}: source repeats {', '.join(key)}")
        rows = source.count() if rows is None else rows
        if not rows:
            return Upserted(None if before is None else _state(spark, path, before), 0)
        if month_of is None:
            fresh = source
            if before is not None:
                fresh = _put(_read(spark, path, before, [WHOLE]), source, key, newer_by, rows)
            return Upserted(overwrite(fresh, path), rows)
        state = _upsert_months(source, path, key, newer_by, month_of, before, key_buckets, rows)
        return Upserted(state, rows)


def _state(spark: SparkSession, path: str, version: Version) -> DataFrame:
    return _read(spark, path, version, list(version.parts))


def _put(
    target: DataFrame, source: DataFrame, key: list[str], newer_by: tuple[str, ...], rows: int
) -> DataFrame:
    if not newer_by:
        return merged(target, source, key, rows)
    return latest_per_key(target.unionByName(source, allowMissingColumns=True), key, newer_by)


def month_column(frame: DataFrame, name: str) -> Column:
    """The month a row belongs to; "none" without a date, or where `name` is not a column."""
    if name not in frame.columns:
        return F.lit("none")
    moment = F.col(name).try_cast("timestamp")
    return F.coalesce(F.date_format(moment, MONTH_FORMAT), F.lit("none"))


def _upsert_months(
    incoming: DataFrame,
    path: str,
    key: list[str],
    newer_by: tuple[str, ...],
    month_of: str,
    before: Version | None,
    key_buckets: int,
    rows: int,
) -> DataFrame:
    """Write new parts for the months that hold a changed row, or held it before its month changed.

    Finding them reads the key directory or, without one, the key and the date of the table. The
    months come to the driver; there are no more of them than part folders. A month whose last
    rows moved away is no longer listed.
    """
    spark = incoming.sparkSession
    parts: dict[str, str] = {} if before is None else dict(before.parts)
    fresh = incoming
    directory = None
    if key_buckets:
        (name,) = key
        directory = KeyDirectory(spark, join(path, "keys"), key_buckets)
        if before is not None and not directory.exists():
            current = _state(spark, path, before)
            directory.build(current.select(name, month_column(current, month_of)))
    if before is not None:
        if directory is None:
            current = _state(spark, path, before)
            held = current.join(unless_long(incoming.select(*key), rows), key, "left_semi")
            holding = held.select(month_column(held, month_of))
        else:
            holding = directory.months(incoming.select(*key))
        touched = holding.union(incoming.select(month_column(incoming, month_of)))
        touched = {row[0] for row in touched.distinct().collect()}
        old = _read(spark, path, before, sorted(touched & set(parts)))
        fresh = _put(old, incoming, key, newer_by, rows)
        parts = {name: folder for name, folder in parts.items() if name not in touched}
    number = _next_number(spark, path)
    folder = f"parts/v{number:08d}"
    # Rebalancing gives each month files of even size and splits a month that holds most rows. Rows
    # of a table without the column are all of one month: they stay in the tasks they are in.
    dated = fresh.withColumn(MONTH, month_column(fresh, month_of))
    if month_of in fresh.columns:
        dated = dated.hint("rebalance", MONTH)
    dated.write.mode("errorifexists").partitionBy(MONTH).parquet(join(path, folder))
    prefix = f"{MONTH}="
    for name in names(spark, join(path, folder)):
        if name.startswith(prefix):
            parts[name.removeprefix(prefix)] = f"{folder}/{name}"
    if directory is not None:
        directory.add(incoming.select(*key, month_column(incoming, month_of)))
    version = Version(number, fresh.schema, parts)
    _commit(spark, path, version)
    return _state(spark, path, version)


def repeated_rows(frame: DataFrame, key: list[str]) -> DataFrame:
    return frame.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")


def merge_into(source: DataFrame, table: str, key: list[str]) -> None:
    """The same upsert as one MERGE, for catalogs whose tables support it."""
    match = [F.col(f"{table}.{name}") == F.col(f"source.{name}") for name in key]
    condition = match[0]
    for term in match[1:]:
        condition = condition & term
    (
        source.alias("source")
        .mergeInto(table, condition)
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


def append_rejected(
    rejected: DataFrame, path: str, batch_id: str, ingestion_date: str, rows: int | None = None
) -> str:
    """Add rejected rows under the partition of a batch; returns "" when there are none. `rows` is
    how many there are, where known.

    The batch's own partition is replaced, also by nothing: a repeated run neither adds its rows
    twice nor leaves rows there that are no longer rejected.
    """
    spark = rejected.sparkSession
    target = join(path, f"ingestion_date={ingestion_date}", f"batch_id={batch_id}")
    if rejected.isEmpty() if rows is None else not rows:
        delete(spark, target)
        return ""
    rejected.drop(*REJECTED_BY).write.mode("overwrite").parquet(target)
    return target


def replace_rejected(rejected: DataFrame, path: str) -> str:
    """Rejected rows of all batches, each under its own batch; returns "" when there are none."""
    spark = rejected.sparkSession
    if rejected.isEmpty():
        delete(spark, path)
        return ""
    (
        rejected.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*REJECTED_BY)
        .parquet(path)
    )
    return path


def release_rejected(spark: SparkSession, path: str, released: DataFrame, key: list[str]) -> None:
    """Take rows out of the partitions of their batches; `released` holds `key` and the partition
    columns.

    The batches touched are read once and written once, all together, from a staged copy of the
    rows that stay; one that gives all its rows back loses its folder.
    """
    columns = [*key, *REJECTED_BY]
    with staging(spark, "released") as folder:
        gone = written(released.select(*columns).distinct(), "gone", under=folder)
        # One entry for each batch that gives rows back.
        touched = {tuple(row) for row in gone.select(*REJECTED_BY).distinct().collect()}
        rows = read_rejected(spark, path)
        days, batches = ([pair[k] for pair in touched] for k in (0, 1))
        mine = rows.where(F.col("ingestion_date").isin(days) & F.col("batch_id").isin(batches))
        stays = written(staying(mine, gone, key), "stays", under=folder)
        left = {tuple(row) for row in stays.select(*REJECTED_BY).distinct().collect()}
        if left:
            stays.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                *REJECTED_BY
            ).parquet(path)
        for day, batch in touched - left:
            delete(spark, join(path, f"ingestion_date={day}", f"batch_id={batch}"))


def staying(rows: DataFrame, gone: DataFrame, key: list[str]) -> DataFrame:
    """Rows of the batches `gone` names, without those it names by `key` and batch.

    The batches, one row each, are broadcast whatever the planner expects of them: dealt by batch,
    the rows of one would all meet in one task. `gone` is read from files, so counting it is cheap.
    """
    batches = F.broadcast(gone.select(*REJECTED_BY).distinct())
    return rows.join(batches, [*REJECTED_BY], "left_semi").join(
        unless_long(gone, gone.count()), [*key, *REJECTED_BY], "left_anti"
    )


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """Rejected rows of every run, with the run's partition values as text."""
    found = spark.read.parquet(path).schema
    text = [
        StructField(f.name, StringType()) if f.name in REJECTED_BY else f for f in found.fields
    ]
    return spark.read.schema(StructType(text)).parquet(path)


def rejected_rows(spark: SparkSession, path: str, wanted: DataFrame, key: list[str]) -> DataFrame:
    """The rejected rows that `wanted`, read from files, names by `key` and batch; only their batches'
    folders are read."""
    # One entry for each batch that is named.
    pairs = [tuple(row) for row in wanted.select(*REJECTED_BY).distinct().collect()]
    days, batches = ([pair[k] for pair in pairs] for k in (0, 1))
    rows = read_rejected(spark, path).where(
        F.col("ingestion_date").isin(days) & F.col("batch_id").isin(batches)
    )
    columns = [*key, *REJECTED_BY]
    named = unless_long(wanted.select(*columns), wanted.count())
    return rows.join(named, columns, "left_semi")


def has_rejected(spark: SparkSession, path: str) -> bool:
    """Whether any batch has rejected rows."""
    return matches(spark, join(path, "ingestion_date=*", "batch_id=*", "*.parquet"))
