"""The daily jobs: ingest, silver, gold, publish, SQL models, reconcile.

Each step writes its result once and the next one reads the files, so nothing is computed twice and
row counts come from file footers. The only values that reach the driver are counts, watermarks and
run identifiers, one per table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopgrain.functions.expressions import upper_names
from shopgrain.operators import reconcile as rec
from shopgrain.operators.checks import key_tests, nulls, orphans, report, unique
from shopgrain.operators.compare import differing_rows
from shopgrain.operators.latest import latest_per_key
from shopgrain.operators.lookup import lookup_join
from shopgrain.operators.quality import annotate, mark_orphans, standardise
from shopgrain.plans import dims, facts, increments, marts, sqlmodels
from shopgrain.rules import (
    CORRUPT,
    ENTITIES,
    ENTITY_GROUPS,
    FOREIGN_KEY_TESTS,
    GOLD_OF,
    LATEST_ORDER,
    MART_TESTS,
    MONTH_OF,
    PROCESSED_AT,
    REASON,
    SOURCE_FEEDS,
    SOURCE_TABLES,
    TABLE_SOURCE_SYSTEM,
    TABLES,
    BusinessRules,
    EntityRules,
)
from shopgrain.runtime import for_each_table, literal_rows, staging, written
from shopgrain.schemas import entity_schema
from shopgrain.sources import feeds, landing, manifests, snapshots
from shopgrain.sources.files import exists, join
from shopgrain.sources.landing import Batch
from shopgrain.sources.manifests import TableRun
from shopgrain.sources.snapshots import REJECTED_BY


@dataclass(frozen=True)
class Paths:
    """Roots of the layers, on storage all executors reach."""

    bronze: str
    silver: str
    gold: str
    warehouse: str = ""

    @classmethod
    def under(cls, root: str) -> Paths:
        return cls(*[join(root, name) for name in ("bronze", "silver", "gold", "warehouse")])

    def silver_table(self, entity: str) -> str:
        return join(self.silver, ENTITIES[entity].source_type, entity)

    def rejected(self, entity: str) -> str:
        return join(self.silver, "quarantine", entity)

    def waiting(self, entity: str) -> str:
        """Keys of rejected rows that only wait for a parent, with the parent keys they name."""
        return join(self.silver, "waiting", entity)

    def gold_table(self, table: str) -> str:
        return join(self.gold, TABLES[table].layer, table)


@dataclass
class Run:
    batch_id: str
    ingestion_date: str
    tables: list[TableRun] = field(default_factory=list)

    @property
    def total_rows(self) -> int:
        return sum(table.row_count for table in self.tables)

    @property
    def total_rejected(self) -> int:
        return sum(table.rejected_count for table in self.tables)


def run_ingest(
    spark: SparkSession,
    paths: Paths,
    tables: dict[str, DataFrame] | None = None,
    feed_folders: dict[str, str] | None = None,
    watermarks: dict[str, str] | None = None,
    batch: Batch | None = None,
    feed_shapes: dict[str, str] | None = None,
    look_back: str | None = None,
) -> Run:
    """Land source tables and file feeds with lineage columns under one batch id.

    Incremental tables start at `watermarks`, or else at the marks earlier runs recorded. A JSON
    feed whose shape ("lines" or "arrays") its rules or `feed_shapes` give is not scanned to find
    it out. `look_back`, an interval such as "2 days", also lands rows from before the mark that no
    earlier batch has (see `landing.changed_since`).
    """
    batch = batch or Batch.start()
    run = Run(batch.batch_id, batch.ingestion_date)
    tables, feed_folders = tables or {}, feed_folders or {}
    marks = manifests.stored_watermarks(spark, paths.bronze) if watermarks is None else watermarks

    def land_one(entity: str) -> TableRun:
        rules = landing.rules_of(entity)
        if entity in tables:
            landed = None
            if look_back is not None and landing.is_landed(spark, paths.bronze, rules):
                landed = landing.read_landed(spark, paths.bronze, rules).where(
                    F.col("batch_id") != batch.batch_id
                )
            changed = landing.changed_since(
                tables[entity], entity, marks.get(entity), look_back, landed
            )
            enriched = landing.with_lineage(changed, batch, TABLE_SOURCE_SYSTEM, entity)
        else:
            system, pattern = SOURCE_FEEDS[entity]
            folder = feed_folders[entity]
            feeds.require_files(spark, folder, pattern)
            if rules.file_format == "csv":
                frame = feeds.with_file_name(
                    feeds.read_csv(spark, folder, pattern, lines=rules.multi_line)
                )
            else:
                shape = (feed_shapes or {}).get(entity, rules.shape)
                frame = feeds.read_json(spark, folder, entity_schema(entity), pattern, shape)
            enriched = landing.with_lineage(frame, batch, system)
        landing.land(enriched, paths.bronze, rules)
        return _landed(spark, paths, entity, enriched.schema, batch, marks.get(entity))

    run.tables = for_each_table(spark, land_one, [*tables, *feed_folders])
    manifests.write_manifest(
        spark, paths.bronze, "bronze", run.batch_id, run.ingestion_date, run.tables
    )
    return run


def _landed(
    spark: SparkSession,
    paths: Paths,
    entity: str,
    schema: StructType,
    batch: Batch,
    old_mark: str | None,
) -> TableRun:
    """Rows and highest watermark of what the batch landed, from one pass over one column."""
    rules = ENTITIES[entity]
    path = landing.entity_path(paths.bronze, rules.source_type, entity)
    if not exists(spark, path):
        return TableRun(entity, 0, path=path, watermark=old_mark)
    rows = landing.read_landed(spark, paths.bronze, rules, schema, batch.batch_id)
    column = SOURCE_TABLES.get(entity, ("full", None))[1]
    if column is None or column not in rows.columns:
        return TableRun(entity, rows.count(), path=path)
    seen = rows.agg(
        F.count(F.lit(1)).alias("n"), F.max(column).cast("string").alias("mark")
    ).first()
    return TableRun(entity, seen.n, path=path, watermark=seen.mark or old_mark)


def run_silver(
    spark: SparkSession,
    paths: Paths,
    batch_id: str | None = None,
    ingestion_date: str | None = None,
    entities: list[str] | None = None,
    all_batches: bool = False,
    duplicate_scope: str = "batch",
    schemas: dict[str, StructType] | None = None,
    key_buckets: int = 0,
) -> Run:
    """Check the landed rows, set rejected ones aside and upsert the rest by key.

    Without a batch id, everything landed that no silver run has taken in is worked through, batch
    by batch, oldest first, each with a manifest of its own; the run returned adds them up. What is
    left is known per batch and entity: a run over some `entities` leaves the others for later, and
    an entity is entered in the ledger as soon as it is stored, so a run cut short goes on there.
    With a batch id, or with `all_batches`, there is one pass over that batch, or over everything
    landed, whether it was taken in before or not.

    Of the rows of a key the one ingested last is kept, in whatever order batches are worked on.
    Entities run parents first. Only the batch's folder is read. Entities that were never landed
    are skipped. Rows that were rejected only because their parent was unknown come back once it is
    known, also when only the parent is taken in: `rejected_count` is the change of the rows set
    aside, so landed rows are always accepted plus rejected ones. With `key_buckets`, tables divided
    by month keep a directory of their keys in that many hash buckets; choose it so that a bucket's
    keys fit a task.
    """
    if batch_id is None and not all_batches:
        wanted = None if entities is None else [landing.rules_of(name).name for name in entities]
        backlog = manifests.pending_batches(spark, paths.bronze, paths.silver, wanted)
        if not backlog:
            return Run(*manifests.newest_batch(spark, paths.bronze))
        runs = [
            _silver_pass(
                spark, paths, left.batch_id, left.ingestion_date, list(left.entities), False,
                duplicate_scope, schemas, key_buckets,
            )
            for left in backlog
        ]
        return _summed(runs)
    if not (batch_id and ingestion_date):
        newest = manifests.newest_batch(spark, paths.bronze)
        batch_id, ingestion_date = batch_id or newest[0], ingestion_date or newest[1]
    return _silver_pass(
        spark, paths, batch_id, ingestion_date, entities, all_batches, duplicate_scope, schemas,
        key_buckets,
    )


def _summed(runs: list[Run]) -> Run:
    """One run with the counts of several, under the id of the last."""
    total: dict[str, TableRun] = {}
    for table in (table for run in runs for table in run.tables):
        before = total.get(table.table_name, TableRun(table.table_name, 0))
        total[table.table_name] = TableRun(
            table.table_name, before.row_count + table.row_count,
            before.rejected_count + table.rejected_count, table.path,
        )
    return Run(runs[-1].batch_id, runs[-1].ingestion_date, list(total.values()))


def _silver_pass(
    spark: SparkSession,
    paths: Paths,
    batch_id: str,
    ingestion_date: str,
    entities: list[str] | None,
    all_batches: bool,
    duplicate_scope: str,
    schemas: dict[str, StructType] | None,
    key_buckets: int,
) -> Run:
    run = Run(batch_id, ingestion_date)
    wanted = [rules.name for rules in map(landing.rules_of, entities or ENTITIES)]
    reached = manifests.newest_intake(spark, paths.silver)
    taken: list[tuple[str, str, str]] = [("", batch_id, ingestion_date)]
    if all_batches:
        # One entry for each landed batch and entity.
        taken = [tuple(row) for row in manifests.landed_entities(spark, paths.bronze).select(
            "entity", "batch_id", "ingestion_date").collect()]
    parents_changed: set[str] = set()

    def refine(entity: str) -> TableRun | None:
        rules = ENTITIES[entity]
        landed = entity in wanted and landing.is_landed(spark, paths.bronze, rules)
        if not landed and not any(key.parent in parents_changed for key in rules.foreign_keys):
            return None
        aside, state = paths.rejected(entity), paths.silver_table(entity)
        waiting = paths.waiting(entity)
        key = list(rules.identity)
        with staging(spark, f"silver-{entity}") as folder:
            returning = None
            if not all_batches:
                returning = parents_found(
                    spark, rules, aside, paths.silver_table, folder, batch_id if landed else None,
                    waiting,
                )
            if returning is not None:
                returning = returning.drop(REASON, PROCESSED_AT).withColumn(RETURNED, F.lit(True))
            if landed:
                schema = (schemas or {}).get(entity)
                if schema is None and rules.source_type == "file":
                    schema = entity_schema(entity)
                rows = landing.read_landed(
                    spark, paths.bronze, rules, schema, None if all_batches else batch_id
                )
                if returning is not None:
                    rows = rows.unionByName(returning, allowMissingColumns=True)
            elif returning is not None:
                rows = returning
            else:
                return None
            checked = check_rows(
                spark, rows, entity, paths.silver_table, folder, duplicate_scope
            )
            valid, rejected = checked.valid, checked.rejected
            known = reached.get(entity)
            # Nothing stored can be newer than what is newer than all that was taken in.
            later = snapshots.has_snapshot(spark, state) and not (
                returning is None and not all_batches
                and known is not None and checked.newest is not None and known < checked.newest
            )
            if returning is not None:
                back = valid.where(RETURNED)
                # A row that comes back may meet a newer one of its key in the same pass.
                valid = latest_per_key(valid.drop(RETURNED), [rules.key])
                rejected = rejected.where(F.col(RETURNED).isNull()).drop(RETURNED)
            if all_batches and duplicate_scope == "batch":
                # Only then can a key be left more than once; otherwise its copies were rejected.
                valid = latest_per_key(valid, key)
            plain = returning is None and not all_batches
            snapshots.upsert(
                valid,
                state,
                [rules.key],
                newer_by=(*LATEST_ORDER, PROCESSED_AT) if later else (),
                verify=False,
                month_of=MONTH_OF.get(entity),
                settled=plain,
                rows=checked.accepted if plain else None,
                key_buckets=key_buckets if entity in MONTH_OF else 0,
            )
            # Only when they are stored; a run cut short here finds them once more. Waiting keys are
            # entered before their rows and leave after them: one without its row does no harm.
            orphans = waiting_keys(rejected, rules) if rules.foreign_keys else None
            if all_batches:
                if orphans is not None:
                    snapshots.replace_rejected(orphans, waiting)
                snapshots.replace_rejected(rejected, aside)
            elif landed:
                if orphans is not None:
                    snapshots.append_rejected(
                        orphans, waiting, batch_id, ingestion_date, checked.orphans
                    )
                snapshots.append_rejected(
                    rejected, aside, batch_id, ingestion_date, checked.rejections - checked.again
                )
            if returning is not None:
                snapshots.release_rejected(spark, aside, back, key)
                if snapshots.has_rejected(spark, waiting):
                    snapshots.release_rejected(spark, waiting, back, key)
            if landed:
                mine = [(b, day) for name, b, day in taken if name in ("", entity)]
                manifests.record_intake(spark, paths.silver, entity, mine, checked.newest)
            if checked.accepted:
                parents_changed.add(entity)
            # Rows that came back are no longer rejected.
            turned = checked.rejections - checked.again - checked.released
            return TableRun(entity, checked.accepted, turned, state)

    for group in ENTITY_GROUPS:
        results = for_each_table(spark, refine, group)
        run.tables += [result for result in results if result is not None]
    manifests.write_manifest(spark, paths.silver, "silver", batch_id, ingestion_date, run.tables)
    return run


# Marks rows that come back from the rows set aside.
RETURNED = "returned"
# One or more reasons, none but orphan ones.
_ORPHAN_ONLY = r"^orphan_[^|]*(\|orphan_[^|]*)*$"


def waiting_keys(rejected: DataFrame, rules: EntityRules) -> DataFrame:
    """Identity, parent keys and batch of the rows that only wait for a parent.

    An empty batch that landed without a file has none of these columns, and no rows.
    """
    parents = [key.column for key in rules.foreign_keys if key.column in rejected.columns]
    return rejected.where(F.col(REASON).rlike(_ORPHAN_ONLY)).select(
        *dict.fromkeys([
            *[name for name in rules.identity if name in rejected.columns], *parents, *REJECTED_BY
        ])
    )


def parents_found(
    spark: SparkSession,
    rules: EntityRules,
    rejected_path: str,
    parent_path: Callable[[str], str],
    folder: str,
    but_batch: str | None = None,
    waiting_path: str | None = None,
) -> DataFrame | None:
    """Rows set aside for an unknown parent whose parents are all known by now, None without any.

    Those of `but_batch` are left out: the batch is checked anew as a whole. With the keys of the
    waiting rows kept at `waiting_path`, only these keys meet the parents, and of the rejected rows
    only the batches of those that come back are read.
    """
    if not rules.foreign_keys or not snapshots.has_rejected(spark, rejected_path):
        return None
    if waiting_path is not None and not exists(spark, waiting_path):
        # Rows set aside before there was such a list.
        old = snapshots.read_rejected(spark, rejected_path)
        snapshots.replace_rejected(waiting_keys(old, rules), waiting_path)
    kept = waiting_path is not None and snapshots.has_rejected(spark, waiting_path)
    if waiting_path is not None and not kept:
        return None
    if kept:
        rows = snapshots.read_rejected(spark, waiting_path)
    else:
        rows = snapshots.read_rejected(spark, rejected_path).where(
            F.col(REASON).rlike(_ORPHAN_ONLY)
        )
    if but_batch is not None:
        rows = rows.where(F.col("batch_id") != but_batch)
    waiting = rows
    for key in rules.foreign_keys:
        path = parent_path(key.parent)
        if snapshots.has_snapshot(spark, path):
            parent = snapshots.read_snapshot(spark, path)
            known = parent.select(
                F.col(key.parent_column).cast(rows.schema[key.column].dataType).alias(key.column)
            )
            # The files tell how many parents there are.
            rows = lookup_join(
                rows, known, [key.column], "left_semi", key_source=waiting, under=folder,
                lookup_rows=parent.count(),
            )
    found = written(rows, "returning", under=folder)
    if found.isEmpty():
        return None
    return snapshots.rejected_rows(spark, rejected_path, found, list(rules.identity)) if kept else found


@dataclass(frozen=True)
class Checked:
    """Rows of one entity after the checks, both parts read back from one write.

    `accepted` and `rejections` count them; `released` and `again` are those among them that had
    come back from the rows set aside; `orphans` are the other rejections for nothing but an
    unknown parent; `newest` is their latest ingest time.
    """

    valid: DataFrame
    rejected: DataFrame
    accepted: int
    rejections: int
    released: int
    again: int
    orphans: int
    newest: str | None


def check_rows(
    spark: SparkSession,
    rows: DataFrame,
    entity: str,
    parent_path: Callable[[str], str],
    folder: str,
    duplicate_scope: str = "batch",
) -> Checked:
    """Valid and rejected rows of one entity, from one write below `folder` that counts them too.

    Foreign keys are checked against the stored state of the parents, which earlier entities of the
    same run have already updated; a parent without any state is not checked.
    """
    rules = ENTITIES[entity]
    clean = standardise(rows)
    annotated = annotate(
        rows, rules, duplicate_scope, lambda keys: written(keys, "repeated", under=folder), folder
    )
    for key in rules.foreign_keys:
        path = parent_path(key.parent)
        if key.column in annotated.columns and snapshots.has_snapshot(spark, path):
            annotated = mark_orphans(
                annotated,
                key,
                snapshots.read_snapshot(spark, path),
                key_source=clean,
                settle=lambda keys: written(keys, "orphans", under=folder),
                under=folder,
            )
    good = F.col("accepted")
    back = F.col(RETURNED) if RETURNED in annotated.columns else F.lit(False)
    ingested = F.col(LATEST_ORDER[0]) if LATEST_ORDER[0] in annotated.columns else F.lit(None)
    counter = Observation()
    settled = written(
        annotated.withColumn("accepted", F.col(REASON).isNull()).observe(
            counter,
            F.count_if(good).alias("accepted"), F.count_if(~good).alias("rejections"),
            F.count_if(good & back).alias("released"), F.count_if(~good & back).alias("again"),
            F.count_if(F.col(REASON).rlike(_ORPHAN_ONLY) & ~F.coalesce(back, F.lit(False))).alias(
                "orphans"),
            F.max(ingested.cast("string")).alias("newest"),
        ), "checked", ("accepted",), folder,
    )
    return Checked(
        settled.where("accepted").drop("accepted", CORRUPT),
        settled.where("not accepted").drop("accepted"),
        **counter.get,
    )


def run_gold(
    spark: SparkSession,
    paths: Paths,
    batch_id: str | None = None,
    rules: BusinessRules = BusinessRules(),
    mode: str = "overwrite",
) -> Run:
    """Build dimensions, facts and marts from the current silver state.

    Marts read the facts as written. `mode="merge"` upserts by the merge key instead of replacing
    the table; the segment mart is always replaced, as its groups may vanish. `mode="incremental"`
    works through the silver months that changed since its last run only (see `increments`); the
    first run, or one after a run in another mode, builds everything.
    """
    if mode not in ("overwrite", "merge", "incremental"):
        raise ValueError(f"unknown gold mode: {mode}")
    run = Run(batch_id or Batch.start().batch_id, "")
    silver = {
        name: snapshots.read_snapshot(spark, paths.silver_table(name)) for name in SOURCE_TABLES
    }

    def store(table: str, frame: DataFrame) -> DataFrame:
        path = paths.gold_table(table)
        if mode == "merge" and table != "mart_customer_segments":
            state = snapshots.upsert(frame, path, list(TABLES[table].key), verify=False).state
        else:
            state = snapshots.overwrite(frame, path)
        return frame if state is None else state

    def build_all(builders: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
        states = for_each_table(
            spark, lambda table: store(table, builders[table]()), list(builders)
        )
        return dict(zip(builders, states))

    dimensions = {
        "dim_date": lambda: dims.dim_date(spark, rules),
        "dim_country": lambda: dims.dim_country(silver["customers"]),
        "dim_customers": lambda: dims.dim_customers(silver["customers"]),
        "dim_products": lambda: dims.dim_products(silver["products"]),
    }
    with staging(spark, "gold") as folder:
        if mode == "incremental":
            built = build_all(dimensions)
            places = increments.Places(paths.silver_table, paths.gold_table, join(paths.gold, "state"))
            built |= increments.refresh(spark, places, built, folder, rules)[0]
        else:
            built = build_all(dimensions | {
                "fct_orders": lambda: facts.fct_orders(silver["orders"], rules),
                "fct_order_items": lambda: facts.fct_order_items(silver["order_items"]),
                "fct_payments": lambda: facts.fct_payments(silver["payments"], rules),
            })
            orders = built["fct_orders"]
            built |= build_all({
                "mart_daily_sales": lambda: marts.mart_daily_sales(orders, built["fct_payments"]),
                "mart_monthly_revenue": lambda: marts.mart_monthly_revenue(orders),
                "mart_customer_lifetime_value": lambda: marts.mart_customer_lifetime_value(orders),
                "mart_product_performance": lambda: marts.mart_product_performance(
                    built["fct_order_items"], built["dim_products"], orders, folder
                ),
                "mart_customer_segments": lambda: marts.mart_customer_segments(
                    orders, built["dim_customers"]
                ),
            })
    built = {table: built[table] for table in TABLES}
    counts = for_each_table(spark, lambda table: built[table].count(), list(built))
    run.tables = [
        TableRun(table, rows, path=paths.gold_table(table)) for table, rows in zip(built, counts)
    ]
    manifests.write_manifest(spark, paths.gold, "gold", run.batch_id, "", run.tables)
    return run


def missing_tables(spark: SparkSession, paths: Paths, tables: list[str] | None = None) -> list[str]:
    """Curated tables that have no state yet, in publish order: what a dry run reports."""
    wanted = list(TABLES) if tables is None else tables
    return [t for t in wanted if not snapshots.has_snapshot(spark, paths.gold_table(t))]


def run_publish(
    spark: SparkSession,
    paths: Paths,
    database: str,
    tables: list[str] | None = None,
    mode: str = "overwrite",
    uppercase: bool = True,
    batch_id: str = "latest",
) -> Run:
    """Load curated tables into a catalog database: dimensions, then facts, then marts.

    `overwrite` and `append` load table by table, so a stop leaves some old and some new. `switch`
    loads all of them beside the published ones, as a load of its own, and makes that load the
    current one in a single step; tables are then views of their current load.
    """
    if mode not in ("overwrite", "append", "switch"):
        raise ValueError(f"unknown load mode: {mode}")
    wanted = None if tables is None else {name.lower() for name in tables}
    chosen = [name for name in TABLES if wanted is None or name in wanted]
    absent = missing_tables(spark, paths, chosen)
    if absent:
        raise FileNotFoundError(f"curated tables missing: {absent}")
    spark.sql(f"create database if not exists {database}")
    run = Run(batch_id, "")
    frames = {
        name: snapshots.read_snapshot(spark, paths.gold_table(name)) for name in chosen
    }
    if mode == "switch":
        counts = publish_load(spark, frames, database, uppercase)
    else:
        counts = {
            name: publish_table(spark, frame, f"{database}.{name}", mode, uppercase)
            for name, frame in frames.items()
        }
    run.tables = [
        TableRun(name, rows, path=paths.gold_table(name)) for name, rows in counts.items()
    ]
    if paths.warehouse:
        manifests.write_manifest(spark, paths.warehouse, "warehouse", batch_id, "", run.tables)
    return run


# The table that lists complete loads, and what is added to the name of a table that holds them.
LOADS, LOADS_OF = "published_loads", "_loads"


def publish_load(
    spark: SparkSession, frames: dict[str, DataFrame], database: str, uppercase: bool = True
) -> dict[str, int]:
    """Load all frames beside the published ones and switch to them together; rows per table.

    Rows go to a partition of their own below the table of all loads. The row in the list of
    loads, written last, makes them the ones the views show. A load that stops before it leaves
    nothing but partitions that no view shows. Loads before the one replaced are dropped. A table
    that is not among `frames` keeps what it shows: its own newest load that is complete.
    """
    loads = f"{database}.{LOADS}"
    if not spark.catalog.tableExists(loads):
        spark.sql(f"create table {loads} (load_id bigint, table_name string) using parquet")
    complete = [row[0] for row in spark.table(loads).select("load_id").distinct().collect()]
    number = max(complete, default=0) + 1

    def load(name: str) -> int:
        table, frame = f"{database}.{name}{LOADS_OF}", frames[name]
        shaped = upper_names(frame) if uppercase else frame
        if not spark.catalog.tableExists(table):
            shaped.limit(0).withColumn("load_id", F.lit(0).cast("bigint")).write.partitionBy(
                "load_id").saveAsTable(table)
        by_name = {c.lower(): c for c in shaped.columns}
        order = [by_name[c.lower()] for c in spark.table(table).columns if c != "load_id"]
        counter = Observation()
        counted = shaped.select(*order, F.lit(number).cast("bigint").alias("load_id")).observe(
            counter, F.count(F.lit(1)).alias("rows")
        )
        # Also clears what a load of this number that stopped has left.
        spark.sql(f"alter table {table} drop if exists partition (load_id = {number})")
        counted.write.mode("append").insertInto(table)
        rows = counter.get["rows"]
        if not spark.catalog.tableExists(f"{database}.{name}"):
            listed = ", ".join(f"`{c}`" for c in order)
            spark.sql(
                f"create view {database}.{name} as select {listed} from {table} where load_id = "
                f"(select max(load_id) from {loads} where table_name = '{name}')"
            )
        return rows

    counts = dict(zip(frames, for_each_table(spark, load, frames)))
    # One file: either all of its rows are there or none.
    literal_rows(spark, [(number, name) for name in frames], "load_id bigint, table_name string"
                 ).coalesce(1).write.mode("append").insertInto(loads)
    for name in frames:
        shown = [row[0] for row in spark.table(loads).where(F.col("table_name") == name).select(
            "load_id").distinct().orderBy(F.desc("load_id")).limit(KEPT_LOADS + 1).collect()]
        for old in shown[KEPT_LOADS:]:
            spark.sql(f"alter table {database}.{name}{LOADS_OF} drop if exists "
                      f"partition (load_id = {old})")
    return counts


# Loads of a table that stay: the current one, and the one running readers may still use.
KEPT_LOADS = 2


def publish_table(
    spark: SparkSession,
    frame: DataFrame,
    table: str,
    mode: str = "overwrite",
    uppercase: bool = True,
) -> int:
    """Create the table from the frame if needed, empty it for `overwrite`, insert the rows.

    An empty frame leaves the table as it is. Returns the rows written.
    """
    shaped = upper_names(frame) if uppercase else frame
    if not spark.catalog.tableExists(table):
        shaped.limit(0).write.saveAsTable(table)
    rows = 0
    if not shaped.isEmpty():
        order = [next(c for c in shaped.columns if c.lower() == t.lower())
                 for t in spark.table(table).columns]
        counter = Observation()
        counted = shaped.select(*order).observe(counter, F.count(F.lit(1)).alias("rows"))
        counted.write.insertInto(table, overwrite=mode == "overwrite")
        rows = counter.get["rows"]
    return rows


def run_sql_models(spark: SparkSession, paths: Paths, database: str | None = None) -> DataFrame:
    """Register the SQL layer over the curated tables, save its marts, and run the data tests."""
    curated = {
        name: snapshots.read_snapshot(spark, paths.gold_table(name))
        for name in TABLES
        if snapshots.has_snapshot(spark, paths.gold_table(name))
    }
    sqlmodels.create_views(spark, curated)
    if database:
        sqlmodels.materialise_marts(spark, database)
    return data_tests(curated)


def data_tests(curated: dict[str, DataFrame]) -> DataFrame:
    """(check_name, violations) of every table test the curated layer declares.

    Tests of one key share one grouping, tests for nulls in one table share one scan.
    """
    parts = []
    for name, contract in TABLES.items():
        if name in curated and contract.layer != "marts":
            parts.append(key_tests(name, curated[name], contract.key[0]))
    for child, column, parent in FOREIGN_KEY_TESTS:
        if child in curated and parent in curated:
            parts.append(nulls(child, curated[child], (column,)))
            name = f"relationships_{child}_{column}"
            parts.append(
                orphans(name, curated[child], column, curated[parent], column, count_null=False)
            )
    for name, (keys, filled) in MART_TESTS.items():
        if name in curated:
            parts.append(unique(f"unique_{name}_{'_'.join(keys)}", curated[name], *keys))
            parts.append(nulls(name, curated[name], filled))
    return report(parts)


def run_reconcile(
    spark: SparkSession,
    paths: Paths,
    source: dict[str, rec.Table],
    database: str | None = None,
    batch_id: str | None = None,
    report_path: str | None = None,
    compare_rows: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(layer counts, issues). No issues means the layers agree.

    A source may be given as a function that opens it; one that cannot be opened or counted has
    the status `error`. Bronze counts the newest batch. Silver and gold counts come from the newest
    manifests. Compared are source with bronze, bronze with silver, the stored silver state with the
    gold tables that have a row for each of its rows, and gold with the warehouse. With
    `compare_rows` the rows of gold and warehouse are compared too, not just how many there are.
    """
    batch_id = batch_id or manifests.newest_batch(spark, paths.bronze)[0]

    def landed(name: str) -> DataFrame | None:
        rules = ENTITIES[name]
        if not landing.is_landed(spark, paths.bronze, rules):
            return None
        schema = entity_schema(name) if rules.file_format != "parquet" else None
        return landing.read_landed(spark, paths.bronze, rules, schema, batch_id)

    def stored(name: str) -> DataFrame | None:
        path = paths.silver_table(name)
        return snapshots.read_snapshot(spark, path) if snapshots.has_snapshot(spark, path) else None

    def opener(function: Callable[[str], DataFrame | None], name: str) -> rec.Table:
        return lambda: function(name)

    counts = rec.layer_counts("source", source, spark).unionAll(
        rec.layer_counts("bronze", {name: opener(landed, name) for name in source}, spark)
    )
    rejected = None
    for layer, root in (("silver", paths.silver), ("gold", paths.gold)):
        if exists(spark, join(root, "_manifests")):
            counts = counts.unionAll(rec.manifest_counts(spark, root, layer))
            if layer == "silver":
                rejected = manifests.latest_counts(spark, root, layer).select(
                    F.col("table_name").alias("entity"), "rejected_count"
                )
        else:
            counts = counts.unionAll(rec.unavailable(spark, layer, "missing", "no manifest"))
    issues = rec.compare(counts, "source", "bronze").unionAll(rec.unreadable(counts))
    if rejected is not None:
        issues = issues.unionAll(rec.compare(counts, "bronze", "silver", rejected))
    if exists(spark, join(paths.gold, "_manifests")):
        state = rec.layer_counts(
            "silver state",
            {table: opener(stored, entity) for entity, table in GOLD_OF.items()}, spark,
        )
        issues = issues.unionAll(
            rec.compare(counts.unionAll(state.where("status <> 'missing'")), "silver state", "gold")
        )
    if database is None:
        counts = counts.unionAll(rec.unavailable(spark, "warehouse", "skipped", ""))
    else:
        published = {
            name: spark.table(f"{database}.{name}")
            if spark.catalog.tableExists(f"{database}.{name}")
            else None
            for name in TABLES
        }
        counts = counts.unionAll(rec.layer_counts("warehouse", published, spark))
        issues = issues.unionAll(rec.compare(counts, "gold", "warehouse"))
        if compare_rows:
            issues = issues.unionAll(row_issues(spark, paths, published))
    if report_path:
        rec.write_report(counts, issues, report_path)
    return counts, issues


def row_issues(
    spark: SparkSession, paths: Paths, published: dict[str, DataFrame | None]
) -> DataFrame:
    """(entity, issue) of published tables whose rows are not those of the curated ones."""
    tables = [
        name for name, frame in published.items()
        if frame is not None and snapshots.has_snapshot(spark, paths.gold_table(name))
    ]

    def differing(name: str) -> int:
        there = published[name].toDF(*[c.lower() for c in published[name].columns])
        here = snapshots.read_snapshot(spark, paths.gold_table(name))
        with staging(spark, f"compare-{name}") as folder:
            return differing_rows(here, there, list(TABLES[name].key), under=folder).count()

    counts = zip(tables, for_each_table(spark, differing, tables))
    return literal_rows(
        spark,
        [(name, f"{name}: {n} rows differ between gold and warehouse") for name, n in counts if n],
        "entity string, issue string",
    )
