import json

import pytest
from pyspark.sql import functions as F

from catalogue.adapters import Inputs
from shopgrain.operators import checks, reconcile
from shopgrain.plans import jobs
from shopgrain.rules import REASON, TABLES, WEBSITE_EVENTS, BusinessRules
from shopgrain.sources import manifests, snapshots
from shopgrain.sources.landing import Batch
from shopgrain.streaming import feed

FOLDER = "/root/testdata/sf0.001"
YEARS = BusinessRules(calendar_start="1995-01-01", calendar_end="2001-12-31")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """A whole run: tables and both feeds to bronze, silver, gold, warehouse."""
    base = tmp_path_factory.mktemp("lake")
    inputs, paths = Inputs(spark, FOLDER), jobs.Paths.under(str(base))
    feeds = {"product_updates": str(base / "updates"), "website_events": str(base / "events")}
    inputs.product_updates().coalesce(1).write.option("header", True).csv(feeds["product_updates"])
    inputs.website_events().coalesce(1).write.json(feeds["website_events"])
    tables = {
        "customers": inputs.customers(),
        "products": inputs.products(),
        "orders": inputs.orders(),
        "order_items": inputs.order_items(),
        "payments": inputs.payments(),
    }
    landed = jobs.run_ingest(spark, paths, tables, feeds)
    silver = jobs.run_silver(spark, paths)
    gold = jobs.run_gold(spark, paths, rules=YEARS)
    spark.sql(f"create database if not exists lake_db location '{base}/db'")
    loaded = jobs.run_publish(spark, paths, "lake_db", batch_id="one")
    return {"paths": paths, "tables": tables, "feeds": feeds, "inputs": inputs,
            "runs": (landed, silver, gold, loaded)}


def test_nothing_is_lost(lake):
    landed, silver, gold, loaded = lake["runs"]
    assert silver.batch_id == landed.batch_id
    assert {t.table_name for t in silver.tables} == {t.table_name for t in landed.tables}
    assert landed.total_rows == silver.total_rows + silver.total_rejected
    assert silver.total_rejected > 0
    assert [t.table_name for t in gold.tables] == list(TABLES)
    assert gold.total_rows == loaded.total_rows


def test_feed_reasons(spark, lake):
    rejected = snapshots.read_rejected(spark, lake["paths"].rejected("website_events"))
    found = {r[REASON] for r in rejected.select(REASON).distinct().collect()}
    assert "invalid_event_type" in found
    assert found <= {"invalid_event_type", "orphan_customer_id_references_customers.customer_id"}
    back = snapshots.read_snapshot(spark, lake["paths"].silver_table("website_events"))
    assert back.schema["order_value"].dataType.simpleString() == "double"


def test_curated_tests_pass(spark, lake):
    report = jobs.run_sql_models(spark, lake["paths"], "lake_models")
    assert report.where("violations > 0").isEmpty()
    assert report.count() == 33
    assert spark.table("lake_models.mart_daily_sales").count() > 0


def test_reconcile(spark, lake, tmp_path):
    report = str(tmp_path / "report")
    counts, issues = jobs.run_reconcile(
        spark, lake["paths"], lake["tables"], "lake_db", report_path=report
    )
    assert issues.isEmpty()
    assert {r.layer for r in counts.select("layer").distinct().collect()} == set(reconcile.LAYERS)
    (written,) = (tmp_path / "report").glob("*.json")
    body = json.loads(written.read_text())
    assert body["passed"] is True and len(body["counts"]) == counts.count()


def test_published_names_are_upper_case(spark, lake):
    assert spark.table("lake_db.dim_country").columns[0] == "COUNTRY_KEY"
    with pytest.raises(ValueError):
        jobs.run_publish(spark, lake["paths"], "lake_db", mode="upsert")


def test_missing_tables(spark, lake, tmp_path):
    empty = jobs.Paths.under(str(tmp_path))
    assert jobs.missing_tables(spark, lake["paths"]) == []
    assert jobs.missing_tables(spark, empty) == list(TABLES)
    with pytest.raises(FileNotFoundError):
        jobs.run_publish(spark, empty, "lake_db", ["dim_date"])


def test_landing_again_changes_nothing(spark, lake):
    """A second full load is no duplicate of the first; the newer batch replaces the older."""
    paths = lake["paths"]
    before = snapshots.read_snapshot(spark, paths.silver_table("customers"))
    again = jobs.run_ingest(spark, paths, {"customers": lake["tables"]["customers"]})
    silver = jobs.run_silver(spark, paths, again.batch_id, again.ingestion_date, ["customers"])
    assert silver.total_rejected == 0
    after = snapshots.read_snapshot(spark, paths.silver_table("customers"))
    assert after.count() == before.count()
    assert {r.batch_id for r in after.select("batch_id").distinct().collect()} == {again.batch_id}


def test_orders_stored_by_month(spark, lake, tmp_path):
    """The same state, whichever layout holds it."""
    paths = jobs.Paths.under(str(tmp_path))
    orders = lake["tables"]["orders"]
    run = jobs.run_ingest(spark, paths, {"orders": orders})
    for _ in range(2):
        jobs.run_silver(spark, paths, run.batch_id, run.ingestion_date)
    path = paths.silver_table("orders")
    assert len(snapshots.months(spark, path)) > 12
    valid = orders.where("subtotal_amount >= 0").select("order_id", "order_status")
    stored = snapshots.read_snapshot(spark, path).select("order_id", "order_status")
    assert stored.exceptAll(valid).isEmpty() and valid.exceptAll(stored).isEmpty()


def test_scope_all_rejects_every_copy(spark, lake, tmp_path):
    paths = jobs.Paths.under(str(tmp_path))
    for name in ("b1", "b2"):
        jobs.run_ingest(spark, paths, {"products": lake["tables"]["products"]},
                        batch=Batch(name, "2024-01-01", name))
    run = jobs.run_silver(spark, paths, "b2", "2024-01-01", ["products"], True, "all")
    assert run.total_rows == 0
    assert run.total_rejected == 2 * lake["tables"]["products"].count()


def test_incremental_load_uses_stored_watermark(spark, lake, tmp_path):
    paths = jobs.Paths.under(str(tmp_path))
    orders = lake["tables"]["orders"]
    first = jobs.run_ingest(spark, paths, {"orders": orders})
    mark = manifests.stored_watermarks(spark, paths.bronze)["orders"]
    assert first.total_rows == orders.count()
    newer = orders.limit(3).withColumn("updated_at", F.lit("2030-01-01").cast("timestamp_ntz"))
    second = jobs.run_ingest(spark, paths, {"orders": orders.unionByName(newer)})
    assert second.total_rows == 3
    third = jobs.run_ingest(spark, paths, {"orders": orders})
    assert third.total_rows == 0
    assert manifests.stored_watermarks(spark, paths.bronze)["orders"] > mark


def test_merge_mode_keeps_rows_that_vanished(spark, lake, tmp_path):
    paths = lake["paths"]
    days = snapshots.read_snapshot(spark, paths.gold_table("dim_date")).count()
    fewer = BusinessRules(calendar_start="1995-01-01", calendar_end="1995-01-02")
    jobs.run_gold(spark, paths, rules=fewer, mode="merge")
    assert snapshots.read_snapshot(spark, paths.gold_table("dim_date")).count() == days
    jobs.run_gold(spark, paths, rules=YEARS)


def test_unknown_entity_is_an_error(spark, lake):
    with pytest.raises(KeyError):
        jobs.run_silver(spark, lake["paths"], "b", "d", ["suppliers"])
    with pytest.raises(FileNotFoundError):
        jobs.run_ingest(spark, lake["paths"], feed_folders={"website_events": "/tmp/no-such-feed"})


def test_compare_layers(rows):
    counts = rows(
        reconcile.COUNT_SCHEMA,
        ("source", "customers", 100, "ok", ""),
        ("bronze", "customers", 90, "ok", ""),
        ("source", "orders", 5, "ok", ""),
        ("bronze", "orders", None, "missing", ""),
        ("source", "payments", 7, "ok", ""),
        ("bronze", "payments", 7, "ok", ""),
    )
    issues = {r.entity: r.issue for r in reconcile.compare(counts, "source", "bronze").collect()}
    assert issues == {
        "customers": "customers: source=100 bronze=90",
        "orders": "orders: bronze count unavailable",
    }
    assert [r.entity for r in reconcile.unreadable(counts).collect()] == ["orders"]


def test_parity_sees_both_sides(rows):
    a, b = rows("d int", (1,), (2,)), rows("d int", (2,), (9,))
    assert sorted(r.d for r in checks.only_in_one(a, b).collect()) == [1, 9]
    assert checks.difference("x", a, a).first().violations == 0


def deliveries(spark, tmp_path, name, *parts):
    """A stream over the given frames, one file each; `at_once` files make a micro-batch."""
    folder = str(tmp_path / f"in-{name}")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(folder)

    def run(at_once, base, parent_path=None):
        stream = feed.file_stream(
            spark, folder, parts[0].schema, "*.parquet", "parquet", files_at_once=at_once
        )
        feed.ingest_available(
            stream, WEBSITE_EVENTS, f"{base}/ok", f"{base}/bad", f"{base}/state", "web",
            parent_path=parent_path,
        )
        shown = ["event_id", "event_type", "event_timestamp"]
        found = []
        for table in ("ok", "bad"):
            if snapshots.has_snapshot(spark, f"{base}/{table}"):
                state = snapshots.read_snapshot(spark, f"{base}/{table}")
                found += [(table, *map(str, r)) for r in state.select(*shown, REASON).collect()]
        return sorted(found)

    return run


def test_stream_stores_each_event_once(spark, tmp_path):
    events = Inputs(spark, FOLDER).website_events()
    some = events.limit(40).cache()
    late = some.limit(1).withColumns(
        {"event_id": F.lit("late"), "event_timestamp": F.lit("1999-01-01 00:00:00")}
    )
    nameless = some.limit(1).withColumn("event_id", F.lit(None).cast("string"))
    retimed = some.withColumn("event_timestamp", F.lit("2031-05-05 00:00:00"))
    wrong = some.withColumn("event_type", F.lit("unheard_of"))
    run = deliveries(spark, tmp_path, "a", events, events, late, nameless, wrong, retimed)
    one_by_one = run(1, tmp_path / "one")
    assert one_by_one == run(10, tmp_path / "all")
    assert run(1, tmp_path / "one") == one_by_one
    accepted = [r for r in one_by_one if r[0] == "ok"]
    assert len({r[1] for r in accepted}) == len(accepted)
    assert sum(r[3].startswith("2031") for r in accepted) == len(
        {r.event_id for r in some.where("event_type <> 'error'").collect()}
    )
    (nameless,) = [r[4] for r in one_by_one if r[1] == "None"]
    assert nameless.startswith("null_event_id")


def test_stream_checks_customers(spark, tmp_path):
    inputs = Inputs(spark, FOLDER)
    parents = str(tmp_path / "customers")
    snapshots.overwrite(inputs.customers().where("is_active"), parents)
    run = deliveries(spark, tmp_path, "b", inputs.website_events())
    found = run(1, tmp_path / "out", lambda name: parents)
    known = inputs.website_events().join(
        inputs.customers().where("is_active"), "customer_id", "left_semi"
    )
    assert sum(r[0] == "ok" for r in found) == known.where("event_type <> 'error'").count()
    assert any(r[4].startswith("orphan_customer_id") for r in found)


def stream_once(spark, base, **options):
    schema = Inputs(spark, FOLDER).website_events().schema
    feed.ingest_available(
        feed.file_stream(spark, f"{base}/in", schema, "*.parquet", "parquet"), WEBSITE_EVENTS,
        f"{base}/ok", f"{base}/bad", f"{base}/state", "web", **options,
    )
    return {
        table: sorted(
            (str(r.event_id), r.event_type, r.batch_id.split("_")[0])
            for r in snapshots.read_snapshot(spark, f"{base}/{table}").collect()
        )
        for table in ("ok", "bad") if snapshots.has_snapshot(spark, f"{base}/{table}")
    }


def deliver(frame, base):
    frame.coalesce(1).write.mode("append").parquet(f"{base}/in")


@pytest.mark.parametrize("buckets", [0, 2])
def test_stream_drops_repeats_and_adds_rejected(spark, tmp_path, buckets):
    base = str(tmp_path)
    options = {"repeats_within": "1 day", "key_buckets": buckets}
    some = Inputs(spark, FOLDER).website_events().limit(60).cache()
    odd = some.where("event_type <> 'error'").limit(3).withColumn("event_type", F.lit("odd"))
    deliver(some.unionByName(odd), base)
    first = stream_once(spark, base, **options)
    assert sum(r[1] == "odd" for r in first["bad"]) == 3
    parts = snapshots.month_parts(spark, f"{base}/bad")
    deliver(some.unionByName(odd).unionByName(odd), base)
    assert stream_once(spark, base, **options) == first  # also the batch each row came with
    odder = odd.withColumn("event_type", F.lit("odder"))
    deliver(odder.unionByName(odd), base)
    last = stream_once(spark, base, **options)
    assert last["ok"] == first["ok"]
    assert [r for r in last["bad"] if r[1] != "odder"] == first["bad"]
    assert sum(r[1] == "odder" for r in last["bad"]) == 3
    # What was stored before is not written again.
    assert parts.items() < snapshots.month_parts(spark, f"{base}/bad").items()
    # A micro-batch that stopped before its end was noted runs again and changes nothing.
    done = sorted((p for p in (tmp_path / "state" / "commits").iterdir() if p.name.isdigit()),
                  key=lambda p: int(p.name))
    done[-1].unlink()
    (done[-1].parent / f".{done[-1].name}.crc").unlink(missing_ok=True)
    assert [[r[:2] for r in rows] for rows in stream_once(spark, base, **options).values()] == [
        [r[:2] for r in rows] for rows in last.values()
    ]
    # Without its state the stream takes everything in again: the tables know what they hold.
    again = str(tmp_path / "again")
    options["repeats_within"] = None
    feed.ingest_available(
        feed.file_stream(spark, f"{base}/in", some.schema, "*.parquet", "parquet"), WEBSITE_EVENTS,
        f"{base}/ok", f"{base}/bad", again, "web", **options,
    )
    stored = snapshots.read_snapshot(spark, f"{base}/bad")
    assert sorted((str(r.event_id), r.event_type) for r in stored.collect()) == [r[:2] for r in last["bad"]]


def test_stream_repeats_count_again_once_their_parent_is_known(spark, tmp_path):
    base, inputs = str(tmp_path), Inputs(spark, FOLDER)
    parents = str(tmp_path / "customers")
    snapshots.overwrite(inputs.customers().where("is_active"), parents)
    events = inputs.website_events().where("event_type <> 'error'").limit(200).cache()
    options = {"repeats_within": "1 day", "parent_path": lambda name: parents}
    deliver(events, base)
    first = stream_once(spark, base, **options)
    deliver(events, base)
    assert stream_once(spark, base, **options) == first
    snapshots.overwrite(inputs.customers(), parents)
    deliver(events, base)
    known = events.where("customer_id is null").count() + events.join(
        inputs.customers(), "customer_id", "left_semi").count()
    assert first["bad"] and len(first["ok"]) < known
    assert len(stream_once(spark, base, **options)["ok"]) == known


def test_appended_parts_are_put_together(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    for k in range(8):
        snapshots.append(rows("k int", (k,)), path, f"p{k}", side_by_side=3)
    snapshots.append(rows("k int, more string", (7, "x")), path, "p7", side_by_side=3)
    state = snapshots.read_snapshot(spark, path)
    assert sorted((r.k, r.more) for r in state.collect()) == [*[(k, None) for k in range(7)], (7, "x")]
    assert sorted(r.k for r in snapshots.read_snapshot(spark, path, without="p7").collect()) == list(range(7))
    names = list(snapshots.month_parts(spark, path))
    assert len(names) <= 5 and sum(n.startswith(snapshots.TOGETHER) for n in names) == 2


def small_lake(spark, tmp_path, name):
    paths = jobs.Paths.under(str(tmp_path / name))
    inputs = Inputs(spark, FOLDER)
    customers = inputs.customers().where("customer_id < 40")
    orders = inputs.orders().where("order_id < 400 and customer_id < 80")
    return paths, customers, orders


def ids(frame, name="order_id"):
    return sorted(r[0] for r in frame.select(name).collect())


def test_silver_takes_in_every_landed_batch(spark, tmp_path):
    paths, customers, orders = small_lake(spark, tmp_path, "backlog")
    first = jobs.run_ingest(spark, paths, {"customers": customers, "orders": orders.where("order_id < 200")},
                            watermarks={})
    second = jobs.run_ingest(spark, paths, {"orders": orders.where("order_id >= 200")}, watermarks={})
    assert [p.batch_id for p in manifests.pending_batches(spark, paths.bronze, paths.silver)] == [
        first.batch_id, second.batch_id]
    run = jobs.run_silver(spark, paths)
    assert run.batch_id == second.batch_id
    assert run.total_rows + run.total_rejected == first.total_rows + second.total_rows
    stored = snapshots.read_snapshot(spark, paths.silver_table("orders"))
    aside = snapshots.read_rejected(spark, paths.rejected("orders"))
    assert sorted(ids(stored) + ids(aside)) == ids(orders)
    assert jobs.run_silver(spark, paths).tables == []
    assert ids(snapshots.read_snapshot(spark, paths.silver_table("orders"))) == ids(stored)


def test_a_run_over_some_entities_leaves_the_others_pending(spark, tmp_path):
    paths, customers, orders = small_lake(spark, tmp_path, "partial")
    known = customers.where("customer_id < 20")
    run = jobs.run_ingest(spark, paths, {"customers": known, "orders": orders}, watermarks={})
    first = jobs.run_silver(spark, paths, entities=["orders"])
    assert [t.table_name for t in first.tables] == ["orders"]
    (left,) = manifests.pending_batches(spark, paths.bronze, paths.silver)
    assert (left.batch_id, left.entities) == (run.batch_id, ("customers",))
    rest = jobs.run_silver(spark, paths)
    assert {t.table_name for t in rest.tables} == {"customers"}
    assert not manifests.pending_batches(spark, paths.bronze, paths.silver)
    # Only customers are landed; their orders come back, other rows stay aside.
    jobs.run_ingest(spark, paths, {"customers": customers}, watermarks={})
    jobs.run_silver(spark, paths)
    landed = {}
    for table in manifests.read_manifests(spark, paths.silver).select(F.inline("tables")).collect():
        landed[table.table_name] = landed.get(table.table_name, 0) + table.row_count + table.rejected_count
    assert landed["orders"] == orders.count()
    stored = snapshots.read_snapshot(spark, paths.silver_table("orders"))
    assert stored.where("customer_id >= 40").isEmpty() or first.total_rejected == 0


def test_an_older_batch_never_undoes_a_newer_one(spark, tmp_path):
    paths, customers, orders = small_lake(spark, tmp_path, "replay")
    own = orders.join(customers, "customer_id", "left_semi").where("subtotal_amount >= 0")
    batches = [Batch(f"b{n}", f"2024-01-0{n}", f"2024-01-0{n}T00:00:00") for n in (1, 2)]
    for batch, status in zip(batches, ("completed", "refunded")):
        jobs.run_ingest(spark, paths, {"customers": customers, "orders": own.withColumn(
            "order_status", F.lit(status))}, watermarks={}, batch=batch)
    jobs.run_silver(spark, paths)
    for batch in batches:
        jobs.run_silver(spark, paths, batch.batch_id, batch.ingestion_date)
        state = snapshots.read_snapshot(spark, paths.silver_table("orders"))
        assert {(r.order_status, r.batch_id) for r in state.collect()} == {("refunded", "b2")}
    # The newest batch landed again, corrected, replaces its own rows.
    jobs.run_ingest(spark, paths, {"orders": own.withColumn("order_status", F.lit("failed"))},
                    watermarks={}, batch=batches[1])
    jobs.run_silver(spark, paths, "b2", "2024-01-02")
    state = snapshots.read_snapshot(spark, paths.silver_table("orders"))
    assert {r.order_status for r in state.collect()} == {"failed"}


def test_orphans_come_back_when_their_parent_does(spark, tmp_path):
    paths, customers, orders = small_lake(spark, tmp_path, "late")
    known = customers.where("customer_id < 20")
    jobs.run_ingest(spark, paths, {"customers": known, "orders": orders}, watermarks={})
    first = jobs.run_silver(spark, paths)
    jobs.run_ingest(
        spark, paths, {"customers": customers, "orders": orders.limit(0)}, watermarks={}
    )
    second = jobs.run_silver(spark, paths)
    now = {t.table_name: t for t in second.tables}["orders"]
    assert now.row_count > 0 and now.rejected_count == -now.row_count
    stored = snapshots.read_snapshot(spark, paths.silver_table("orders"))
    aside = snapshots.read_rejected(spark, paths.rejected("orders"))
    landed = [t.row_count + t.rejected_count for t in first.tables + second.tables
              if t.table_name == "orders"]
    assert stored.count() + aside.count() == orders.count() == sum(landed)
    assert sorted(ids(stored) + ids(aside)) == ids(orders)
    assert aside.join(customers, "customer_id").where(
        F.col(REASON).startswith("orphan_")).isEmpty()
    assert aside.where(F.col(REASON).startswith("orphan_")).count() == orders.where(
        "customer_id >= 40").where("subtotal_amount >= 0").count()


def test_waiting_rows_are_found_by_their_keys_alone(spark, tmp_path):
    paths, customers, orders = small_lake(spark, tmp_path, "waiting")
    whole = orders.where("subtotal_amount >= 0")
    for n, share in enumerate(("order_id < 200", "order_id >= 200")):
        jobs.run_ingest(spark, paths, {"customers": customers.where("customer_id < 10"), "orders": whole.where(share)},
                        watermarks={}, batch=Batch(f"b{n}", f"2024-01-0{n + 1}", f"2024-01-0{n + 1}"))
    jobs.run_silver(spark, paths)
    held = snapshots.read_rejected(spark, paths.waiting("orders"))
    assert set(held.columns) == {"order_id", "customer_id", "ingestion_date", "batch_id"}
    assert ids(held) == ids(whole.where("customer_id >= 10"))
    back = whole.where("customer_id >= 10 and customer_id < 20 and order_id < 200")
    jobs.run_ingest(spark, paths, {"customers": customers.where("customer_id < 20")}, watermarks={},
                    batch=Batch("b2", "2024-01-03", "2024-01-03"))
    found = jobs.parents_found(
        spark, jobs.ENTITIES["orders"], paths.rejected("orders"), lambda name: paths.silver_table(name),
        str(tmp_path / "found"), None, paths.waiting("orders"))
    assert found is None  # no customer is new yet
    jobs.run_silver(spark, paths)
    left = ids(whole.where("customer_id >= 20"))
    assert ids(snapshots.read_rejected(spark, paths.waiting("orders"))) == left
    assert ids(snapshots.read_rejected(spark, paths.rejected("orders"))) == left
    assert set(ids(back)) <= set(ids(snapshots.read_snapshot(spark, paths.silver_table("orders"))))


def test_a_late_orphan_does_not_undo_newer_rows(spark, tmp_path):
    paths, customers, orders = small_lake(spark, tmp_path, "stale")
    one = orders.limit(1)
    owner = customers.limit(1).withColumn(
        "customer_id", F.lit(one.first().customer_id).cast("bigint")
    )
    jobs.run_ingest(spark, paths, {"customers": owner.limit(0), "orders": one}, watermarks={},
                    batch=Batch("b1", "2024-01-01", "2024-01-01T00:00:00"))
    jobs.run_ingest(spark, paths, {"customers": customers.where("customer_id < 0").unionByName(
        owner.withColumn("customer_id", F.lit(-5).cast("bigint")))}, watermarks={},
        batch=Batch("b2", "2024-01-02", "2024-01-02T00:00:00"))
    jobs.run_silver(spark, paths)
    # Owner and a newer version of the order in the same batch as the way back of the old one.
    newer = one.withColumn("order_status", F.lit("refunded"))
    jobs.run_ingest(spark, paths, {"customers": owner, "orders": newer}, watermarks={},
                    batch=Batch("b3", "2024-01-03", "2024-01-03T00:00:00"))
    jobs.run_silver(spark, paths)
    (row,) = snapshots.read_snapshot(spark, paths.silver_table("orders")).collect()
    assert (row.order_status, row.batch_id) == ("refunded", "b3")


def test_rerun_clears_its_rejected_rows(spark, tmp_path):
    paths, customers, orders = small_lake(spark, tmp_path, "rerun")
    batch = Batch("007", "2024-01-01", "2024-01-01T00:00:00")
    bad = orders.withColumn("order_status", F.lit("odd"))
    jobs.run_ingest(spark, paths, {"customers": customers, "orders": bad}, batch=batch, watermarks={})
    assert jobs.run_silver(spark, paths, "007", "2024-01-01").total_rejected == orders.count()
    good = orders.join(customers, "customer_id", "left_semi").where("subtotal_amount >= 0")
    jobs.run_ingest(spark, paths, {"customers": customers, "orders": good}, batch=batch, watermarks={})
    assert jobs.run_silver(spark, paths, "007", "2024-01-01").total_rejected == 0
    assert not snapshots.has_rejected(spark, paths.rejected("orders"))
    kept = snapshots.read_snapshot(spark, paths.silver_table("orders"))
    assert kept.count() == good.count() and kept.first().batch_id == "007"


def test_all_batches_keep_their_own_ids_in_quarantine(spark, tmp_path):
    paths, customers, orders = small_lake(spark, tmp_path, "own")
    for name in ("b1", "b2"):
        jobs.run_ingest(spark, paths, {"customers": customers, "orders": orders}, watermarks={},
                        batch=Batch(name, "2024-01-01", name))
    jobs.run_silver(spark, paths, all_batches=True)
    aside = snapshots.read_rejected(spark, paths.rejected("orders"))
    assert {r.batch_id for r in aside.select("batch_id").distinct().collect()} == {"b1", "b2"}


def test_unreadable_tables_and_empty_manifests(spark, tmp_path):
    paths, customers, orders = small_lake(spark, tmp_path, "errors")
    run = jobs.run_ingest(spark, paths, {"customers": customers, "orders": orders.limit(0)}, watermarks={})
    jobs.run_silver(spark, paths)
    sources = {"customers": lambda: spark.read.parquet(str(tmp_path / "nowhere")), "orders": orders.limit(0)}
    counts, issues = jobs.run_reconcile(spark, paths, sources, batch_id=run.batch_id)
    status = {(r.layer, r.entity): r.status for r in counts.collect()}
    assert status[("source", "customers")] == "error" and status[("source", "orders")] == "empty"
    assert status[("silver", "customers")] == "ok" and status[("silver", "orders")] == "empty"
    assert any("error" in r.issue for r in issues.where("entity = 'customers'").collect())


def test_gold_behind_silver_is_an_issue(spark, lake, tmp_path):
    inputs, paths = lake["inputs"], jobs.Paths.under(str(tmp_path))
    tables = dict(lake["tables"])
    tables["customers"] = inputs.customers().where("customer_id < 50")
    jobs.run_ingest(spark, paths, tables, watermarks={})
    jobs.run_silver(spark, paths)
    jobs.run_gold(spark, paths, rules=YEARS)
    assert jobs.run_reconcile(spark, paths, tables)[1].isEmpty()
    tables["customers"] = inputs.customers()
    jobs.run_ingest(spark, paths, {"customers": tables["customers"]}, watermarks={})
    jobs.run_silver(spark, paths)
    _, issues = jobs.run_reconcile(spark, paths, {"customers": tables["customers"]})
    found = {r.entity: r.issue for r in issues.collect()}
    assert found["dim_customers"].startswith("dim_customers: silver state=")
