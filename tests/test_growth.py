"""Steps whose data must not outgrow their input."""

from datetime import date, datetime

from catalogue.queries import QUERIES
from shopgrain.operators import checks
from shopgrain.operators.lookup import lookup_join
from shopgrain.operators.quality import mark_duplicates, mark_orphans, orphan_keys
from shopgrain.plans import activity, marts
from shopgrain.rules import REASON, ForeignKey
from shopgrain.runtime import fits_broadcast, tasks_for, too_long
from shopgrain.sources import snapshots


def plan_of(frame, capsys) -> str:
    capsys.readouterr()
    frame.explain()
    return capsys.readouterr().out


def test_bitmaps_move_once_for_all_windows(spark, rows, capsys, tmp_path):
    rows("order_key long, customer_key long, order_timestamp timestamp", *[
        (i, i % 3, datetime(2024, 1, 1 + i)) for i in (0, 1, 9)
    ]).write.parquet(str(tmp_path / "orders"))
    orders = spark.read.parquet(str(tmp_path / "orders"))
    known = rows("customer_key long, customer_segment string", (0, "x"), (1, "x"))
    built = activity.daily_bitmaps(orders, known)
    # Rows are dealt once more after the join, bitmaps in the making are not.
    assert plan_of(built, capsys).count("bitmap_construct_agg") == 2
    assert "Exchange hashpartitioning(activity_date" in plan_of(built, capsys).split("partial_bitmap")[1]
    built.write.parquet(str(tmp_path / "bitmaps"))
    kept = spark.read.parquet(str(tmp_path / "bitmaps"))
    moved = [plan_of(activity.active_customers(kept, windows), capsys).count("Exchange hashpartitioning")
             for windows in ((2,), (2, 7, 30, 90))]
    assert moved == [2, 2]
    # A day listed in two bitmaps counts once, and days without one are covered.
    found = {(r.activity_date.day, r.window_days): r.active_customers
             for r in activity.active_customers(kept.union(kept), (1, 3)).collect()}
    assert found == {(1, 1): 1, (2, 1): 1, (10, 1): 1, (1, 3): 1, (2, 3): 2, (3, 3): 2, (4, 3): 1, (10, 3): 1}
    assert date(2024, 1, 10) in {r.activity_date for r in activity.active_customers(kept, (1,)).collect()}


def test_new_keys_that_other_products_have(spark, rows, tmp_path):
    """Product 3 becomes 3,000,000 as well, which there is already."""
    rows("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
         (3, "large ring", "b", "t", 30, 10.0), (3000000, "small nut", "b", "t", 40, 20.0),
         (4, "blue bolt", "b", "t", 1, 30.0)).write.parquet(str(tmp_path / "part.parquet"))
    found = QUERIES["upsert_snapshot"](spark, str(tmp_path)).select("product_id", "sku", "unit_price")
    assert sorted(map(tuple, found.collect())) == [
        (3, "SKU-000003", 15.0), (4, "SKU-000004", 30.0), (3000000, "SKU-000003-NEW", 15.0),
        (3000000, "SKU-3000000", 25.0), (3000000000000, "SKU-3000000-NEW", 25.0),
    ]


def test_rejected_rows_of_a_batch_do_not_meet_in_one_task(spark, rows, capsys):
    ddl = "k long, ingestion_date string, batch_id string"
    kept = rows(ddl, (1, "d", "a"), (2, "d", "a"), (3, "d", "b"), (1, "e", "a"))
    stays = snapshots.staying(kept, rows(ddl, (1, "d", "a"), (9, "d", "a")), ["k"])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(tuple, stays.collect())) == [(2, "d", "a")]
        plan = plan_of(stays.select("*"), capsys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # Only the distinct batches are dealt by batch.
    assert plan.count("Exchange hashpartitioning(ingestion_date") == 1 and "BroadcastExchange" in plan


def test_product_totals_get_more_tasks_with_more_lines(spark, capsys):
    def totals(n):
        lines = spark.range(n).selectExpr(
            "id div 4 as order_key", "id % 7 as product_key", "1 as quantity",
            "cast(2 as decimal(18,2)) as line_total")
        orders = spark.range(n).selectExpr("id as order_key", "true as is_completed").limit(n)
        return lines, marts.product_totals(lines, orders)

    counts = []
    for n in (28, 100_000_000, 200_000_000):
        lines, built = totals(n)
        counts.append(tasks_for(lines, marts.PAIR_BYTES))
        assert f", {counts[-1]}), REPARTITION_BY_NUM" in plan_of(built, capsys)
    assert counts[0] == 8 and counts[1] > 100 and 1.9 < counts[2] / counts[1] < 2.1
    assert totals(28)[1].agg({"order_count": "sum", "total_quantity_sold": "sum"}).first()[:] == (28, 28)


def test_rows_of_one_month_are_not_dealt_by_month(spark, rows, tmp_path):
    """Without the month's column, a task's rows stay where they are: a file for each task."""
    path, few = str(tmp_path / "t"), spark.range(40).selectExpr("id as k").repartition(4)
    snapshots.upsert(few, path, ["k"], month_of="d", settled=True, verify=False, rows=40)
    (folder,) = snapshots.current_version(spark, path).parts.values()
    assert len(list((tmp_path / "t" / folder).glob("*.parquet"))) == 4
    assert snapshots.read_snapshot(spark, path).count() == 40
    later = snapshots.upsert(rows("k long", (3,), (90,)), path, ["k"], month_of="d")
    assert later.state.count() == 41 and snapshots.months(spark, path) == ["none"]


def test_rows_are_not_sorted_to_find_their_marks(spark, rows, capsys):
    """Lists of keys too long for a broadcast are held in hash tables, share by share."""
    frame = rows("k long, b string, p long, rejection_reason string", (1, "x", 7, None), (1, "x", 8, None),
                 (1, "y", 7, None), (None, "x", 7, None), (None, "x", None, None), (2, None, 9, None))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        copies = mark_duplicates(frame, ["k", "b"])
        assert sorted(r["p"] or 0 for r in copies.where("__duplicate").collect()) == [0, 7, 7, 8]
        orphans = mark_orphans(frame, ForeignKey("p", "parents", "p"), rows("p long", (7,), (9,)))
        assert sorted(r["p"] or 0 for r in orphans.where(f"{REASON} is not null").collect()) == [0, 8]
        for marked in (copies, orphans):
            # Only the keys themselves may meet in a sort-merge join, never the rows.
            joins = [line for line in plan_of(marked, capsys).splitlines() if "LeftOuter" in line]
            assert any("ShuffledHashJoin" in line for line in joins)
            assert not any("SortMergeJoin" in line for line in joins)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_keys_of_a_table_get_more_tasks_with_more_rows(spark, rows, capsys):
    """Keys travel uncounted, and no task's share of them depends on how many there are."""
    counts = []
    for n in (40, 200_000_000, 400_000_000):
        keys = spark.range(n).withColumnRenamed("id", "k")
        counts.append(tasks_for(keys, checks.KEY_BYTES))
        plan = plan_of(checks.key_tests("t", keys, "k"), capsys)
        assert f", {counts[-1]}), REPARTITION_BY_NUM" in plan
        assert "partial_count" not in plan.split("REPARTITION_BY_NUM")[1].split("Range")[0]
    assert counts[0] == 8 and counts[1] > 100 and 1.9 < counts[2] / counts[1] < 2.1
    some = rows("k long", (1,), (1,), (1,), (2,), (None,), (3,), (3,), (None,))
    for frame, found in ((some, (2, 2)), (some.where("k = 2"), (0, 0)), (some.where("false"), (0, 0))):
        assert list(map(tuple, checks.key_tests("t", frame, "k").collect())) == [
            ("unique_t_k", found[0]), ("not_null_t_k", found[1])]


def test_orphans_are_counted_without_a_join(spark, rows, capsys):
    """Neither side is sorted or held beside the other, however long the list of parents is."""
    child = rows("k long", (1,), (1,), (2,), (2,), (2,), (None,), (None,))
    parent = rows("p int", (1,), (1,), (5,), (None,))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for count_null, found in ((True, 5), (False, 3)):
            frame = checks.orphans("x", child, "k", parent, "p", count_null)
            assert frame.collect() == [("x", found)]
            plan = plan_of(frame, capsys)
            assert "Join" not in plan and "Sort" not in plan
        assert checks.orphans("x", child, "k", parent.where("false"), "p").collect() == [("x", 7)]
        assert checks.orphans("x", child.where("false"), "k", parent, "p").collect() == [("x", 0)]
        assert checks.orphans("x", child.where("k = 1"), "k", parent, "p").collect() == [("x", 0)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_long_lists_in_small_files_are_not_broadcast(spark, rows, tmp_path, capsys):
    """Keys beside wide constant columns take next to nothing in files, but not on the driver."""
    wide = [f"'{'x' * 20}' as c{n}" for n in range(30)]
    spark.range(9000).selectExpr("id as p", *wide).write.parquet(str(tmp_path / "wide"))
    parents, child = spark.read.parquet(str(tmp_path / "wide")), rows("p long", (1,), (1,), (None,), (9500,))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        keys = parents.select("p")
        assert fits_broadcast(keys) and not too_long(keys, 4000) and too_long(keys, 9000)
        assert "BroadcastHashJoin [p#" in plan_of(child.join(keys, "p"), capsys)
        lost = orphan_keys(child, ForeignKey("p", "parents", "p"), parents)
        ddl = "p long, ingestion_date string, batch_id string"
        batch = "p", "'d' as ingestion_date", "'a' as batch_id"
        parents.selectExpr(*batch, *wide).write.parquet(str(tmp_path / "gone"))
        gone = spark.read.parquet(str(tmp_path / "gone")).selectExpr(*batch)
        aside = rows(ddl, (1, "d", "a"), (9500, "d", "a"), (9500, "d", "b"))
        found = [
            (lost, [(9500,)]),
            (lookup_join(child, keys, ["p"], "left_semi", lookup_rows=9000), [(1,), (1,)]),
            (lookup_join(child, keys, ["p"], "left_anti", lookup_rows=9000, hashed=True), [(None,), (9500,)]),
            (snapshots.staying(aside, gone, ["p"]), [(9500, "d", "a")]),
            (snapshots.merged(child, keys, ["p"], 9000).where("p is null or p > 8998"), [(None,), (8999,), (9500,)]),
        ]
        for frame, expected in found:
            assert sorted(map(tuple, frame.collect()), key=str) == sorted(expected, key=str)
            # Batches and heavy keys may be; there are few of them.
            assert "BroadcastHashJoin [p#" not in plan_of(frame.select("*"), capsys)
        assert "BroadcastHashJoin [p#" in plan_of(lookup_join(child, keys, ["p"], lookup_rows=4000), capsys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
