from pathlib import Path

import pytest

from shopgrain.rules import ENTITIES, LINEAGE_COLUMNS, ORDERS
from shopgrain.runtime import written
from shopgrain.schemas import bind_by_name, entity_schema
from shopgrain.sources import feeds, jdbc, landing, manifests, snapshots
from shopgrain.sources.landing import Batch
from shopgrain.sources.manifests import TableRun

BATCH = Batch("b1", "2024-01-01", "2024-01-01T00:00:00+00:00")


def test_batch_identity():
    batch = Batch.start()
    prefix, digits = batch.batch_id.split("_")
    assert prefix == "retail" and len(digits) == 12 and int(digits, 16) >= 0
    assert len(batch.ingestion_date) == 10 and batch.ingested_at.endswith("+00:00")


def test_landing_is_partitioned_and_repeatable(spark, rows, tmp_path):
    orders = rows("order_id bigint, total_amount double", (1, 2.0), (2, 3.0))
    for _ in range(2):
        landed = landing.with_lineage(orders, BATCH, "retail_postgres", "orders")
        path = landing.land(landed, str(tmp_path), ORDERS)
    assert (tmp_path / "postgres/orders/ingestion_date=2024-01-01/batch_id=b1").is_dir()
    assert path.endswith("postgres/orders")
    back = landing.read_landed(spark, str(tmp_path), ORDERS)
    assert back.count() == 2
    assert set(LINEAGE_COLUMNS) <= set(back.columns)
    assert back.first().ingestion_date == "2024-01-01"


def test_one_batch_is_read_through_its_partition(spark, rows, tmp_path):
    orders = rows("order_id bigint", (1,))
    for name in ("b1", "b2"):
        batch = Batch(name, "2024-01-01", "t")
        landing.land(landing.with_lineage(orders, batch, "s", "orders"), str(tmp_path), ORDERS)
    one = landing.read_landed(spark, str(tmp_path), ORDERS, batch_id="b2")
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "batch_id" in plan.split("PartitionFilters")[1][:200]


def test_csv_binds_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'new_value,update_id,sku\n"say ""hi"", now",1,S\nx,notanumber,T\n'
    )
    read = feeds.read_csv(spark, str(tmp_path), quote_escape='"')
    typed = bind_by_name(read, entity_schema("product_updates")).orderBy("sku").collect()
    assert typed[0].update_id == 1 and typed[0].new_value == 'say "hi", now'
    assert typed[1].update_id is None


def test_csv_files_with_other_columns_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        feeds.read_csv(spark, str(tmp_path)).collect()


def test_feed_folder_must_hold_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        feeds.require_files(spark, str(tmp_path / "none"), "*.json")
    (tmp_path / "a.csv").write_text("x\n")
    with pytest.raises(FileNotFoundError):
        feeds.require_files(spark, str(tmp_path), "*.json")
    feeds.require_files(spark, str(tmp_path), "*.csv")


def test_json_feed_shapes(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"event_id":"1"}\n\n  {"event_id":"2","customer_id":5}\n')
    (tmp_path / "array.json").write_text('[\n  {\n    "event_id": "3"\n  },\n  {"event_id": "4"}\n]\n')
    (tmp_path / "compact.json").write_text('[{"event_id":"5"},{"event_id":"6"}]')
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "half array.json").write_text('[{"event_id":"7"},\n{"event_id":"8"}]')
    found = feeds.read_json(spark, str(tmp_path), entity_schema("website_events")).collect()
    assert sorted(r.event_id for r in found) == list("12345678")
    files = {r.event_id: r.source_file for r in found}
    assert files["2"] == "lines.json" and files["4"] == "array.json"
    assert files["8"] == "half array.json"


def test_json_feed_of_known_shape(spark, tmp_path):
    schema = entity_schema("website_events")
    (tmp_path / "a.json").write_text('{"event_id":"1"}\n{"event_id":"2"}\n')
    (tmp_path / "b.txt").write_text('[\n{"event_id":"3"},\n{"event_id":"4"}\n]')
    assert feeds.read_json(spark, str(tmp_path), schema, shape="lines").count() == 2
    assert feeds.read_json(spark, str(tmp_path), schema, "*.txt", "arrays").count() == 2
    with pytest.raises(ValueError):
        feeds.read_json(spark, str(tmp_path), schema, shape="xml")


def test_json_feed_of_empty_files(spark, tmp_path):
    (tmp_path / "a.json").write_text("")
    assert feeds.read_json(spark, str(tmp_path), entity_schema("website_events")).count() == 0


def test_watermark_is_strict_and_only_for_incremental_tables(rows):
    frame = rows("updated_at string", ("2024-01-01",), ("2024-01-02",))
    assert landing.changed_since(frame, "orders", "2024-01-01").count() == 1
    assert landing.changed_since(frame, "orders").count() == 2
    assert landing.changed_since(frame, "customers", "2024-01-01").count() == 2


def test_unknown_entity():
    with pytest.raises(KeyError):
        landing.rules_of("suppliers")


def test_upsert(spark, rows, tmp_path):
    path, ddl = str(tmp_path / "t"), "k bigint, v string"
    assert snapshots.upsert(rows(ddl), path, ["k"]).state is None
    snapshots.upsert(rows(ddl, (1, "a"), (2, "b")), path, ["k"])
    done = snapshots.upsert(rows(ddl, (2, "B"), (3, "C")), path, ["k"])
    assert done.rows == 2
    assert sorted(map(tuple, done.state.collect())) == [(1, "a"), (2, "B"), (3, "C")]
    again = snapshots.upsert(rows(ddl, (2, "B"), (3, "C")), path, ["k"]).state
    assert sorted(map(tuple, again.collect())) == [(1, "a"), (2, "B"), (3, "C")]
    assert snapshots.upsert(rows(ddl), path, ["k"]).rows == 0
    assert snapshots.read_snapshot(spark, path).count() == 3


@pytest.fixture(params=[None, "d"], ids=["whole", "by_month"])
def layout(request):
    return request.param


def test_both_layouts_hold_the_same_state(spark, rows, tmp_path, layout, monkeypatch):
    """New column, moved month, interrupted commit, rerun."""
    path, ddl = str(tmp_path / "t"), "k bigint, d string, v string"

    def state():
        return sorted(
            tuple(r) for r in snapshots.read_snapshot(spark, path).select("k", "d", "v").collect()
        )

    def put(*data, columns=ddl):
        return snapshots.upsert(rows(columns, *data), path, ["k"], month_of=layout)

    put((1, "2024-01-05", "a"), (2, "2024-02-05", "b"), (3, "2024-03-05", "c"), (4, None, "n"))
    # Changed within its month; moved so that its old month is left empty; new without a date.
    put((1, "2024-01-06", "A"), (2, "2024-01-07", "B"), (5, None, "m"))
    expected = [
        (1, "2024-01-06", "A"), (2, "2024-01-07", "B"), (3, "2024-03-05", "c"),
        (4, None, "n"), (5, None, "m"),
    ]
    assert state() == expected
    if layout:
        assert snapshots.months(spark, path) == ["m2024-01", "m2024-03", "none"]
    # A stop between writing the parts and naming them: nothing is seen of it, a rerun completes it.
    def stopped(*args):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "write_text", stopped)
        with pytest.raises(RuntimeError):
            put((1, "2024-03-01", "x"), (6, "2024-09-01", "y"))
    assert state() == expected
    put((1, "2024-03-01", "x"), (6, "2024-09-01", "y"))
    expected = [(1, "2024-03-01", "x"), *expected[1:], (6, "2024-09-01", "y")]
    assert state() == expected
    put((1, "2024-03-01", "x"), (6, "2024-09-01", "y"))
    assert state() == expected
    # A column that comes later: rows of untouched months have nulls there.
    put((6, "2024-09-01", "y", "new"), columns=f"{ddl}, extra string")
    extra = {r.k: r.extra for r in snapshots.read_snapshot(spark, path).collect()}
    assert extra == {1: None, 2: None, 3: None, 4: None, 5: None, 6: "new"}
    assert state() == expected
    put((7, "2024-09-02", "z"))
    assert {r.k: r.extra for r in snapshots.read_snapshot(spark, path).collect()}[6] == "new"
    assert put().rows == 0 and len(state()) == 7
    with pytest.raises(snapshots.DuplicateKeys):
        put((7, "2024-01-01", "x"), (7, "2024-01-01", "y"))


def test_newer_rows_stay_in_both_layouts(spark, rows, tmp_path, layout):
    path, ddl = str(tmp_path / "t"), "k bigint, d string, at int"
    for data in ([(1, "2024-01-05", 5), (2, "2024-02-05", 5)], [(1, "2024-03-05", 4), (2, "2024-04-05", 6)]):
        snapshots.upsert(rows(ddl, *data), path, ["k"], newer_by=("at",), month_of=layout)
    state = snapshots.read_snapshot(spark, path).collect()
    assert sorted((r.k, r.d, r.at) for r in state) == [(1, "2024-01-05", 5), (2, "2024-04-05", 6)]


def test_untouched_months_are_not_written(spark, rows, tmp_path):
    path, ddl = str(tmp_path / "t"), "k bigint, d string"
    snapshots.upsert(rows(ddl, (1, "2024-01-05"), (3, "2024-03-05")), path, ["k"], month_of="d")
    before = snapshots.current_version(spark, path).parts
    snapshots.upsert(rows(ddl, (2, "2024-01-06")), path, ["k"], month_of="d")
    after = snapshots.current_version(spark, path).parts
    assert after["m2024-03"] == before["m2024-03"] and after["m2024-01"] != before["m2024-01"]


def test_layout_of_a_table_is_fixed(rows, tmp_path):
    path, ddl = str(tmp_path / "t"), "k bigint, d string"
    snapshots.upsert(rows(ddl, (1, "2024-01-05")), path, ["k"])
    with pytest.raises(ValueError):
        snapshots.upsert(rows(ddl, (1, "2024-01-05")), path, ["k"], month_of="d")


def test_old_versions_and_staged_files_go(spark, rows, tmp_path, layout):
    path = str(tmp_path / "t")
    shared = Path(spark.conf.get("spark.checkpoint.dir"), "shopgrain")
    before = set(shared.glob("*"))
    for value in range(4):
        frame = rows("k bigint, v int, d string", (1, value, "2024-01-01"), (9 + value, 0, "2024-01-02"))
        state = snapshots.upsert(frame, path, ["k"], month_of=layout)
    assert len(snapshots.versions(spark, path)) == snapshots.KEPT_VERSIONS
    assert len(list((tmp_path / "t" / "parts").glob("*/*.parquet"))) > 0 or layout
    assert {r.k: r.v for r in state.state.collect()} == {1: 3, 9: 0, 10: 0, 11: 0, 12: 0}
    assert set(shared.glob("*")) == before


def test_upsert_refuses_repeated_keys(rows, tmp_path):
    with pytest.raises(snapshots.DuplicateKeys):
        snapshots.upsert(rows("k bigint, v string", (1, "a"), (1, "b")), str(tmp_path / "t"), ["k"])


def test_half_written_version_is_ignored(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    snapshots.overwrite(rows("k bigint", (1,)), path)
    (tmp_path / "t" / "parts" / "v00000002").mkdir()
    assert snapshots.read_snapshot(spark, path).count() == 1
    snapshots.overwrite(rows("k bigint", (1,), (2,)), path)
    assert snapshots.read_snapshot(spark, path).count() == 2


def test_overwrite_with_nothing_keeps_the_state(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    assert snapshots.overwrite(rows("k bigint"), path) is None
    snapshots.overwrite(rows("k bigint", (1,)), path)
    assert snapshots.overwrite(rows("k bigint"), path).count() == 1


def test_rejected_rows(spark, rows, tmp_path):
    path = str(tmp_path / "q")
    assert snapshots.append_rejected(rows("k bigint"), path, "b1", "2024-01-01") == ""
    for batch in ("b1", "b2", "b2"):
        snapshots.append_rejected(rows("k bigint", (1,)), path, batch, "2024-01-01")
    back = snapshots.read_rejected(spark, path)
    assert back.count() == 2 and back.first().ingestion_date == "2024-01-01"


def test_newest_manifest_wins(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        manifests.newest_batch(spark, root)
    for batch, rows in (("old", 100), ("new", 10)):
        tables = [TableRun("dim_date", rows), TableRun("dim_customers", rows // 2)]
        manifests.write_manifest(spark, root, "gold", batch, "2024-01-01", tables)
    manifests.write_manifest(
        spark, root, "bronze", "b9", "2024-01-09", [TableRun("orders", 1, watermark="2024-01-05")]
    )
    counts = {r.table_name: r.row_count for r in manifests.latest_counts(spark, root, "gold").collect()}
    assert counts == {"dim_date": 10, "dim_customers": 5}
    assert manifests.newest_batch(spark, root) == ("b9", "2024-01-09")
    assert manifests.stored_watermarks(spark, root) == {"orders": "2024-01-05"}
    totals = {r.batch_id: r.total_rows for r in manifests.run_totals(spark, root).collect()}
    assert totals == {"old": 150, "new": 15, "b9": 1}


def test_jdbc_options():
    plain = jdbc.read_options("jdbc:x", "retail.orders", {"user": "u"})
    assert "numPartitions" not in plain and plain["user"] == "u"
    ranged = jdbc.read_options("jdbc:x", "retail.orders", {}, "order_id", (1, 900), 8)
    assert ranged["partitionColumn"] == "order_id"
    assert (ranged["lowerBound"], ranged["upperBound"], ranged["numPartitions"]) == ("1", "900", "8")


def test_jdbc_load_needs_all_tables(rows):
    with pytest.raises(KeyError, match="payments"):
        jdbc.load_all({"customers": rows("k bigint")}, "jdbc:x")


def test_numeric_batch_ids_and_single_batches(spark, rows, tmp_path):
    root = str(tmp_path)
    for name, n in (("007", 2), ("7", 3), ("1e5", 1)):
        frame = rows("product_id bigint, name string", *[(i, name) for i in range(n)])
        batch = landing.Batch(name, "2024-01-01", "x")
        landing.land(landing.with_lineage(frame, batch, "s", "f"), root, ENTITIES["products"])
    for name, n in (("007", 2), ("7", 3), ("1e5", 1), ("8", 0)):
        back = landing.read_landed(spark, root, ENTITIES["products"], batch_id=name)
        assert [r.batch_id for r in back.collect()] == [name] * n
    everything = landing.read_landed(spark, root, ENTITIES["products"])
    assert everything.count() == 6 and everything.schema["batch_id"].dataType.simpleString() == "string"


def test_json_records_over_several_lines_are_kept_as_corrupt(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"event_id": "1"}\n\n{"event_id":\n"2"\n}\n')
    frame = feeds.read_json(spark, str(tmp_path), entity_schema("website_events"), shape="lines")
    found = {(r.event_id, r.corrupt_record) for r in frame.select("event_id", "corrupt_record", "sku").collect()}
    assert ("1", None) in found and (None, '{"event_id":') in found and len(found) > 2


def test_json_lines_leave_out_absent_fields(rows):
    text = feeds.json_lines(rows("a string, b double", ("x", None), ("y", 1.5)))
    assert [r.value for r in text.orderBy("value").collect()] == ['{"a":"x"}', '{"a":"y","b":1.5}']


def test_every_entity_schema_has_its_key():
    for name, rules in ENTITIES.items():
        assert rules.key in entity_schema(name).names
        assert set(rules.required) <= set(entity_schema(name).names)


def test_csv_tables(spark, tmp_path):
    (tmp_path / "payments.csv").write_text("amount,payment_id\n12.50,7\n")
    schemas = {"payments": entity_schema("payments")}
    row = feeds.read_csv_tables(spark, str(tmp_path), schemas)["payments"].first()
    assert (row.payment_id, str(row.amount)) == (7, "12.50")
    with pytest.raises(FileNotFoundError):
        feeds.read_csv_tables(spark, str(tmp_path), {"orders": entity_schema("orders")})


def test_csv_export(spark, rows, tmp_path):
    feeds.export_csv({"t": rows("a string, b int", ("x,y", 1))}, str(tmp_path))
    assert feeds.read_csv(spark, str(tmp_path / "t")).first().a == "x,y"
