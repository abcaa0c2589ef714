"""The key directory: the same upserts as without it, and what is read for them."""

import random

import pytest
from pyspark.sql import functions as F

from shopgrain.sources import directory as kd
from shopgrain.sources import snapshots
from shopgrain.sources.directory import KeyDirectory

DDL = "k long, at date, v string"


def dated(rows):
    return [(k, __import__("datetime").date(2024, m, 1) if m else None, v) for k, m, v in rows]


@pytest.mark.parametrize("few", [0, 500])
def test_upserts_equal_a_dictionary(spark, rows, tmp_path, monkeypatch, few):
    monkeypatch.setattr(kd, "FEW_KEYS", few)
    monkeypatch.setattr(kd, "ADDITIONS", 1)  # every other upsert writes the pairs anew
    path, state, rng = str(tmp_path / "t"), {}, random.Random(few)
    for step in range(4):
        changes = {rng.randrange(40): (rng.choice([None, 1, 2, 3]), f"{step}") for _ in range(12)}
        batch = [(k, m, v) for k, (m, v) in changes.items()]
        found = snapshots.upsert(rows(DDL, *dated(batch)), path, ["k"], month_of="at", key_buckets=4)
        state |= {k: (m, v) for k, m, v in batch}
        got = {r.k: (r.at.month if r.at else None, r.v) for r in found.state.collect()}
        assert got == state and found.state.count() == len(state)


def test_a_table_without_directory_gets_one(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    snapshots.upsert(rows(DDL, *dated([(1, 1, "a"), (2, 2, "a")])), path, ["k"], month_of="at")
    snapshots.upsert(rows(DDL, *dated([(1, 3, "b")])), path, ["k"], month_of="at", key_buckets=2)
    state = snapshots.read_snapshot(spark, path).collect()
    assert sorted((r.k, r.v) for r in state) == [(1, "b"), (2, "a")]
    assert snapshots.months(spark, path) == ["m2024-02", "m2024-03"]


def test_pairs_of_a_stopped_write_only_cost_a_month(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    snapshots.upsert(rows(DDL, *dated([(1, 1, "a"), (2, 2, "a")])), path, ["k"], month_of="at", key_buckets=2)
    KeyDirectory(spark, f"{path}/keys", 2).add(rows("k long, m string", (1, "m2024-07"), (9, "m2024-02")))
    snapshots.upsert(rows(DDL, *dated([(1, 2, "b"), (9, 1, "n")])), path, ["k"], month_of="at", key_buckets=2)
    state = snapshots.read_snapshot(spark, path).collect()
    assert sorted((r.k, r.at.month, r.v) for r in state) == [(1, 2, "b"), (2, 2, "a"), (9, 1, "n")]


def test_few_keys_read_their_buckets_only(spark, rows, tmp_path, capsys):
    pairs = spark.range(1000).select("id", F.lit("m2024-01"))
    held = KeyDirectory(spark, str(tmp_path / "keys"), 16)
    held.add(pairs)
    # The planner prunes buckets in any case, but only shows them of a scan it deals by bucket.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        held.months(rows("k long", (5,), (6,))).explain("formatted")
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    plan = capsys.readouterr().out
    assert "SelectedBucketsCount: 2 out of 16" in plan or "SelectedBucketsCount: 1 out of 16" in plan
    many = spark.range(900).select(F.col("id").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held.months(many).explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out
    # One exchange deals the incoming keys, one groups the months found; the pairs stay in place.
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning(key") <= 1
