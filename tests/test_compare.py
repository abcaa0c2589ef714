"""Rows that differ, active customers, late commits and loads that stop, on small tables."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shopgrain.operators import compare
from shopgrain.plans import activity, jobs
from shopgrain.sources import landing

DDL = "k long, v string, n double"


@pytest.mark.parametrize("ranges", [1, 7, 4096])
def test_differences_equal_a_dictionary(spark, rows, ranges):
    rng = random.Random(ranges)
    left = {k: (rng.choice(["a", None, ""]), rng.choice([1.0, None])) for k in [None, *range(60)]}
    right = {k: v for k, v in left.items() if k is None or k % 9} | {100: ("a", 1.0)}
    right |= {5: (None, None), 7: ("b", 2.0), None: ("z", None)}
    frames = [rows(DDL, *[(k, *v) for k, v in side.items()]) for side in (left, right)]
    found = {r.k: r.difference for r in compare.differing_rows(
        *[f.withColumn("at", F.rand()) for f in frames], ["k"], ignore=("at",), ranges=ranges).collect()}
    expected = {k: "left_only" for k in left.keys() - right.keys()} | {k: "right_only" for k in right.keys() - left.keys()}
    expected |= {k: "changed" for k in left.keys() & right.keys() if left[k] != right[k]}
    assert found == expected


def test_nulls_and_repeats_count(spark, rows):
    swapped = compare.differing_rows(rows("k long, a long, b long", (1, None, 2)), rows("k long, a long, b long", (1, 2, None)), ["k"])
    assert [r.difference for r in swapped.collect()] == ["changed"]
    once, twice = rows(DDL, (1, "a", 1.0)), rows(DDL, (1, "a", 1.0), (1, "a", 1.0))
    assert [r.difference for r in compare.differing_rows(once, twice, ["k"]).collect()] == ["changed"]
    assert compare.differing_rows(twice, twice.repartition(3), ["k"]).isEmpty()
    assert compare.differing_rows(once.limit(0), once.limit(0), ["k"]).isEmpty()


def test_windows_against_sets(spark, rows):
    rng = random.Random(2)
    days = [date(2024, 1, 1) + timedelta(days=rng.randrange(40)) for _ in range(80)]
    orders = [(i, rng.choice([1, 2, 40_000, 99_999, None]), datetime(d.year, d.month, d.day, 5)) for i, d in enumerate(days)]
    orders += [(999, 1, None), (998, 7, datetime(2024, 1, 3))]  # no date, unknown customer
    segment = {1: "x", 2: "y", 40_000: "x", 99_999: None}
    bitmaps = activity.daily_bitmaps(
        rows("order_key long, customer_key long, order_timestamp timestamp", *orders),
        rows("customer_key long, customer_segment string", *segment.items()))
    windows = (1, 2, 5, 8, 13)
    found = {(r.activity_date, r.customer_segment, r.window_days): r.active_customers
             for r in activity.active_customers(bitmaps, windows).collect()}
    expected = {}
    for end in (min(days) + timedelta(days=n) for n in range((max(days) - min(days)).days + 1)):
        for window in windows:
            for c, s in segment.items():
                if any(k == c and t and end - timedelta(days=window) < t.date() <= end for _, k, t in orders):
                    expected[end, s, window] = expected.get((end, s, window), 0) + 1
    assert found == expected
    with pytest.raises(ValueError):
        activity.active_customers(bitmaps, (0,))


def test_looking_back_takes_what_was_not_landed(spark, rows):
    ddl = "order_id long, updated_at timestamp"
    at = lambda day: datetime(2024, 1, day)
    landed = rows(ddl, (1, at(10)), (2, at(12)))
    source = rows(ddl, (1, at(10)), (2, at(12)), (3, at(11)), (4, at(13)), (1, at(11)), (5, at(2)))
    take = lambda **more: sorted((r[0], r[1].day) for r in landing.changed_since(
        source, "orders", "2024-01-12 00:00:00", **more).collect())
    assert take() == [(4, 13)]
    assert take(look_back="3 days", landed=landed) == [(1, 11), (3, 11), (4, 13)]
    assert take(look_back="3 days") == [(4, 13)]


def test_a_load_that_stops_shows_nothing_of_itself(spark, rows):
    spark.sql("create database if not exists steps")
    one, two = rows("A long", (1,)), rows("A long", (1,), (2,))
    assert jobs.publish_load(spark, {"dim_date": one, "dim_country": one}, "steps") == {"dim_date": 1, "dim_country": 1}
    with pytest.raises(Exception):
        jobs.publish_load(spark, {"dim_date": two, "dim_country": two.withColumnRenamed("A", "b")}, "steps")
    assert [spark.table(f"steps.{t}").count() for t in ("dim_date", "dim_country")] == [1, 1]
    assert jobs.publish_load(spark, {"dim_date": two, "dim_country": two}, "steps") == {"dim_date": 2, "dim_country": 2}
    assert [spark.table(f"steps.{t}").count() for t in ("dim_date", "dim_country")] == [2, 2]
    jobs.publish_load(spark, {"dim_date": one}, "steps")  # one table alone: the other stays as it is
    jobs.publish_load(spark, {"dim_date": one.limit(0)}, "steps")
    assert [spark.table(f"steps.{t}").count() for t in ("dim_date", "dim_country")] == [0, 2]
    # Of the current load, which is empty, there is no partition; the one before it stays.
    assert [r[0] for r in spark.sql("show partitions steps.dim_date_loads").collect()] == ["load_id=3"]
