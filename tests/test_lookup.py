"""The join of large lookups: the same rows as a plain join, and no task full of one hot key."""

import pytest
from pyspark.sql import functions as F

from shopgrain.operators import lookup as lk
from shopgrain.operators import quality
from shopgrain.operators.lookup import heavy_keys, lookup_join, sketch_sizes


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows has key 7, a sixth has none, the rest is spread."""
    key = (
        F.when(F.col("id") % 6 < 2, 7)
        .when(F.col("id") % 6 == 2, None)
        .otherwise(F.col("id") % 997)
        .cast("bigint")
    )
    return spark.range(0, 60000, numPartitions=8).select(key.alias("k"), F.col("id").alias("v"))


@pytest.fixture(scope="module")
def names(spark):
    return spark.range(0, 900).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("n"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows_as_a_plain_join(skewed, names, how):
    plain = skewed.join(names, "k", how)
    pieces = lookup_join(skewed, names, ["k"], how, broadcast_small=False)
    assert pieces.columns == plain.columns
    assert pieces.exceptAll(plain).isEmpty() and plain.exceptAll(pieces).isEmpty()


def test_heavy_keys_are_found(skewed):
    found = heavy_keys(skewed, ["k"]).collect()
    assert len(found) == 2  # key 7 and null
    assert all(row["__pieces"] > 1 for row in found)


def test_thousands_of_heavy_keys_are_all_found(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "20000")
    try:
        rows = spark.range(0, 40000, numPartitions=4).select((F.col("id") % 5000).alias("k"))
        assert heavy_keys(rows, ["k"]).count() == 5000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_key_is_cut_into_pieces(spark, skewed, names):
    # Without AQE the partition of a row is that of its join key, so the split shows.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(skewed, names, ["k"], "left", broadcast_small=False)
        sizes = [
            r["count"]
            for r in joined.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
        ]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == skewed.where("k = 7").count()
    assert len(sizes) > 1 and max(sizes) < 15000


def test_copies_of_one_row_are_spread(spark, names):
    copies = spark.range(0, 8000, numPartitions=8).select(F.lit(7).cast("bigint").alias("k"))
    joined = lookup_join(copies, names, ["k"], broadcast_small=False)
    assert joined.count() == 8000


def test_even_keys_join_plainly(spark, names):
    even = spark.range(0, 9000, numPartitions=8).select((F.col("id") % 900).alias("k"))
    joined = lookup_join(even, names, ["k"], broadcast_small=False)
    assert "__piece" not in joined._jdf.queryExecution().logical().toString()
    assert joined.count() == 9000


def test_empty_rows(skewed, names):
    assert lookup_join(skewed.limit(0), names, ["k"], broadcast_small=False).isEmpty()


def test_key_types_must_match(skewed, spark):
    with pytest.raises(TypeError):
        lookup_join(skewed, spark.range(5).select(F.col("id").cast("int").alias("k")), ["k"])
    with pytest.raises(ValueError):
        lookup_join(skewed, skewed, ["k"], "full")


def test_duplicates_without_broadcast(monkeypatch, skewed):
    monkeypatch.setattr(lk, "fits_broadcast", lambda frame: False)
    marked = quality.mark_duplicates(skewed, ["k"])
    counts = skewed.groupBy("k").count()
    expected = {(r.k, r["count"] > 1) for r in counts.collect()}
    got = {(r.k, r["__duplicate"]) for r in marked.select("k", "__duplicate").distinct().collect()}
    assert got == expected
    assert marked.count() == skewed.count()


def test_orphans_without_broadcast(monkeypatch, skewed, names):
    from shopgrain.rules import ForeignKey

    monkeypatch.setattr(lk, "fits_broadcast", lambda frame: False)
    rows = skewed.withColumn("rejection_reason", F.lit(None).cast("string"))
    marked = quality.mark_orphans(rows, ForeignKey("k", "names", "k"), names, key_source=skewed)
    wrong = marked.where(
        F.col("rejection_reason").isNull() != (F.coalesce(F.col("k"), F.lit(-1)).between(0, 899))
    )
    assert marked.count() == skewed.count() and wrong.isEmpty()


@pytest.mark.parametrize("tasks", [1, 8, 200, 131_072, 1_000_000])
def test_sketches_fit_any_number_of_partitions(spark, tasks):
    groups, asked, items = sketch_sizes(tasks)
    assert groups * asked >= tasks and asked <= items <= 1_000_000
    assert groups <= 128 or tasks > 100_000
    before = spark.conf.get("spark.sql.shuffle.partitions")
    hot = 5 if tasks == 1 else 1000
    frame = spark.range(4000).select(F.when(F.col("id") % 4 < 3, F.lit(hot)).otherwise(
        F.col("id")).alias("k"))
    wanted = spark.range(1).select(F.xxhash64(F.lit(hot).cast("bigint")).alias("h")).first().h
    frame = frame.select(F.col("k").cast("bigint"))
    try:
        found = frame.select(F.xxhash64("k").alias("h"))
        top = found.groupBy(F.pmod("h", F.lit(groups)).alias("g")).agg(
            F.expr(f"approx_top_k(h, {asked}, {items})").alias("top")
        ).select(F.inline("top"))
        assert max(top.collect(), key=lambda r: r["count"])["item"] == wanted
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
