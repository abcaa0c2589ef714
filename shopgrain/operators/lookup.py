"""Join rows to a table with one row per key, without letting a hot key fill one task.

Three cases:

* the lookup is small enough to broadcast, by its files and, where known, by its rows: a plain join,
  which Catalyst broadcasts;
* otherwise bounded sketches look for heavy keys on the row side; without any, a plain shuffle join;
* with some, their rows are cut into pieces and only their lookup rows are repeated, once per
  piece, while all other keys take part in the same join unsplit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.runtime import fits_broadcast, too_long, written

# Keys are dealt to groups, each with a sketch of its own. A task holds a sketch for each group it
# meets; beyond 128 a hash aggregate of objects falls back to sorting, so there are more groups
# only where a sketch would otherwise outgrow `MOST_ITEMS`.
GROUPS, MOST_ITEMS = 96, 1 << 16

_HASH, _PIECES, _PIECE = "__key_hash", "__pieces", "__piece"


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "inner",
    key_source: DataFrame | None = None,
    broadcast_small: bool = True,
    under: str | None = None,
    hashed: bool = False,
    lookup_rows: int | None = None,
) -> DataFrame:
    """Equi-join of `rows` to `lookup`; both must have the `on` columns with equal types.

    `key_source` is a cheaper frame with the same keys, such as the scan `rows` was computed from,
    to look for heavy keys in. What is staged goes below `under`, a folder of `staging`, where given.
    With `hashed`, for a lookup of little more than its keys, each task holds its share of it in a hash
    table, and the rows are not sorted. `lookup_rows` is how many rows the lookup has, where known: one
    that is longer than the planner takes it for is not broadcast.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    for name in on:
        mine, theirs = rows.schema[name].dataType, lookup.schema[name].dataType
        if mine.simpleString() != theirs.simpleString():
            raise TypeError(f"{name}: {mine.simpleString()} does not match {theirs.simpleString()}")
    long = too_long(lookup, lookup_rows)
    if broadcast_small and not long and fits_broadcast(lookup):
        return rows.join(lookup, on, how)
    # The planner would still broadcast a lookup that only its rows rule out.
    way = "shuffle_hash" if hashed else "merge" if long else None
    # The sketch is approximate and could come out differently if it ran again. Both sides must
    # agree on the pieces, also when a task is repeated, so its result is written down once.
    source = rows if key_source is None else key_source
    heavy = written(heavy_keys(source, on, under), "heavy", under=under)
    if heavy.isEmpty():
        return rows.join(_joined(lookup, way), on, how)
    return _join_in_pieces(rows, lookup, on, how, F.broadcast(heavy), way)


def _joined(lookup: DataFrame, way: str | None) -> DataFrame:
    return lookup if way is None else lookup.hint(way)


def sketch_sizes(tasks: int) -> tuple[int, int, int]:
    """(groups, keys asked of a group, items of its sketch) for a number of shuffle partitions.

    Fewer than `tasks` keys are heavy. Dealt to groups by hash they spread evenly, with room for
    the square root of that above the mean; a sketch keeps four times what is asked. From the
    counts' point of view a group holds about its share of all rows, or one hot key more, and an
    item is wrong by at most the group's rows over its size.
    """
    groups = min(GROUPS, max(tasks, 1))
    while 8 * tasks // groups > MOST_ITEMS:
        groups *= 2
    mean = -(-tasks // groups)
    asked = mean + 8 * int(mean ** 0.5 + 1)
    items = 1 << max(4 * asked, 64).bit_length()
    return groups, asked, items


def heavy_keys(rows: DataFrame, on: list[str], under: str | None = None) -> DataFrame:
    """Key hashes that hold more rows than a task's even share, with the pieces to cut them into.

    There are fewer of them than shuffle partitions, and the sketches together keep a multiple of
    that number. Every task sums up its rows in a sketch for each group of keys; sketches of a group
    meet in one task, so no task gets a sketch from every other for all keys. The counts are
    estimates; they decide only where rows travel, never which rows are in the result.
    """
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups, asked, items = sketch_sizes(tasks)
    hashed = rows.select(F.xxhash64(*on).alias(_HASH))
    group = F.pmod(F.col(_HASH), F.lit(groups)).alias("g")
    sketches = hashed.groupBy(group).agg(
        F.expr(f"approx_top_k({_HASH}, {asked}, {items})").alias("top"),
        F.count(F.lit(1)).alias("rows"),
    )
    summary = written(sketches, "sketches", under=under)
    total = summary.agg(F.sum("rows")).first()[0] or 0
    share = F.col("count") * tasks / F.lit(max(total, 1))
    return summary.select(F.inline("top")).where(share > 1).select(
        F.col("item").alias(_HASH),
        F.ceil(share * 2).cast("int").alias(_PIECES),
    )


def _join_in_pieces(
    rows: DataFrame, lookup: DataFrame, on: list[str], how: str, heavy: DataFrame, way: str | None
) -> DataFrame:
    # Deterministic for a given input partition, so a re-run task sends its rows the same way;
    # the partition id also separates rows that are exact copies of each other.
    others = [name for name in rows.columns if name not in on]
    spot = F.xxhash64(F.spark_partition_id(), *others)
    placed = (
        rows.withColumn(_HASH, F.xxhash64(*on))
        .withColumn(_PIECE, spot)
        .join(heavy, _HASH, "left")
        .withColumn(
            _PIECE, F.coalesce(F.pmod(F.col(_PIECE), F.col(_PIECES)), F.lit(0)).cast("int")
        )
        .drop(_HASH, _PIECES)
    )
    repeated = (
        lookup.withColumn(_HASH, F.xxhash64(*on))
        .join(heavy, _HASH, "left")
        .withColumn(
            _PIECE, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_PIECES), F.lit(1)) - 1))
        )
        .drop(_HASH, _PIECES)
    )
    return placed.join(_joined(repeated, way), [*on, _PIECE], how).drop(_PIECE)
