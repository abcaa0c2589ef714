"""Finding the rows in which two tables differ.

Row hashes are added up per range of key hashes on both sides. The sums do not depend on the order
of rows, and only ranges whose sums differ are looked at again, row by row. Tables that agree cost
one pass over each and no shuffle of their rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.runtime import written

# Ranges of the key hash that are summed up, and the column names used on the way.
RANGES = 4096
_RANGE, _ROWS, _SUM, _KEY = "__range", "__rows", "__sum", "__key"


def row_hash(columns: list[str]) -> Column:
    """A hash of the values of a row; null is a value of its own in every column."""
    parts: list[Column] = []
    for name in columns:
        parts += [F.col(name), F.col(name).isNull()]
    return F.xxhash64(*parts)


def _hashed(frame: DataFrame, key: list[str], columns: list[str], ranges: int) -> DataFrame:
    """Key, its range, and the row's hash as a number that sums do not overflow."""
    return frame.select(
        F.struct(*key).alias(_KEY),
        F.pmod(row_hash(key), F.lit(ranges)).alias(_RANGE),
        row_hash(columns).cast("decimal(20,0)").alias(_SUM),
    )


def _added(hashed: DataFrame, by: str) -> DataFrame:
    return hashed.groupBy(by).agg(F.count(F.lit(1)).alias(_ROWS), F.sum(_SUM).alias(_SUM))


def _apart(left: DataFrame, right: DataFrame, by: str) -> DataFrame:
    """`by` values whose counts or sums differ, with the rows of both sides."""
    other = right.select(by, F.col(_ROWS).alias("__rows_r"), F.col(_SUM).alias("__sum_r"))
    joined = left.join(other, by, "full")
    same = F.col(_ROWS).eqNullSafe(F.col("__rows_r")) & F.col(_SUM).eqNullSafe(F.col("__sum_r"))
    return joined.where(~same).select(
        by, F.coalesce(_ROWS, F.lit(0)).alias("left_rows"),
        F.coalesce("__rows_r", F.lit(0)).alias("right_rows"),
    )


def differing_rows(
    left: DataFrame, right: DataFrame, key: list[str], ignore: tuple[str, ...] = (),
    ranges: int = RANGES, under: str | None = None,
) -> DataFrame:
    """The key columns of rows that differ, with `difference`: left_only, right_only or changed.

    Compared are the columns both tables have, but for those of `ignore`; types must agree.
    Rows of one key, should it repeat, are compared as a group, whatever their order. Null keys
    equal each other. The ranges that differ, at most `ranges` rows, are broadcast. What is staged
    goes below `under`.
    """
    columns = [c for c in left.columns if c in right.columns and c not in ignore]
    sides = [_hashed(frame, key, columns, ranges) for frame in (left, right)]
    apart = written(
        _apart(*[_added(side, _RANGE) for side in sides], _RANGE).select(_RANGE), "ranges",
        under=under,
    )
    rows = [side.join(F.broadcast(apart), _RANGE, "left_semi") for side in sides]
    found = _apart(*[_added(side, _KEY) for side in rows], _KEY)
    difference = F.when(F.col("right_rows") == 0, "left_only").when(
        F.col("left_rows") == 0, "right_only"
    ).otherwise("changed")
    return found.select(f"{_KEY}.*", difference.alias("difference"))
