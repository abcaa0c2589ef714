"""Newest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.rules import LATEST_ORDER, PROCESSED_AT


def latest_per_key(
    frame: DataFrame,
    keys: list[str],
    order_by: tuple[str, ...] = LATEST_ORDER,
    fallback: str = PROCESSED_AT,
) -> DataFrame:
    """The row with the greatest ordering columns per key; nulls order lowest.

    A maximum over a struct combines on the map side, so a hot key sends one row per map task
    instead of all its versions. The remaining columns follow in the struct and settle ties, which
    makes the choice repeatable when a task runs again.
    """
    order = [name for name in order_by if name in frame.columns] or [fallback]
    rest = [name for name in frame.columns if name not in keys and name not in order]
    newest = F.max(F.struct(*order, *rest)).alias("__row")
    return frame.groupBy(*keys).agg(newest).select(*keys, "__row.*").select(*frame.columns)
