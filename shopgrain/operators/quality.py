"""Row-level quality: reasons, duplicate and orphan marks, accepted/rejected split."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shopgrain.operators.lookup import lookup_join
from shopgrain.rules import (
    CORRUPT,
    PROCESSED_AT,
    REASON,
    REASON_SEPARATOR,
    Bounds,
    EntityRules,
    ForeignKey,
)

_DUPLICATE = "__duplicate"
_KEY = "__key"
_FOUND = "__found"
_KNOWN = "__known"

Settle = Callable[[DataFrame], DataFrame]


def standardise(frame: DataFrame) -> DataFrame:
    """Trim every text column and stamp the processing time, in one projection."""
    return frame.select(
        *[
            F.trim(F.col(field.name)).alias(field.name)
            if isinstance(field.dataType, StringType)
            else F.col(field.name)
            for field in frame.schema.fields
            if field.name != PROCESSED_AT
        ],
        F.current_timestamp().alias(PROCESSED_AT),
    )


def _bound_reasons(bounds: Bounds) -> list[Column]:
    value = F.col(bounds.column)
    limits = (
        ("below_min", bounds.min_inclusive, value.__lt__),
        ("below_min_exclusive", bounds.min_exclusive, value.__le__),
        ("above_max", bounds.max_inclusive, value.__gt__),
        ("above_max_exclusive", bounds.max_exclusive, value.__ge__),
    )
    return [
        F.when(breaks(F.lit(limit)), F.lit(f"{label}_{bounds.column}"))
        for label, limit, breaks in limits
        if limit is not None
    ]


def row_reasons(columns: list[str], rules: EntityRules) -> list[Column]:
    """One nullable text column per rule, in reporting order; null means the rule holds.

    A required column the frame lacks is a fault of every row. Other rules on absent columns
    do not apply. Comparisons with null are null, so only the required rule sees nulls.
    """
    present = set(columns)
    unread = [F.when(F.col(CORRUPT).isNotNull(), F.lit(CORRUPT))] if CORRUPT in present else []
    required = [
        F.when(F.col(name).isNull(), F.lit(f"null_{name}"))
        if name in present
        else F.lit(f"missing_{name}")
        for name in rules.required
    ]
    accepted = [
        F.when(~F.col(name).isin(list(values)), F.lit(f"invalid_{name}"))
        for name, values in rules.accepted.items()
        if name in present
    ]
    numeric = [
        reason
        for bounds in rules.bounds
        if bounds.column in present
        for reason in _bound_reasons(bounds)
    ]
    return [*unread, *required, *accepted, *numeric]


def repeated_keys(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Keys (as one struct column) that occur more than once; counted with map-side combine."""
    return (
        frame.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .where("__rows > 1")
        .select(F.struct(*keys).alias(_KEY))
    )


def mark_duplicates(
    frame: DataFrame, keys: list[str], settle: Settle | None = None, under: str | None = None
) -> DataFrame:
    """Add a flag that is true on every copy of a repeated key. Null keys equal each other.

    Counting per key first keeps a key with a third of all rows down to one row per map task;
    a window over the rows would send all its copies to one task. `settle` may write the repeated
    keys to files, so that their true size decides how the rows are joined to them: a list that
    fits a broadcast costs no shuffle of the rows, and a longer one no sort of them.
    """
    repeated, count = repeated_keys(frame, keys), None
    if settle is not None:
        repeated = settle(repeated)
        count = repeated.count()
    return (
        lookup_join(
            frame.withColumn(_KEY, F.struct(*keys)),
            repeated.withColumn(_DUPLICATE, F.lit(True)),
            [_KEY],
            "left",
            key_source=frame.select(F.struct(*keys).alias(_KEY)),
            under=under,
            hashed=True,
            lookup_rows=count,
        )
        .withColumn(_DUPLICATE, F.coalesce(F.col(_DUPLICATE), F.lit(False)))
        .drop(_KEY)
    )


def annotate(
    frame: DataFrame,
    rules: EntityRules,
    duplicate_scope: str = "batch",
    settle: Settle | None = None,
    under: str | None = None,
) -> DataFrame:
    """Standardised rows with `rejection_reason`: reasons joined in rule order, null when valid.

    `duplicate_scope="batch"` looks for repeated keys within a batch, so that landing a full table
    again is no fault; `"all"` looks across everything in `frame`, `"none"` at no keys.
    """
    if duplicate_scope not in ("batch", "all", "none"):
        raise ValueError(f"unknown duplicate scope: {duplicate_scope}")
    clean = standardise(frame)
    reasons = row_reasons(clean.columns, rules)
    keys = list(rules.identity)
    if duplicate_scope != "none" and all(name in clean.columns for name in keys):
        if duplicate_scope == "batch" and "batch_id" in clean.columns:
            keys.append("batch_id")
        clean = mark_duplicates(clean, keys, settle, under)
        reasons.append(F.when(F.col(_DUPLICATE), F.lit(f"duplicate_{rules.key}")))
    joined = F.concat_ws(REASON_SEPARATOR, *reasons)
    return clean.withColumn(REASON, F.nullif(joined, F.lit(""))).drop(_DUPLICATE)


def orphan_keys(child: DataFrame, foreign_key: ForeignKey, parent: DataFrame) -> DataFrame:
    """Values of the child's foreign key that no parent has.

    Only the key column travels, and each value once: a key with a third of the child's rows is
    one row per map task. Both sides meet in one grouping: no task and not the driver holds all
    parents, however small the files are that they are read from.
    """
    column = foreign_key.column
    known = parent.select(
        F.col(foreign_key.parent_column).cast(child.schema[column].dataType).alias(column),
        F.lit(True).alias(_KNOWN),
    )
    named = child.where(F.col(column).isNotNull()).select(column, F.lit(False).alias(_KNOWN))
    return named.union(known).groupBy(column).agg(
        F.bool_or(_KNOWN).alias(_KNOWN)
    ).where(~F.col(_KNOWN)).select(column)


def mark_orphans(
    annotated: DataFrame,
    foreign_key: ForeignKey,
    parent: DataFrame,
    every_orphan: bool = False,
    key_source: DataFrame | None = None,
    settle: Settle | None = None,
    under: str | None = None,
) -> DataFrame:
    """Give valid rows whose foreign key has no parent the orphan reason.

    Rows that already have a reason keep it, so only the first failing key is named, unless
    `every_orphan` asks for all of them. A null key has no parent. `key_source` is a cheaper frame
    with the same foreign keys, such as the standardised rows before any join. As with repeated
    keys, `settle` may write the orphan keys first: few of them are broadcast, and the rows stay
    where they are.
    """
    source = annotated if key_source is None else key_source
    lost, count = orphan_keys(source, foreign_key, parent), None
    if settle is not None:
        lost = settle(lost)
        count = lost.count()
    orphan = F.col(_FOUND).isNotNull() | F.col(foreign_key.column).isNull()
    already = F.col(REASON)
    if every_orphan:
        named = F.when(orphan, F.lit(foreign_key.reason))
        rule_fault = already.isNotNull() & ~already.startswith("orphan_")
        verdict = F.when(rule_fault, already).otherwise(
            F.nullif(F.concat_ws(REASON_SEPARATOR, already, named), F.lit(""))
        )
    else:
        verdict = F.coalesce(already, F.when(orphan, F.lit(foreign_key.reason)))
    columns = annotated.columns
    return (
        lookup_join(
            annotated,
            lost.withColumn(_FOUND, F.lit(True)),
            [foreign_key.column],
            "left",
            key_source=source,
            under=under,
            hashed=True,
            lookup_rows=count,
        )
        .withColumn(REASON, verdict)
        .select(*columns)
    )


def split(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows)."""
    faulty = F.col(REASON).isNotNull()
    return annotated.where(~faulty), annotated.where(faulty)
