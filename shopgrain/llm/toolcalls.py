"""Tool-call linking for chat training data.

Calls and results meet in a join by identifier. A call may wait for another call; its depth in
that order is found by pointer doubling, so that a chain of n calls takes log2(n) joins, however
its calls are spread. Arguments are checked against the tool's schema, and every call with its result
is written as canonical JSON.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import staged

_TYPES = {
    "string": str, "boolean": bool, "object": dict, "array": list, "null": type(None),
    "number": (int, float), "integer": int,
}


def _is(value, kind: str) -> bool:
    if isinstance(value, bool):
        return kind == "boolean"
    if kind == "integer" and isinstance(value, float):
        return value.is_integer()
    return isinstance(value, _TYPES[kind])


def violations(value, schema: dict, path: str = "$") -> list[str]:
    """Where a value departs from a schema: type, enum, required, properties,
    additionalProperties, items, and bounds on numbers, strings and arrays."""
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, kind) for kind in kinds):
        return [f"{path}: not {' or '.join(kinds)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{path}: not in enum")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            out.append(f"{path}: below minimum")
        if value > schema.get("maximum", value):
            out.append(f"{path}: above maximum")
    for kind, low, high in ((str, "minLength", "maxLength"), (list, "minItems", "maxItems")):
        if isinstance(value, kind):
            if len(value) < schema.get(low, 0):
                out.append(f"{path}: shorter than {low}")
            if len(value) > schema.get(high, len(value)):
                out.append(f"{path}: longer than {high}")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for key in sorted(value):
            if key in known:
                out += violations(value[key], known[key], f"{path}.{key}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{path}.{key}: not known")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            out += violations(item, schema["items"], f"{path}[{i}]")
    return out


def _plain(value):
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("not a finite number")
        return int(value) if value.is_integer() and abs(value) < 2 ** 53 else value
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    return [_plain(v) for v in value] if isinstance(value, list) else value


def canonical(value) -> str:
    """One spelling for equal values: keys by code point, no spaces, whole numbers without a
    fraction, text as it is."""
    return json.dumps(
        _plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False
    )


def _parsed(text: str | None) -> tuple[object, bool]:
    try:
        value = json.loads(text or "")
        _plain(value)
        return value, True
    except (ValueError, RecursionError):
        return None, False


def _checked(schemas: dict[str, dict]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            errors, written = [], []
            for row in batch.select(["id", "name", "arguments", "result"]).to_pylist():
                value, good = _parsed(row["arguments"])
                if row["name"] not in schemas:
                    errors.append(["unknown tool"])
                elif not good:
                    errors.append(["arguments are not JSON"])
                else:
                    errors.append(violations(value, schemas[row["name"]]))
                result, json_result = _parsed(row["result"])
                written.append(canonical({
                    "arguments": value if good else row["arguments"],
                    "id": row["id"],
                    "name": row["name"],
                    "result": result if json_result else row["result"],
                }))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(errors, pa.list_(pa.string())), pa.array(written)],
                names=[*batch.schema.names, "errors", "json"],
            )

    return run


def depths(calls: DataFrame) -> DataFrame:
    """(id, depth) of calls (id, waits_for): 0 without a known call to wait for, one more than that
    call's depth otherwise, null on and behind a cycle. Ids must be unique.

    Every round doubles the distance looked ahead; it ends when no call looks at another, or when
    the distance exceeds the number of calls, which only cycles reach.
    """
    rows = calls.count()
    known = calls.select(F.col("id").alias("waits_for"))
    state = staged(
        calls.where("waits_for is not null").join(known, "waits_for").select(
            "id", F.col("waits_for").alias("at"), F.lit(1).cast("long").alias("depth")
        ).union(
            calls.select("id", F.lit(None).cast("string"), F.lit(0).cast("long")).join(
                calls.where("waits_for is not null").join(known, "waits_for").select("id"), "id", "left_anti"
            )
        ),
        "call-depths",
    )
    reach = 1
    while reach <= 2 * rows and state.where("at is not null").head(1):
        ahead = state.select(
            F.col("id").alias("at"), F.col("at").alias("next"), F.col("depth").alias("more")
        )
        open_ = state.where("at is not null").join(ahead, "at").select(
            "id", F.col("next").alias("at"), (F.col("depth") + F.col("more")).alias("depth")
        )
        state = staged(open_.union(state.where("at is null")), "call-depths")
        reach *= 2
    return state.select("id", F.when(F.col("at").isNull(), F.col("depth")).alias("depth"))


def link(
    calls: DataFrame, results: DataFrame, schemas: dict[str, dict], conversation: str | None = None,
    unlinked: bool = False,
) -> DataFrame:
    """Every call with its result.

    `calls` has id, seq, name, arguments (JSON text) and waits_for (an id or null); `results` id,
    seq and content. With `conversation`, a column of both, ids and waits_for hold within a
    conversation only, and the column comes out too. Comes out: id, seq, name, depth, n_calls,
    n_results, errors, status and json. Sorting a conversation's calls by (depth, seq) puts each one
    behind the call it waits for.

    Of calls of one id the first by (seq, name, arguments) counts, of results the first by
    (seq, content); n_calls and n_results say how many there were. A call that waits for an id
    that no call has starts at depth 0 with status `dangling`. status is the first that holds of
    cycle, dangling, invalid (errors), open (no result), linked. Other columns are not looked at.

    With `unlinked` no row of the input is missing: the other calls of an id come out with status
    `duplicate`, its other results with `repeated result`, results of an id without a call with
    `unmatched result`, and rows without an id, which nothing can refer to, with `nameless call` or
    `nameless result`. They have no depth and counts of 0; without `unlinked` they are left out.
    """
    group = F.lit(None).cast("string") if conversation is None else F.col(conversation)

    def keyed(name: str):
        if conversation is None:
            return F.col(name)
        return F.when(
            F.col(name).isNotNull(), F.to_json(F.struct(group.alias("c"), F.col(name).alias("i")))
        )

    asked = calls.select(
        keyed("id").alias("key"), "id", group.alias("group"), "seq", "name", "arguments",
        keyed("waits_for").alias("waits_for"),
    )
    given = results.select(keyed("id").alias("key"), "id", group.alias("group"), "seq", "content")
    first = asked.where("key is not null").groupBy("key").agg(
        F.min(F.struct("seq", "name", "arguments", "waits_for", "id", "group")).alias("c"),
        F.count(F.lit(1)).alias("n_calls"),
    ).select("key", "c.*", "n_calls")
    first = staged(first, "calls")
    answers = given.where("key is not null").groupBy("key").agg(
        F.min(F.struct("seq", "content")).alias("r"), F.count(F.lit(1)).alias("n_results")
    ).select("key", F.col("r.seq").alias("result_seq"), F.col("r.content").alias("result"),
             "n_results")
    deep = depths(first.select(F.col("key").alias("id"), "waits_for")).withColumnRenamed("id", "key")
    joined = first.join(deep, "key").join(answers.drop("result_seq"), "key", "left").withColumn(
        "n_results", F.coalesce("n_results", F.lit(0))
    ).withColumn(
        "dangling", F.col("waits_for").isNotNull() & (F.col("depth") == 0)
    ).select(
        "id", "group", "seq", "name", "arguments", "depth", "n_calls", "n_results", "result",
        "dangling", F.lit(None).cast("string").alias("kind"),
    )
    if unlinked:
        joined = joined.unionByName(_unlinked(asked, given, first, answers, joined))
    fields = ", ".join(f"`{n}` {t}" for n, t in joined.dtypes)
    checked = joined.mapInArrow(
        _checked(schemas), f"{fields}, errors array<string>, json string"
    )
    status = (
        F.when(F.col("kind").isNotNull(), F.col("kind"))
        .when(F.col("depth").isNull(), "cycle").when(F.col("dangling"), "dangling")
        .when(F.size("errors") > 0, "invalid").when(F.col("n_results") == 0, "open")
        .otherwise("linked")
    )
    # A result has no arguments to check.
    errors = F.when(F.col("kind").endswith("result"), F.array().cast("array<string>")).otherwise(
        F.col("errors")
    )
    kept = [] if conversation is None else [F.col("group").alias(conversation)]
    return checked.select(
        "id", *kept, "seq", "name", "depth", "n_calls", "n_results", errors.alias("errors"),
        status.alias("status"), "json",
    )


def _unlinked(
    asked: DataFrame, given: DataFrame, first: DataFrame, answers: DataFrame, like: DataFrame
) -> DataFrame:
    """The rows of calls and results that no linked call stands for, with their `kind`.

    Equal rows are counted before they are joined and come out as often as there were.
    """
    columns = ["id", "group", "seq", "name", "arguments", "waits_for"]
    calls = asked.groupBy("key", *columns).agg(F.count(F.lit(1)).alias("n"))
    chosen = first.select("key", *[F.col(c).alias(f"_{c}") for c in columns])
    same = F.lit(True)
    for name in columns:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    calls = calls.join(chosen, "key", "left").withColumn(
        "n", F.col("n") - F.when(F.col("key").isNotNull() & same, 1).otherwise(0)
    ).withColumn("kind", F.when(F.col("key").isNull(), "nameless call").otherwise("duplicate"))
    replies = given.groupBy("key", "id", "group", "seq", "content").agg(
        F.count(F.lit(1)).alias("n")
    ).join(first.select("key", F.lit(True).alias("called")), "key", "left").join(
        answers.select("key", "result_seq", "result"), "key", "left"
    )
    taken = F.col("called") & F.col("seq").eqNullSafe(F.col("result_seq")) & F.col(
        "content").eqNullSafe(F.col("result"))
    replies = replies.withColumn("n", F.col("n") - F.when(taken, 1).otherwise(0)).withColumn(
        "kind",
        F.when(F.col("key").isNull(), "nameless result")
        .when(F.col("called"), "repeated result").otherwise("unmatched result"),
    ).select("id", "group", "seq", F.col("content").alias("result"), "n", "kind")
    both = calls.select("id", "group", "seq", "name", "arguments", "n", "kind").unionByName(
        replies, allowMissingColumns=True
    ).where("n > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    filled = {"depth": None, "n_calls": 0, "n_results": 0, "dangling": False}
    return both.select(*[
        (F.lit(filled[name]) if name in filled else F.col(name)).cast(kind).alias(name)
        for name, kind in like.dtypes
    ])
