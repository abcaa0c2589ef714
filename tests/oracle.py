"""Run registered queries against their DuckDB oracles.

`python tests/oracle.py FOLDER [NAME ...]` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time
from datetime import date, datetime
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, Decimal):
        return f"decimal {value}"
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return "null" if value is None else f"{type(value).__name__} {value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(frame, connection, text) -> str:
    """Empty when both give the same columns, types and rows."""
    cursor = connection.execute(text)
    columns = [item[0] for item in cursor.description]
    types = {item[0]: str(item[1]) for item in cursor.description}
    expected = rows_of(columns, cursor.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}"
    same = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
            "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}
    off = [
        f"{name} {kind} against {types[name]}"
        for name, kind in frame.dtypes
        if same.get(types[name]) != kind
    ]
    actual = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows against {len(expected)}; {off}"
    wrong = [(a, b) for a, b in zip(actual, expected) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(actual)} rows differ, first {wrong[0]}; {off}"
    return f"types: {off}" if off else ""


def main(folder: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from shopgrain.runtime import get_session

    spark = get_session(
        master="local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        # -1 sends every join through the shuffle path a large table would take.
        spark__sql__autoBroadcastJoinThreshold=os.environ.get("BROADCAST_BYTES", "10485760"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, failed = connect(folder), oracle_sql(), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            frame = run(spark, folder)
            if name in oracles:
                verdict = compare(frame, connection, oracles[name])
            else:
                verdict = f"no oracle, {frame.count()} rows"
        except Exception as error:
            verdict = f"{type(error).__name__} {str(error)[:600]}"
        failed += bool(verdict)
        print(f"{name:34s} {time.time() - started:6.2f}s  {verdict or 'ok'}", flush=True)
    print(f"{failed} differ; without oracle: {sorted(set(queries()) - set(oracles))}; "
          f"without query: {sorted(set(oracles) - set(queries()))}")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
