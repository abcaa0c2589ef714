"""Small Hadoop file-system helpers, so that paths work on any store Spark can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path, store = _path(spark, path)
    return store.exists(jvm_path)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any path fits a glob pattern."""
    jvm_path, store = _path(spark, pattern)
    return bool(store.globStatus(jvm_path))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty when it does not exist."""
    jvm_path, store = _path(spark, path)
    if not store.exists(jvm_path):
        return []
    return sorted(status.getPath().getName() for status in store.listStatus(jvm_path))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small new file that appears whole or not at all: written aside, then renamed."""
    aside, store = _path(spark, f"{path}.{uuid.uuid4().hex[:8]}.tmp")
    stream = store.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not store.rename(aside, spark._jvm.org.apache.hadoop.fs.Path(path)):
        store.delete(aside, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    jvm_path, store = _path(spark, path)
    stream = store.open(jvm_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    jvm_path, store = _path(spark, path)
    store.delete(jvm_path, True)


def join(*parts: str) -> str:
    return "/".join(part.strip("/") if i else part.rstrip("/") for i, part in enumerate(parts))
