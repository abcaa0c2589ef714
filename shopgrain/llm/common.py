"""Helpers the operators share: staged tables, byte views of Arrow text, words, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from shopgrain.runtime import work_folder

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Words are maximal runs of bytes other than these.
SPACES = b" \t\n\x0b\x0c\r"
# Rows handed to Spark at once by a Python task.
OUT_ROWS = 20_000


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def staged(frame: DataFrame, label: str) -> DataFrame:
    """Write `frame` to the folder the cluster shares and go on from the files.

    Lineage ends here: an executor lost later costs no recomputation of earlier steps, and the
    shuffle files of the steps before are removed as soon as the table is written.
    """
    spark = frame.sparkSession
    path = work_folder(spark, label)
    with _setting(spark, CLEANUP, "true"):
        frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def unique_ids(
    docs: DataFrame, id_col: str, text_col: str, uid: str = "uid"
) -> tuple[DataFrame, bool]:
    """`docs` with a unique, non-null long `uid` in the order of (id, text), null ids last; and
    whether it is other than the id.

    Only where ids repeat, are null or are no integers are the rows sorted once by range and
    numbered; rows equal in id and text are then numbered in any order.
    """
    if isinstance(docs.schema[id_col].dataType, IntegralType):
        found = docs.agg(
            F.count(F.lit(1)).alias("n"), F.countDistinct(F.col(id_col)).alias("ids")
        ).first()
        if found["n"] == found["ids"]:
            return docs.withColumn(uid, F.col(id_col).cast("long")), False
    order = [F.col(id_col).asc_nulls_last(), F.col(text_col).asc_nulls_last()]
    ranged = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(ranged.withColumn(uid, F.monotonically_increasing_id()), "numbered"), True


# Arrow text as bytes


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string or binary column and the n + 1 offsets; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(
        column.type
    ) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=wide)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets.astype(np.int64) - int(offsets[0])


def text_steps(
    batch: pa.RecordBatch, column: int, step: int = 8 << 20
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with about `step` bytes of text each, their bytes and offsets; a longer
    text is a slice of its own."""
    data, offsets = byte_view(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + step, "right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        part = offsets[start:stop + 1]
        yield batch.slice(start, stop - start), data[part[0]:part[-1]], part - part[0]
        start = stop


def held_out(id_column: Column) -> Column:
    """Whether a document's label is kept from training: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(id_column.cast("string").cast("binary")) % 4 == 2


# Bytes of text that a sample may bring to the driver.
SAMPLE_BYTES = 256 << 20


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, most_chars: int = 1 << 20,
    most_bytes: int = SAMPLE_BYTES,
) -> list[tuple[str, int]]:
    """(text, label) of at most `rows` documents that are not held out, by the order of a hash.

    Texts of more than `most_chars` are passed over here, as are rows without a label, an id or a
    text. The sample ends before the text that would take it over `most_bytes`, so the driver gets
    no more than that.
    """
    chosen = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).where(
        ~held_out(F.col("doc_id"))
    ).select("doc_id", F.col(label).cast("int").alias("_y")).orderBy(
        F.xxhash64("doc_id"), "doc_id", "_y"
    ).limit(rows)
    found = staged(
        docs.select("doc_id", "text").where(
            F.col("text").isNotNull() & (F.length("text") <= most_chars)
        ).join(F.broadcast(chosen), "doc_id").select(
            "doc_id", "text", "_y", F.octet_length("text").cast("long").alias("_bytes"),
            F.xxhash64("doc_id").alias("_hash"), F.xxhash64("text").alias("_text"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "labelled",
    )
    # Sizes alone, of as many rows as the sample has (more where ids repeat).
    order = ["_hash", "doc_id", "_text", "_row"]
    first = found.select("_row", "_bytes", *order[:3]).orderBy(*order).limit(rows)
    sums = F.sum("_bytes").over(Window.orderBy(*order))
    kept = first.select("_row", sums.alias("_sum")).where(F.col("_sum") <= most_bytes)
    got = found.join(F.broadcast(kept.select("_row")), "_row").orderBy(*order).collect()
    return [(r["text"], r["_y"]) for r in got]


def word_spans(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, and the first word of each text (n + 1).

    `separator` marks the byte values that end a word; a text's end ends one as well.
    """
    inside = ~separator[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    starts[edges] |= inside[edges]
    ends[edges - 1] |= inside[edges - 1]
    at = np.flatnonzero(starts)
    return at, np.flatnonzero(ends) + 1, np.searchsorted(at, offsets)


def byte_set(values: bytes) -> np.ndarray:
    marks = np.zeros(256, bool)
    marks[list(values)] = True
    return marks


class RollingHash:
    """64-bit polynomial hashes of byte spans from prefix sums, modulo 2**64.

    The base is odd, hence invertible: a span's hash does not depend on where it starts.
    """

    CHUNK = 1 << 16

    def __init__(self, seed: int = 42):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(1 << 40, 1 << 62)) | 5
        back = pow(base, -1, 1 << 64)
        self.powers = self._powers(base)
        self.back = self._powers(back)

    def _powers(self, base: int) -> np.ndarray:
        out = np.ones(2 * self.CHUNK, np.uint64)
        out[1:] = np.uint64(base)
        return np.cumprod(out, dtype=np.uint64)

    @staticmethod
    def mixed(x: np.ndarray) -> np.ndarray:
        x = x ^ (x >> np.uint64(32))
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x9FB21C651E98DF25)
        x ^= x >> np.uint64(32)
        return x

    def windows(self, data: np.ndarray, width: int) -> np.ndarray:
        """The hash of every `width` bytes of `data`; width up to the chunk size."""
        n = len(data) - width + 1
        out = np.empty(max(n, 0), np.uint64)
        for at in range(0, n, self.CHUNK):
            stop = min(at + self.CHUNK, n)
            part = self.table[data[at:stop + width - 1]]
            part *= self.powers[:len(part)]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part, out=sums[1:])
            got = sums[width:] - sums[:-width]
            got *= self.back[:len(got)]
            out[at:stop] = self.mixed(got)
        return out

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of each span; spans must be in order and shorter than a chunk, or are cut
        into the same pieces wherever they stand."""
        out = np.empty(len(starts), np.uint64)
        first = 0
        while first < len(starts):
            base = int(starts[first])
            last = int(np.searchsorted(starts, base + self.CHUNK, "left"))
            fits = ends[first:last] <= base + 2 * self.CHUNK - 1
            last = last if fits.all() else first + max(int(np.argmin(fits)), 1)
            if ends[first] - base >= 2 * self.CHUNK:
                got = np.uint64(0)
                for at in range(base, int(ends[first]), self.CHUNK):
                    piece = data[at:min(at + self.CHUNK, int(ends[first]))]
                    with np.errstate(over="ignore"):
                        got = got * np.uint64(31) + np.sum(
                            self.table[piece] * self.powers[:len(piece)], dtype=np.uint64
                        )
                out[first] = self.mixed(np.array([got], np.uint64))[0]
                first += 1
                continue
            part = self.table[data[base:int(ends[last - 1])]]
            part *= self.powers[:len(part)]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part, out=sums[1:])
            a, b = starts[first:last] - base, ends[first:last] - base
            out[first:last] = self.mixed((sums[b] - sums[a]) * self.back[a])
            first = last
        return out


# Connected components


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node of its component) of the given edges, roots left out."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    at = at.reshape(-1)
    a, b = at[:len(a)], at[len(a):]
    parent = np.arange(len(nodes))
    while len(a):
        low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
        open_ = low != high
        a, b = a[open_], b[open_]
        np.minimum.at(parent, high[open_], low[open_])
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
    moved = parent != np.arange(len(nodes))
    return nodes[moved], nodes[parent[moved]]


def _forest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    held = 0
    for batch in batches:
        a = np.concatenate([a, batch.column(0).to_numpy(zero_copy_only=False)])
        b = np.concatenate([b, batch.column(1).to_numpy(zero_copy_only=False)])
        held += batch.num_rows
        if held >= 1 << 20:  # bounded memory: edges that do not shrink any more go out
            a, b = local_forest(a, b)
            held = 0
            if len(a) >= 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = local_forest(a, b)
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def contracted(edges: DataFrame) -> DataFrame:
    """Fewer edges with the same components: each task replaces its own by stars."""
    return edges.select("a", "b").mapInArrow(_forest_batches, "a long, b long")


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root): each node of `edges` (a long, b long) with the smallest node it reaches.

    Alternating large-star and small-star steps, each written to the shared folder. A hub's
    edges are combined on the map side and split by AQE in the joins.
    """
    current = staged(contracted(edges.where("a <> b")), label)
    state = None
    while True:
        counted = current.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h")
        ).first()
        if state == tuple(counted):
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                current.select(F.col("b"), F.col("b"))
            ).distinct()
        state = tuple(counted)
        both = current.select("a", "b").union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), "m")
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("m").alias("low"))
        small = large.join(low, "a").where("m <> low").select(F.col("m").alias("a"), "low")
        small = small.union(low).toDF("a", "b").distinct()
        current = staged(contracted(small), label)


def table(rows: dict[str, object]) -> pa.RecordBatch:
    """A record batch from named arrays."""
    arrays = [x if isinstance(x, pa.Array) else pa.array(x) for x in rows.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(rows))
