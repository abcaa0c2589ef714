"""Packing token windows so that each holds the target proportions of its sources.

Every source is a queue of documents. Deficit round-robin gives each queue, window by window, its
quantum (window size times its weight) plus the deficit it carries; whole tokens are served and
the fraction is carried on. What all queues have been given before window k is a function of k
alone, so the deficits need not be passed from task to task: a document knows its place in its
queue, and from that its windows and offsets. Places come from sums over sorted ranges.

Queues are bounded in number: sources with less than `least` tokens a window share one queue, in
which their documents stand in the order of the share of their source that goes before them. When
a queue runs dry its weight passes to the others. The last tokens fill windows of powers of two.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.bytelevel import ByteLevelIds
from shopgrain.llm.common import staged, text_steps, unique_ids
from shopgrain.operators.lookup import lookup_join

# Pieces laid out at once.
STEP = 20_000


@dataclass(frozen=True)
class Phase:
    """Windows over which the queues keep their weights.

    `given` is what each queue was given before, `whole` and `part` are its quantum: tokens, and
    parts of a token in units of 2 ** -bits.
    """

    first: int
    windows: int
    size: int
    bits: int
    given: tuple[int, ...]
    whole: tuple[int, ...]
    part: tuple[int, ...]

    def upto(self, k: np.ndarray) -> np.ndarray:
        """Tokens each queue is given in the first k windows of the phase, a row for each k.

        Every queue gets its quanta rounded down; of the tokens that are left the queues with
        the largest deficits get one each.
        """
        owed = k[:, None] * np.array(self.part, np.int64)
        served = k[:, None] * np.array(self.whole, np.int64) + (owed >> self.bits)
        deficit = owed & ((1 << self.bits) - 1)
        spare = self.size * k - served.sum(1)
        rank = np.argsort(np.argsort(-deficit, axis=1, kind="stable"), axis=1, kind="stable")
        return served + (rank < spare[:, None])


def _shares(weights: list[float], left: list[int], size: int) -> list[int]:
    """One window from queues that may run dry in it: by weight, none beyond what it has left."""
    out = [0] * len(left)
    need = min(size, sum(left))
    while need:
        open_ = [j for j in range(len(left)) if left[j] > out[j]]
        total = sum(weights[j] for j in open_)
        ask = need
        for j in sorted(open_, key=lambda j: (-weights[j], j)):
            got = min(left[j] - out[j], max(1, int(ask * weights[j] / total)), need)
            out[j] += got
            need -= got
    return out


def plan(totals: list[int], weights: list[float], size: int) -> list[Phase]:
    """The phases of all windows over queues of `totals` tokens; a few for each queue."""
    left, given, first, phases = list(totals), [0] * len(totals), 0, []

    def add(windows: int, width: int, bits: int, whole: list[int], part: list[int]) -> None:
        nonlocal first
        phase = Phase(first, windows, width, bits, tuple(given), tuple(whole), tuple(part))
        phases.append(phase)
        first += windows
        for j, n in enumerate(phase.upto(np.array([windows], np.int64))[0].tolist()):
            left[j] -= n
            given[j] += n

    while sum(left) >= size:
        open_ = [j for j in range(len(left)) if left[j]]
        bits = 62 - max((sum(left) // size).bit_length(), 11)
        total = sum(weights[j] for j in open_)
        quantum = [0] * len(left)
        for j in open_:
            quantum[j] = int(size * (weights[j] / total) * (1 << bits))
        quantum[max(open_, key=lambda j: weights[j])] += (size << bits) - sum(quantum)
        windows = min(((left[j] - 1) << bits) // quantum[j] for j in open_ if quantum[j])
        if windows:
            add(windows, size, bits, [q >> bits for q in quantum],
                [q & ((1 << bits) - 1) for q in quantum])
        else:
            add(1, size, 1, _shares(weights, left, size), [0] * len(left))
    rest = sum(left)
    for power in reversed(range(rest.bit_length())):
        if rest >> power & 1:
            add(1, 1 << power, 1, _shares(weights, left, 1 << power), [0] * len(left))
    return phases


def _windows_of(phase: Phase, queue: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The window of the phase that holds each place of a queue."""
    quantum = np.array(phase.whole) + np.array(phase.part) / float(1 << phase.bits)
    guess = (place / quantum[queue]).astype(np.int64)
    rows = np.arange(len(place))
    out = np.zeros(len(place), np.int64)
    for shift in (-1, 0, 1):
        k = np.clip(guess + shift, 0, phase.windows - 1)
        out = np.where(phase.upto(k)[rows, queue] <= place, np.maximum(out, k), out)
    return out


def pieces_of(
    phases: list[Phase], queue: np.ndarray, place: np.ndarray, length: np.ndarray
) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, start, length, sequence, offset) of the pieces that documents are cut into."""
    for n, phase in enumerate(phases):
        begin = np.array(phase.given, np.int64)[queue]
        if n + 1 < len(phases):
            end = np.array(phases[n + 1].given, np.int64)[queue]
        else:
            end = begin + phase.upto(np.array([phase.windows], np.int64))[0][queue]
        low, high = np.maximum(place, begin) - begin, np.minimum(place + length, end) - begin
        rows = np.flatnonzero(low < high)
        if not len(rows):
            continue
        low, high, mine, moved = low[rows], high[rows], queue[rows], begin[rows] - place[rows]
        if phase.windows == 1:
            k0 = k1 = np.zeros(len(rows), np.int64)
        else:
            k0, k1 = _windows_of(phase, mine, low), _windows_of(phase, mine, high - 1)
        ends = np.cumsum(k1 - k0 + 1)
        for at in range(0, int(ends[-1]), STEP):
            piece = np.arange(at, min(at + STEP, int(ends[-1])))
            doc = np.searchsorted(ends, piece, "right")
            k = piece - (ends[doc] - (k1 - k0 + 1)[doc]) + k0[doc]
            before, after = phase.upto(k), phase.upto(k + 1)
            each = np.arange(len(piece))
            here = before[each, mine[doc]]
            start = np.maximum(low[doc], here)
            stop = np.minimum(high[doc], after[each, mine[doc]])
            ahead = np.concatenate(
                [np.zeros((len(piece), 1), np.int64), np.cumsum(after - before, axis=1)], axis=1
            )[each, mine[doc]]
            some = stop > start
            yield tuple(x[some] for x in (
                rows[doc], start + moved[doc], stop - start, phase.first + k, ahead + start - here
            ))


def _sums(frame: DataFrame, group: str, order: list[str], label: str) -> DataFrame:
    """`frame` with `ahead`: the sum of `n` over the rows of its group that are in order before it.

    Rows are sorted by ranges, so a large group lies in many tasks; each range is summed up by
    itself and the sums of the ranges before it are added.
    """
    names = frame.columns
    schema = ", ".join(f"`{c}` {frame.schema[c].dataType.simpleString()}" for c in names)
    at = [names.index(group), names.index("n")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = object(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = batch.column(at[0]).dictionary_encode().indices.to_numpy(zero_copy_only=False)
            groups = np.nan_to_num(groups, nan=-1)
            values = batch.column(at[1]).to_numpy(zero_copy_only=False).astype(np.int64)
            sums = np.cumsum(values) - values
            starts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
            base = sums[starts]
            if batch.column(at[0])[0].as_py() == current:
                base[0] -= held
            ahead = sums - np.repeat(base, np.diff(np.append(starts, len(values))))
            current, held = batch.column(at[0])[-1].as_py(), int(ahead[-1] + values[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ahead)], names=[*names, "_inside"]
            )

    ranged = frame.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    inside = staged(
        ranged.mapInArrow(run, schema + ", _inside long").withColumn("_part", F.spark_partition_id()),
        label,
    )
    totals = inside.groupBy(group, "_part").agg(F.sum("n").alias("_n"))
    # A row for each range that the group lies in.
    earlier = totals.select(group, "_part", F.expr(
        f"sum(_n) over (partition by `{group}` order by _part) - _n"
    ).alias("_before")).where("_before > 0").select(
        F.col(group).alias("_g"), F.col("_part").alias("_p"), "_before"
    )
    joined = inside.join(
        earlier, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")), "left"
    )
    return joined.select(
        *names, (F.col("_inside") + F.coalesce("_before", F.lit(0))).alias("ahead")
    )


def tokenized(docs: DataFrame, file: bytes, text_col: str, keep: list[str], end_id: int) -> DataFrame:
    """`keep`, n and ids (binary, two or four bytes each) of each text and `end_id`."""
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteLevelIds(file)
        kind = np.uint16 if len(encoder.token_bytes) <= 1 << 16 else np.uint32
        for batch in batches:
            for part, data, offsets in text_steps(batch, 0):
                raw = data.tobytes()
                ids = [
                    np.append(encoder.ids(raw[a:b].decode("utf-8", "replace")), end_id).astype(kind)
                    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([x.tobytes() for x in ids], pa.binary())],
                    names=[*keep, "n", "ids"],
                )

    return docs.select(F.col(text_col).alias("_text"), *keep).mapInArrow(
        run, f"{fields}, n long, ids binary"
    )


def pack(
    docs: DataFrame, file: bytes, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source", size: int = 1024, least: int = 16, end_id: int = 0,
    weights: dict[str | None, float] | None = None, with_ids: bool = False,
) -> DataFrame:
    """(id, source, start, length, ids_crc32, doc_tokens, sequence_id, offset), a row per piece.

    Each text's ids and `end_id` are cut into pieces; sequences hold `size` ids, the last ones
    powers of two, without padding. `weights` are the target proportions of named sources, each
    at least `least` / `size` of their sum; sources not named share a queue with the weight of
    their tokens. Without weights every source has that of its tokens, so the mix of all documents
    holds in every window to a token and all queues end together. `with_ids` adds the piece's ids.

    Null and empty texts are packed as `end_id` alone. A null source is a source. Rows with null
    or repeated ids are documents of their own, in the order of id and text. An empty table gives
    no rows. `file` is the tokenizer's JSON, of fixed size. Only the sums of the sources with
    `least` tokens a window, at most `size` / `least`, reach the driver.
    """
    numbered, _ = unique_ids(
        docs.select(
            F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
            F.col(source_col).cast("string").alias("_source"),
        ), "_id", "_text", "_uid",
    )
    tokens = staged(
        tokenized(numbered, file, "_text", ["_uid", "_id", "_source"], end_id), "packing-ids"
    )
    sources = staged(
        tokens.groupBy(F.col("_source").alias("source")).agg(F.sum("n").alias("total")),
        "packing-sources",
    )
    total = sources.agg(F.sum("total")).first()[0] or 0
    # At most size / least, or as many as are named.
    if weights is None:
        own = sources.where(F.col("total") * size >= F.lit(total * least))
    else:
        if any(w <= 0 or w * size < least * sum(weights.values()) for w in weights.values()):
            raise ValueError(f"a weight is below {least} tokens of {size}")
        named = [F.col("source").eqNullSafe(F.lit(s)) for s in weights]
        own = sources.where(F.array_contains(F.array(*named), True)) if named else sources.limit(0)
    heads = sorted(((r["source"], r["total"]) for r in own.collect()),
                   key=lambda x: (-x[1], x[0] is None, x[0] or ""))
    rest = total - sum(n for _, n in heads)
    if weights is None:
        while heads and 0 < rest * size < total * least:  # too few for a queue of their own
            rest += heads.pop()[1]
        share = [float(n) for _, n in heads] + [float(rest)]
    else:
        known = sum(weights[s] for s, _ in heads) or 1.0
        covered = max(1 - rest / total, least / size) if total else 1.0
        share = [weights[s] / known * covered for s, _ in heads]
        share.append(max(1 - covered, least / size) if rest else 0.0)
    phases = plan([n for _, n in heads] + [rest], share, size)

    queue = F.lit(len(heads))
    for number, (source, _) in enumerate(heads):
        queue = F.when(F.col("_source").eqNullSafe(F.lit(source)), number).otherwise(queue)
    placed = _sums(tokens.select("_uid", "_source", "n", queue.alias("queue")), "_source", ["_uid"],
                   "packing-sums")
    first = placed.where(F.col("queue") < len(heads)).select("_uid", "queue", "ahead")
    if rest:
        # The documents of all small sources in one queue, mixed evenly.
        named = sources.select(F.struct("source").alias("_key"), "total")
        small = placed.where(F.col("queue") == len(heads)).withColumn(
            "_key", F.struct(F.col("_source").alias("source"))
        )
        small = lookup_join(small, named, ["_key"]).select(
            "_uid", "queue", "n", ((F.col("ahead") + F.col("n") / 2) / F.col("total")).alias("gone")
        )
        first = first.unionByName(
            _sums(small, "queue", ["gone", "_uid"], "packing-rest").select("_uid", "queue", "ahead")
        )

    kind = numbered.schema["_id"].dataType.simpleString()
    ids_type = ", ids array<long>" if with_ids else ""

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column(3)
            n = batch.column(2).to_numpy(zero_copy_only=False)
            queue, ahead = (batch.column(c).to_numpy(zero_copy_only=False) for c in (4, 5))
            for rows, start, length, sequence, offset in pieces_of(
                phases, queue.astype(np.int64), ahead.astype(np.int64), n.astype(np.int64)
            ):
                crc = np.empty(len(rows), np.int64)
                ids: list[list[int]] = []
                held, words = -1, memoryview(b"")
                for i, (row, a, b) in enumerate(
                    zip(rows.tolist(), start.tolist(), (start + length).tolist())
                ):
                    if row != held:
                        raw = data[row].as_py()
                        narrow = np.frombuffer(raw, f"<u{len(raw) // int(n[row])}")
                        held, words = row, memoryview(narrow.astype("<u4"))
                    crc[i] = zlib.crc32(words[a:b])
                    if with_ids:
                        ids.append(words[a:b].tolist())
                at = pa.array(rows)
                columns = [
                    batch.column(0).take(at), batch.column(1).take(at), pa.array(start),
                    pa.array(length), pa.array(crc), pa.array(n[rows]), pa.array(sequence),
                    pa.array(offset),
                ]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=[
                    "_id", "_source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                    "offset", *["ids"] * with_ids,
                ])

    out = tokens.join(first, "_uid").select("_id", "_source", "n", "ids", "queue", "ahead").mapInArrow(
        lay, f"_id {kind}, _source string, start long, length long, ids_crc32 long, "
        f"doc_tokens long, sequence_id long, offset long{ids_type}"
    )
    return out.withColumnsRenamed({"_id": id_col, "_source": source_col})
