"""Exact substring dedup with a sampled, range-partitioned suffix order.

A byte is removed if a string of `width` bytes that covers it also starts earlier. Strings are
found through sampled suffixes: of the `lead`-byte strings inside each window of `width` bytes,
the one of least hash marks a suffix. Equal windows mark equal suffixes, and a suffix owns the run
of windows that mark it, so no repeat is lost while only one position in thirty is sent.

1. Leads that occur once in the corpus are dropped by their hash.
2. The others are cut out with the bytes of the windows they own.
3. Sampled splitters range-partition these suffixes by their leading bytes; each bucket is
   sorted locally, and every window that occurs earlier in its run of equal leads is marked.
   Splitters compare leads only, so equal leads never straddle a bucket boundary; runs too long
   for one task are dealt by window instead and compared there.
4. Marked windows are joined back to their documents.

Copies are combined inside each task before every shuffle: a passage of a third of all documents
sends one row per task and suffix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.llm.common import RollingHash, byte_view, staged, table, text_steps, unique_ids

LEAD = 36
# Suffixes of one lead that a single task may sort.
RUN_ROWS = 100_000
# Suffixes a task works on at once.
STEP_ROWS = 60_000
_CHUNK = (1 << 16) - 256


def sampled_suffixes(
    data: np.ndarray, offsets: np.ndarray, width: int, lead: int, rolling: RollingHash
) -> tuple[np.ndarray, ...]:
    """(text, position, first window, last window, lead hash) of every sampled suffix.

    Ties of the hash go to the leftmost, so the choice depends on the window's bytes alone.
    """
    span = width - lead + 1
    step = 1 << (span.bit_length() - 1)
    long_enough = np.diff(offsets) >= width
    edge = np.zeros(len(data) + 2, np.int8)
    np.add.at(edge, offsets[:-1][long_enough], 1)
    np.add.at(edge, offsets[1:][long_enough] - width + 1, -1)
    found_first, found_at, found_hash = [], [], []
    before, level = -1, 0
    for at in range(0, len(data) - width + 1, _CHUNK):
        stop = min(at + _CHUNK, len(data) - width + 1)
        valid = level + np.cumsum(edge[at:stop], dtype=np.int64)
        level = int(valid[-1])
        valid = valid > 0
        hashed = rolling.windows(data[at:stop + width - 1], lead)
        least = (hashed & ~np.uint64(0xFFFF)) | np.arange(len(hashed), dtype=np.uint64)
        reach = 1
        while reach < step:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if span > step:
            least = np.minimum(least[:stop - at], least[span - step:span - step + stop - at])
        place = (least[:stop - at] & np.uint64(0xFFFF)).astype(np.int64)
        here = np.where(valid, place + at, -1)
        fresh = valid.copy()
        fresh[1:] &= here[1:] != here[:-1]
        fresh[0] &= here[0] != before
        before = int(here[-1])
        first = np.flatnonzero(fresh)
        found_first.append(first + at)
        found_at.append(here[first])
        found_hash.append(hashed[place[first]])
    if not found_first:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(np.uint64)
    first, position, hashed = map(np.concatenate, (found_first, found_at, found_hash))
    text = np.searchsorted(offsets, first, "right") - 1
    last = offsets[text + 1] - width
    last[:-1] = np.where(text[1:] == text[:-1], first[1:] - 1, last[:-1])
    return text, position, first, last, hashed


def _own_key(hashed: np.ndarray, uid: np.ndarray) -> np.ndarray:
    return RollingHash.mixed(hashed ^ RollingHash.mixed(uid.view(np.uint64)))


def _leads(width: int, lead: int):
    """(k, uid, n) for each sampled suffix: k is the lead's hash.

    A lead that a task meets twice is known to repeat: its suffixes come out under keys of their
    own, which deals them out evenly, and one row without a document tells the other tasks.
    """

    def rows(uid: list[np.ndarray], hashed: list[np.ndarray]) -> pa.RecordBatch:
        u, h = np.concatenate(uid), np.concatenate(hashed)
        order = np.argsort(h, kind="stable")
        u, h = u[order], h[order]
        head = np.ones(len(h), bool)
        head[1:] = h[1:] != h[:-1]
        counts = np.diff(np.append(np.flatnonzero(head), len(h)))
        many = np.repeat(counts > 1, counts)
        own_h, own_u = h[many], u[many]
        keys = pd.unique(_own_key(own_h, own_u)) if len(own_h) else own_h
        owners = own_u
        if len(own_h):
            pairs = pd.DataFrame({"k": _own_key(own_h, own_u), "u": own_u}).drop_duplicates("k")
            keys, owners = pairs["k"].to_numpy(), pairs["u"].to_numpy()
        told = h[head][counts > 1]
        single = ~many
        k = np.concatenate([h[single], keys, told]).view(np.int64)
        who = np.concatenate([u[single], owners, np.zeros(len(told), np.int64)])
        absent = np.zeros(len(k), bool)
        absent[len(k) - len(told):] = True
        n = np.full(len(k), 2, np.int16)
        n[:int(single.sum())] = 1
        return table({"k": k, "uid": pa.array(who, mask=absent), "n": n})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = RollingHash()
        uid, hashed, held = [], [], 0
        for batch in batches:
            for part, data, offsets in text_steps(batch, 1):
                ids = part.column(0).to_numpy(zero_copy_only=False)
                text, _, _, _, h = sampled_suffixes(data, offsets, width, lead, rolling)
                uid.append(ids[text])
                hashed.append(h)
                held += len(h)
                if held > 2_000_000:
                    yield rows(uid, hashed)
                    uid, hashed, held = [], [], 0
        if held:
            yield rows(uid, hashed)

    return run


def _gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary array of the byte ranges."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    index = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    return pa.Array.from_buffers(
        pa.binary(), len(starts),
        [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[index])],
    )


SUFFIX = "lead binary, bytes binary, uid long, first long, windows int"


def _suffixes(width: int, lead: int):
    """The repeated leads of each document with the bytes of the windows they own.

    Equal bytes within a step are combined: the earliest goes on, the others are known to
    be covered and come out without bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = RollingHash()
        for batch in batches:
            for part, data, offsets in text_steps(batch, 1):
                ids = part.column(0).to_numpy(zero_copy_only=False)
                lists = part.column(2)
                listed = np.asarray(pc.list_flatten(lists)).view(np.uint64)
                text, at, first, last, h = sampled_suffixes(data, offsets, width, lead, rolling)
                uid = ids[text]
                known = pd.Series(_own_key(h, uid)).isin(listed) | pd.Series(h).isin(listed)
                keep = np.flatnonzero(known.to_numpy())
                if not len(keep):
                    continue
                uid, at, first, last = uid[keep], at[keep], first[keep], last[keep]
                origin = first - offsets[text[keep]]
                size = last - first + width
                same = rolling.spans(data, first, first + size)
                order = np.lexsort((origin, uid, same))
                head = np.ones(len(order), bool)
                head[1:] = same[order][1:] != same[order][:-1]
                for rows, bare in ((order[head], False), (order[~head], True)):
                    for k in range(0, len(rows), 100_000):
                        r = rows[k:k + 100_000]
                        empty = pa.nulls(len(r), pa.binary())
                        yield table({
                            "lead": empty if bare else _gathered(
                                data, at[r], np.full(len(r), lead)
                            ),
                            "bytes": empty if bare else _gathered(data, first[r], size[r]),
                            "uid": uid[r],
                            "first": origin[r],
                            "windows": (last[r] - first[r] + 1).astype(np.int32),
                        })

    return run


def _window_hashes(rows: pa.RecordBatch, width: int, rolling: RollingHash):
    """(row, number within the row, hash) of all owned windows."""
    data, offsets = byte_view(rows.column("bytes"))
    count = rows.column("windows").to_numpy(zero_copy_only=False).astype(np.int64)
    base = np.zeros(len(count) + 1, np.int64)
    np.cumsum(count, out=base[1:])
    row = np.repeat(np.arange(len(count)), count)
    number = np.arange(base[-1]) - base[row]
    return row, number, rolling.windows(data, width)[offsets[row] + number]


def _resolve(width: int):
    """Rows sorted by (lead, uid, first): the byte ranges that earlier rows hold as well."""

    def ranges(rows: pa.RecordBatch, rolling: RollingHash) -> pa.RecordBatch:
        lead = rows.column("lead")
        run = np.zeros(rows.num_rows, np.uint64)
        run[1:] = np.cumsum(
            np.asarray(pc.not_equal(lead.slice(1), lead.slice(0, rows.num_rows - 1))),
            dtype=np.uint64,
        )
        row, number, hashed = _window_hashes(rows, width, rolling)
        key = hashed + run[row] * np.uint64(0x9E3779B97F4A7C15)
        seen = pd.Series(key).duplicated(keep="first").to_numpy()
        begin, end = seen.copy(), seen.copy()
        begin[1:] &= ~(seen[:-1] & (row[1:] == row[:-1]))
        end[:-1] &= ~(seen[1:] & (row[1:] == row[:-1]))
        a, b = np.flatnonzero(begin), np.flatnonzero(end)
        uid = rows.column("uid").to_numpy(zero_copy_only=False)
        first = rows.column("first").to_numpy(zero_copy_only=False)
        return table({
            "uid": uid[row[a]],
            "start": first[row[a]] + number[a],
            "stop": first[row[b]] + number[b] + width,
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = RollingHash()
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(x.num_rows for x in held) < STEP_ROWS:
                continue
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            lead = rows.column("lead")
            other = np.flatnonzero(np.asarray(pc.not_equal(lead, lead[rows.num_rows - 1])))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield ranges(rows.slice(0, cut), rolling)
            held = [rows.slice(cut)]
        if held:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            yield ranges(rows, rolling)

    return run


def _dealt_by_window(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = RollingHash()
        for batch in batches:
            row, number, hashed = _window_hashes(batch, width, rolling)
            uid = batch.column("uid").to_numpy(zero_copy_only=False)
            first = batch.column("first").to_numpy(zero_copy_only=False)
            yield table({"w": hashed.view(np.int64), "uid": uid[row], "start": first[row] + number})

    return run


def repeated_ranges(
    docs: DataFrame, width: int = 100, lead: int = LEAD, run_rows: int = RUN_ROWS
) -> DataFrame:
    """(uid, ranges): the byte ranges of each text (uid long unique, text) that strings of
    `width` bytes starting earlier cover; ranges may overlap, documents without any are left out.
    """
    texts = docs.select("uid", "text")
    leads = texts.mapInArrow(_leads(width, lead), "k long, uid long, n short")
    repeated = leads.withColumn("n", F.sum("n").over(Window.partitionBy("k"))).where(
        "n > 1 and uid is not null"
    ).select("uid", "k")
    repeated = staged(repeated, "substring-leads")
    lists = repeated.groupBy("uid").agg(F.collect_list("k").alias("ks"))
    suffixes = staged(
        texts.join(lists, "uid").select("uid", "text", "ks").mapInArrow(
            _suffixes(width, lead), SUFFIX
        ),
        "substring-suffixes",
    )
    covered = suffixes.where("lead is null").select(
        "uid", F.col("first").alias("start"), (F.col("first") + F.col("windows") - 1 + width).alias("stop")
    )
    whole = suffixes.where("lead is not null")
    long_runs = whole.groupBy(F.xxhash64("lead").alias("_l")).count().where(
        F.col("count") > run_rows
    ).select("_l")
    long_runs = staged(long_runs, "substring-long-runs")
    parts = [covered]
    if long_runs.head(1):
        keyed = whole.withColumn("_l", F.xxhash64("lead"))
        dealt = staged(
            keyed.join(long_runs, "_l", "left_semi").select(*whole.columns).mapInArrow(
                _dealt_by_window(width), "w long, uid long, start long"
            ),
            "substring-windows",
        )
        earliest = dealt.groupBy("w").agg(F.min(F.struct("uid", "start")).alias("least"))
        parts.append(dealt.join(earliest, "w").where(
            F.struct("uid", "start") != F.col("least")
        ).select("uid", "start", (F.col("start") + width).alias("stop")))
        whole = keyed.join(long_runs, "_l", "left_anti").select(*whole.columns)
    parts.append(
        whole.repartitionByRange("lead").sortWithinPartitions("lead", "uid", "first").mapInArrow(
            _resolve(width), "uid long, start long, stop long"
        )
    )
    ranges = parts[0]
    for part in parts[1:]:
        ranges = ranges.union(part)
    ranges = staged(ranges, "substring-ranges")
    return ranges.groupBy("uid").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))


def _merged(ranges: list[dict] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted((r["start"], r["stop"]) for r in ranges or ()):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def _whole_characters(text: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ranges without the characters that they cut apart."""
    out = []
    for start, stop in ranges:
        while start < stop and text[start] & 0xC0 == 0x80:
            start += 1
        while stop > start and stop < len(text) and text[stop] & 0xC0 == 0x80:
            stop -= 1
        if start < stop:
            out.append((start, stop))
    return out


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 100,
    keep: tuple[str, ...] = (), whole_characters: bool = False, lead: int = LEAD,
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """(id, `keep` columns, n_bytes, spans, kept): each text without the bytes that repeat.

    spans are the removed byte ranges, merged; kept the other bytes, one after the other. With
    `whole_characters`, a character is removed whole or not at all, so that kept is valid UTF-8.
    Earlier means a smaller id, or the same document and an earlier start. A null text
    is empty. Null ids count as largest; rows of equal id are ordered by text, so that a row that
    repeats another loses what the first one keeps. Other columns may have any name.
    """
    base = docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("text"),
        *[F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)],
    )
    base, _ = unique_ids(base, "_id", "text")
    ranges = repeated_ranges(base, width, lead, run_rows)
    others = ["_id", *[f"_keep_{i}" for i in range(len(keep))]]
    fields = ", ".join(f"{c} {base.schema[c].dataType.simpleString()}" for c in others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_steps(batch, 0):
                sizes, spans, kept = [], [], []
                for i, found in enumerate(part.column(1)):
                    text = data[offsets[i]:offsets[i + 1]]
                    sizes.append(len(text))
                    merged = _merged(found.as_py())
                    raw = text.tobytes()
                    if whole_characters:
                        merged = _whole_characters(raw, merged)
                    spans.append([{"start": a, "stop": b} for a, b in merged])
                    ends = [0, *[b for _, b in merged]]
                    starts = [*[a for a, _ in merged], len(raw)]
                    kept.append(b"".join(raw[a:b] for a, b in zip(ends, starts)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[2:], pa.array(sizes, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()),
                                                         ("stop", pa.int64())]))),
                     pa.array(kept, pa.binary())],
                    names=[*others, "n_bytes", "spans", "kept"],
                )

    joined = base.join(ranges, "uid", "left").select("text", "ranges", *others)
    out = joined.mapInArrow(
        run, f"{fields}, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary"
    )
    return out.select(
        F.col("_id").alias(id_col), *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)],
        "n_bytes", "spans", "kept",
    )
