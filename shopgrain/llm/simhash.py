"""SimHash near-duplicates by the generalised pigeonhole principle.

The 64 bits are ordered so that correlated ones stand together and cut into partitions; every
partition gets its own threshold, by dynamic programming on candidate counts estimated from
the fingerprints. Two fingerprints within the distance agree up to its threshold in at least one
partition; each is looked up there, and what meets is verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import components, local_forest, staged, table

BITS = 64
OCTET = 8
SEED = 42
# Above this many fingerprints a bucket is not compared pair by pair, see `_through_neighbours`.
PAIRWISE = 2048
# Estimated cost of comparing two fingerprints, in rows sent.
COMPARE_COST = 0.02


def simhash(text: str | None, shingle: int) -> int:
    """Bit i is 1 where over half of the XXH64 hashes of all shingles have it; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    n = max(len(words) - shingle + 1, 1)
    hashed = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 4096):
        part = hashed[at:at + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text_col: str, keep: list[str], shingle: int = 3) -> DataFrame:
    """The columns `keep` and `fp`, the fingerprint as a signed long."""
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (simhash(x.as_py(), shingle) for x in batch.column(0)), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(found.view(np.int64))], names=[*keep, "fp"]
            )

    return docs.select(F.col(text_col).alias("_text"), *keep).mapInArrow(run, f"{fields}, fp long")


class Partition(NamedTuple):
    bits: tuple[int, ...]
    threshold: int  # -1: not looked up


def _bit_matrix(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(
        np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
    )


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often bit i and bit j are both set."""
    total = np.zeros((BITS, BITS), np.int64)
    for batch in batches:
        bits = _bit_matrix(batch.column(0).to_numpy(zero_copy_only=False)).astype(np.float64)
        total += (bits.T @ bits).astype(np.int64)
    i, j = np.triu_indices(BITS)
    yield table({"i": i.astype(np.int32), "j": j.astype(np.int32), "n": total[i, j]})


def bit_order(pairs: np.ndarray, rows: int) -> list[int]:
    """All bits, correlated ones next to each other: start with the most correlated pair, then
    always the bit most correlated with the octet being filled."""
    p = pairs / max(rows, 1)
    mean = np.diag(p)
    scale = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    close = np.abs(p - np.outer(mean, mean)) / np.outer(scale, scale)
    np.fill_diagonal(close, -1)
    left, order = set(range(BITS)), []
    while left:
        octet = order[len(order) // OCTET * OCTET:]
        if octet:
            best = max(sorted(left), key=lambda b: close[b, octet].sum())
        else:
            best = max(sorted(left), key=lambda b: max((close[b, o] for o in left), default=0))
        order.append(best)
        left.remove(best)
    return order


def packed(values: np.ndarray, bits: tuple[int, ...] | list[int]) -> np.ndarray:
    """The chosen bits of each value, moved together."""
    out = np.zeros(len(values), np.uint64)
    for place, bit in enumerate(bits):
        out |= ((values >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
    return out


def _octet_counts(order: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS // OCTET, 256), np.int64)
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k in range(BITS // OCTET):
                got = packed(values, order[k * OCTET:(k + 1) * OCTET]).astype(np.int64)
                total[k] += np.bincount(got, minlength=256)
        k, v = np.nonzero(total)
        yield table({"i": k.astype(np.int32), "j": v.astype(np.int32), "n": total[k, v]})

    return run


def _distances(counts: np.ndarray) -> np.ndarray:
    """Chance of each Hamming distance between two fingerprints within one octet."""
    p = counts / max(counts.sum(), 1)
    apart = np.bitwise_count(np.arange(256)[:, None] ^ np.arange(256)[None, :])
    return np.bincount(apart.ravel(), weights=np.outer(p, p).ravel(), minlength=OCTET + 1)


def allocate(order: list[int], octets: np.ndarray, rows: int, distance: int) -> list[Partition]:
    """Partitions and thresholds of least estimated cost.

    m partitions with thresholds that add up to distance - m + 1 miss no pair. For each m, the
    thresholds come from dynamic programming over the partitions; a candidate count is
    rows**2 / 2 times the chance of that distance, octets taken as independent.
    """
    spread = [_distances(octets[k]) for k in range(BITS // OCTET)]
    best: tuple[float, list[Partition]] | None = None
    for m in range(1, min(distance + 2, BITS // OCTET) + 1):
        cuts = [round(k * len(spread) / m) for k in range(m + 1)]
        parts = [tuple(order[a * OCTET:b * OCTET]) for a, b in zip(cuts, cuts[1:])]
        costs = []
        for (a, b), bits in zip(zip(cuts, cuts[1:]), parts):
            chance = np.array([1.0])
            for k in range(a, b):
                chance = np.convolve(chance, spread[k])
            near = np.cumsum(chance)
            costs.append([0.0] + [
                rows * sum(comb(len(bits), d) for d in range(t + 1))
                + COMPARE_COST * rows * rows / 2 * near[min(t, len(near) - 1)]
                for t in range(distance + 1)
            ])
        # reach[s]: least cost with thresholds so far adding up to s, and the thresholds.
        reach: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for cost in costs:
            step: dict[int, tuple[float, tuple[int, ...]]] = {}
            for total, (paid, chosen) in reach.items():
                for t in range(-1, distance + 1):
                    now = (paid + cost[t + 1], (*chosen, t))
                    if total + t not in step or now < step[total + t]:
                        step[total + t] = now
            reach = step
        if (found := reach.get(distance - m + 1)) and (best is None or found[0] < best[0]):
            best = (found[0], [Partition(b, t) for b, t in zip(parts, found[1])])
    return best[1]


def _lookups(parts: list[Partition]):
    """A row for each partition and value within its threshold; `own` marks the value itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for number, (bits, threshold) in enumerate(parts):
                if threshold < 0:
                    continue
                key = packed(fp.view(np.uint64), bits)
                for flips in range(threshold + 1):
                    for chosen in combinations(range(len(bits)), flips):
                        mask = np.uint64(sum(1 << c for c in chosen))
                        yield table({
                            "part": np.full(len(fp), number, np.int32),
                            "key": (key ^ mask).view(np.int64),
                            "fp": fp,
                            "own": np.full(len(fp), flips == 0),
                        })

    return run


def _verify(distance: int):
    """Rows sorted by bucket: compares each bucket's fingerprints, star edges come out."""

    def edges(part, key, fp, own):
        change = np.ones(len(fp), bool)
        change[1:] = (part[1:] != part[:-1]) | (key[1:] != key[:-1])
        group = np.cumsum(change)
        alive, found, step = np.arange(len(fp)), [], 0
        while True:
            step += 1
            alive = alive[alive + step < len(fp)]
            alive = alive[group[alive] == group[alive + step]]
            if not len(alive):
                break
            other = alive + step
            apart = np.bitwise_count((fp[alive] ^ fp[other]).view(np.uint64))
            near = (apart <= distance) & (own[alive] | own[other])
            if near.any():
                found.append((fp[alive[near]], fp[other[near]]))
                if sum(len(x) for x, _ in found) > 1 << 20:
                    found = [local_forest(*map(np.concatenate, zip(*found)))]
        if not found:
            return None
        a, b = local_forest(*map(np.concatenate, zip(*found)))
        return table({"a": a, "b": b})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            last = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
            cut = len(last) - int(last.sum())
            if cut and (out := edges(*[x[:cut] for x in now])) is not None:
                yield out
            held = [x[cut:] for x in now]
        if held is not None and (out := edges(*held)) is not None:
            yield out

    return run


def _flips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    masks = np.concatenate([[0], np.uint64(1) << np.arange(BITS, dtype=np.uint64)]).astype(
        np.uint64
    )
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(fp), 1000):
            part = fp[at:at + 1000]
            near = (part.view(np.uint64)[:, None] ^ masks[None, :]).view(np.int64).ravel()
            yield table({"key": near, "fp": np.repeat(part, len(masks))})


def _through_neighbours(hot: DataFrame) -> DataFrame:
    """Edges that connect all pairs at 2 bits or less among the given fingerprints.

    Two values are at most 2 bits apart where some value is at most one bit from both. A value
    has 64 others one bit away, so no group here holds more than 65.
    """
    groups = hot.mapInArrow(_flips, "key long, fp long").groupBy("key").agg(
        F.collect_set("fp").alias("near")
    )
    return groups.where(F.size("near") > 1).select(
        F.explode("near").alias("a"), F.array_min("near").alias("b")
    ).where("a <> b")


def _one_bit(hot: DataFrame) -> DataFrame:
    """Edges between the given distinct fingerprints that are one bit apart."""
    near = hot.mapInArrow(_flips, "key long, fp long").where("key <> fp")
    return near.join(hot.select(F.col("fp").alias("key")), "key").select(
        F.col("fp").alias("a"), F.col("key").alias("b")
    )


def linked(values: DataFrame, distance: int = 2, pairwise: int = PAIRWISE) -> DataFrame:
    """(node, root) for all distinct fingerprints `fp` that link with another.

    Buckets of more than `pairwise` fingerprints are not compared pair by pair: at a distance of 2
    they are connected through values one bit away, at 1 each is joined with the values one bit
    away, both exact; for larger distances they are compared like the others.
    """
    rows = values.count()
    if rows < 2:
        return values.select(F.col("fp").alias("node"), F.col("fp").alias("root")).limit(0)
    pairs = np.zeros((BITS, BITS), np.int64)
    for i, j, n in values.mapInArrow(_together, "i int, j int, n long").groupBy("i", "j").agg(
        F.sum("n")
    ).collect():
        pairs[i, j] = pairs[j, i] = n
    order = bit_order(pairs, rows)
    octets = np.zeros((BITS // OCTET, 256), np.int64)
    for i, j, n in values.mapInArrow(
        _octet_counts(order), "i int, j int, n long"
    ).groupBy("i", "j").agg(F.sum("n")).collect():
        octets[i, j] = n
    parts = allocate(order, octets, rows, distance)
    lookups = values.mapInArrow(_lookups(parts), "part int, key long, fp long, own boolean")
    bucket = ["part", "key"]
    extra = None
    if distance in (1, 2):
        lookups = staged(lookups, "simhash-lookups")
        full = staged(
            lookups.groupBy(*bucket).count().where(F.col("count") > pairwise).select(*bucket),
            "simhash-full",
        )
        if full.head(1):
            hot = lookups.join(full, bucket, "left_semi").select("fp").distinct()
            extra = _through_neighbours(hot) if distance == 2 else _one_bit(hot)
            lookups = lookups.join(full, bucket, "left_anti")
    found = lookups.repartition(*bucket).sortWithinPartitions(*bucket).mapInArrow(
        _verify(distance), "a long, b long"
    )
    return components(found if extra is None else found.union(extra), "simhash-edges")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
    distance: int = 2,
) -> DataFrame:
    """(id, fp, component_id): component_id is the smallest id whose fingerprint is reachable.

    Null and empty texts have fingerprint 0 and link like any other. Rows with a null id take
    part; their component is the smallest id of the others, null if there is none. Rows that
    repeat an id are rows of their own. Other columns are not looked at.
    """
    base = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_body"))
    marked = staged(fingerprints(base, "_body", ["_id"], shingle), "simhash-fp")
    values = staged(marked.groupBy("fp").agg(F.min("_id").alias("first")), "simhash-values")
    roots = staged(linked(values.select("fp"), distance), "simhash-roots")
    named = values.join(roots, values["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    final = named.join(least, "root").select("fp", "component_id")
    return marked.join(final, "fp").select(F.col("_id").alias(id_col), "fp", "component_id")
