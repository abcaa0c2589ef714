"""Near-duplicate vectors by NN-descent.

A neighbour graph starts from a few random-projection orders and is refined: the neighbours of
a node, forward and reverse, are compared with each other, and every node keeps the best. Only
pairs with a new entry are compared. A list whose entries all reach the threshold is saturated
and may hold more; beyond `cap_limit` entries the node lies in a dense group. Links among the points
of all dense groups are then counted exactly in blocks, which also joins groups. Recall is audited against brute force, and more orders are added while
it is too low; if that does not help, all points are compared in blocks. Equal vectors are one point with a number of copies.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import components, local_forest, staged, table

# Bytes per component in the graph phase lose about 0.002 of a cosine; links are checked in doubles.
SLACK = 0.02
BLOCK = 128
CELL = 512
PART_BYTES = 8 << 20  # vectors of a part; two parts are compared in one go
PART_BLOCK = 64  # parts whose centres are compared in one go
MARGIN = 1e-6  # for rounding, in angles
MOST_STARTS = 128  # for low thresholds, where orders help little; the audit decides
AUDIT_BYTES = 32 << 20  # vectors of audited points on the driver


logger = logging.getLogger(__name__)


class Settings(NamedTuple):
    k: int = 16  # length of a neighbour list
    cap_limit: int = 64  # length up to which a saturated list is enlarged
    orders: int = 8  # random-projection orders to start from, at least; and to add at once
    rounds: int = 6  # refinements at most
    near: float = 0.1  # refine until no entry this close to the threshold, or closer, is new
    audit: int = 256  # points compared with all others, at first
    recall: float = 0.99  # wanted in the audit
    repeats: int = 3  # further orders at most; then all points are compared
    audit_links: int = 500  # links to be seen in the audit, by taking more points
    audit_most: int = 8192  # points compared with all others, at most


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    rows = len(column)
    data = np.frombuffer(b"".join(column.to_pylist()), dtype)
    return data.reshape(rows, -1) if rows else data.reshape(0, 0)


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """raw: the components as doubles, q: the direction as bytes."""
    for batch in batches:
        vectors = batch.column(0)
        raw = np.asarray(vectors.flatten()).astype(np.float64).reshape(batch.num_rows, -1)
        unit = raw / np.linalg.norm(raw / np.abs(raw).max(1, keepdims=True), axis=1,
                                    keepdims=True) / np.abs(raw).max(1, keepdims=True)
        scaled = np.round(unit * (127 / np.abs(unit).max(1, keepdims=True))).astype(np.int8)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], pa.array([x.tobytes() for x in unit], pa.binary()),
             pa.array([x.tobytes() for x in scaled], pa.binary())],
            names=["node", "first_id", "copies", "raw", "q"],
        )


def _directions(q: np.ndarray) -> np.ndarray:
    x = q.astype(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _depth(rows: int) -> int:
    return min(max(math.ceil(math.log2(max(rows, 2) / BLOCK)) + 1, 1), 40)


def starts(rows: int, threshold: float, settings: Settings) -> int:
    """Orders to start from: codes get longer with the number of rows, so more are needed to put two
    points at the threshold under one code, in one of them at least, as often as recall asks."""
    together = (1 - math.acos(max(min(threshold, 1.0), -1.0)) / math.pi) ** _depth(rows)
    if together >= 1:
        return settings.orders
    missed = max(1 - settings.recall, 0.001)
    enough = math.ceil(math.log(missed) / math.log1p(-together)) if together > 0 else MOST_STARTS
    return max(min(enough, MOST_STARTS), settings.orders)


def _orders(settings: Settings, dim: int, rows: int, seed: tuple[int, int]):
    depth = _depth(rows)
    planes = np.random.default_rng(seed).standard_normal((settings.orders, depth + 1, dim))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _directions(_matrix(batch.column(1), np.int8))
            for number, plane in enumerate(planes):
                at = x @ plane.T.astype(np.float32)
                code = (at[:, :-1] > 0) @ (1 << np.arange(depth, dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code + (number << 48)), pa.array(at[:, -1].astype(np.float64)),
                     batch.column(0), batch.column(1)],
                    names=["code", "at", "node", "q"],
                )

    return run


ENTRIES = "node long, nbrs array<long>, sims array<float>"


class _Out:
    """Collects neighbour entries and turns them into rows of lists."""

    def __init__(self):
        self.node, self.size, self.nbrs, self.sims, self.held = [], [], [], [], 0

    def add(self, ids: np.ndarray, sims: np.ndarray, keep: np.ndarray, most: int) -> None:
        counts = keep.sum(1)
        if counts.max(initial=0) > most:
            masked = np.where(keep, sims, -2)
            floor = -np.partition(-masked, most - 1, axis=1)[:, most - 1]
            keep &= sims >= floor[:, None]
            counts = keep.sum(1)
        rows = np.flatnonzero(counts)
        if not len(rows):
            return
        a, b = np.nonzero(keep)
        self.node.append(ids[rows])
        self.size.append(counts[rows])
        self.nbrs.append(ids[b])
        self.sims.append(sims[a, b])
        self.held += len(b)

    def batch(self) -> pa.RecordBatch:
        sizes = np.concatenate(self.size)
        offsets = np.zeros(len(sizes) + 1, np.int32)
        np.cumsum(sizes, out=offsets[1:])
        out = table({
            "node": np.concatenate(self.node),
            "nbrs": pa.ListArray.from_arrays(offsets, np.concatenate(self.nbrs)),
            "sims": pa.ListArray.from_arrays(
                offsets, np.concatenate(self.sims).astype(np.float32)
            ),
        })
        self.__init__()
        return out


def _first_lists(k: int):
    """Rows in a projection order: the best k of each block of consecutive rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out()
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            x = _directions(_matrix(batch.column(1), np.int8))
            for at in range(0, len(ids), BLOCK):
                part, who = x[at:at + BLOCK], ids[at:at + BLOCK]
                out.add(who, part @ part.T, who[:, None] != who[None, :], k)
                if out.held > 200_000:
                    yield out.batch()
        if out.held:
            yield out.batch()

    return run


def _local_joins(most: int):
    """Rows by centre and task: compares the members of each; improvements come out.

    A task holds all members of a centre, or those of two blocks of a hub, one or two by `second`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = _Out(), None
        for batch in _with_end(batches):
            if batch is not None:
                now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
                now.append(_directions(_matrix(batch.column(6), np.int8)))
                if held is not None:
                    now = [np.concatenate(x) for x in zip(held, now)]
                last = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
                cut = len(last) - int(last.sum())
            elif held is None:
                break
            else:
                now, cut = held, len(held[0])
            centre, task, second, member, fresh, worst, x = now
            bounds = [0]
            if cut:
                bounds = np.flatnonzero(np.r_[
                    True, (centre[1:cut] != centre[:cut - 1]) | (task[1:cut] != task[:cut - 1]), True
                ])
            for a, stop in zip(bounds[:-1], bounds[1:]):
                who, new, part = member[a:stop], fresh[a:stop], x[a:stop]
                if stop - a < 2 or not new.any():
                    continue
                sims = part @ part.T
                keep = (new[:, None] | new[None, :]) & (who[:, None] != who[None, :])
                if second[a:stop].any():  # within a block is a task of its own
                    keep &= second[a:stop, None] != second[None, a:stop]
                keep &= sims > worst[a:stop, None]
                out.add(who, sims, keep, most)
                if out.held > 200_000:
                    yield out.batch()
            held = [v[cut:] for v in now] if batch is not None else None
        if out.held:
            yield out.batch()

    return run


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    for batch in batches:
        if batch.num_rows:
            yield batch
    yield None


GRAPH = f"{ENTRIES}, fresh array<boolean>, cap int, worst float"


def _merge(settings: Settings, threshold: float):
    """Rows by node, graph rows and improvements: the best entries of each node, `cap` many."""

    def lists(node, sizes, nbrs, sims, old, cap):
        entry = np.repeat(node, sizes)
        was = np.repeat(old, sizes)
        order = np.lexsort((~was, nbrs, entry))
        entry, nbrs, sims, was = entry[order], nbrs[order], sims[order], was[order]
        first = np.ones(len(entry), bool)
        first[1:] = (entry[1:] != entry[:-1]) | (nbrs[1:] != nbrs[:-1])
        entry, nbrs, sims, was = entry[first], nbrs[first], sims[first], was[first]
        order = np.lexsort((nbrs, -sims, entry))
        entry, nbrs, sims, was = entry[order], nbrs[order], sims[order], was[order]
        who, start, count = np.unique(entry, return_index=True, return_counts=True)
        room = np.full(len(who), settings.k, np.int64)
        np.maximum.at(room, np.searchsorted(who, node), cap)
        rank = np.arange(len(entry)) - np.repeat(start, count)
        near = np.bincount(
            np.repeat(np.arange(len(who)), count)[sims >= threshold - SLACK], minlength=len(who)
        )
        while True:  # a saturated list is enlarged
            full = (near >= room) & (room < settings.cap_limit)
            if not full.any():
                break
            room[full] = np.minimum(room[full] * 2, settings.cap_limit)
        keep = rank < np.repeat(room, count)
        kept = np.minimum(count, room)
        offsets = np.zeros(len(who) + 1, np.int32)
        np.cumsum(kept, out=offsets[1:])
        nbrs, sims, was = nbrs[keep], sims[keep], was[keep]
        worst = np.where(kept >= room, sims[offsets[1:] - 1], -1.0)
        return table({
            "node": who,
            "nbrs": pa.ListArray.from_arrays(offsets, nbrs),
            "sims": pa.ListArray.from_arrays(offsets, sims.astype(np.float32)),
            "fresh": pa.ListArray.from_arrays(offsets, ~was),
            "cap": room.astype(np.int32),
            "worst": worst.astype(np.float32),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in _with_end(batches):
            if batch is not None:
                found = pa.Table.from_batches([held, batch] if held is not None else [batch])
                found = found.combine_chunks().to_batches()[0]
                node = found.column(0).to_numpy(zero_copy_only=False)
                cut = int(np.searchsorted(node, node[-1], "left"))
                held = found.slice(cut)
                found = found.slice(0, cut)
            elif held is None:
                break
            else:
                found = held
            if not found.num_rows:
                continue
            yield lists(
                found.column(0).to_numpy(zero_copy_only=False),
                found.column(1).value_lengths().to_numpy(zero_copy_only=False),
                np.asarray(found.column(1).flatten()), np.asarray(found.column(2).flatten()),
                found.column(3).to_numpy(zero_copy_only=False),
                found.column(4).to_numpy(zero_copy_only=False),
            )

    return run


def _merged(entries: DataFrame, graph: DataFrame | None, settings: Settings, threshold: float):
    rows = entries.select("node", "nbrs", "sims", F.lit(False).alias("old"), F.lit(0).alias("cap"))
    if graph is not None:
        rows = rows.union(graph.select("node", "nbrs", "sims", F.lit(True), "cap"))
    return staged(
        rows.repartition("node").sortWithinPartitions("node").mapInArrow(
            _merge(settings, threshold), GRAPH
        ),
        "neighbours",
    )


def _from_orders(points, settings, threshold, dim, rows, seed, graph=None) -> DataFrame:
    ordered = points.select("node", "q").mapInArrow(
        _orders(settings, dim, rows, seed), "code long, at double, node long, q binary"
    ).repartitionByRange("code", "at").sortWithinPartitions("code", "at").select("node", "q")
    return _merged(ordered.mapInArrow(_first_lists(settings.k), ENTRIES), graph, settings, threshold)


def _tasks(members: DataFrame) -> DataFrame:
    """`members` (centre, node, fresh) with the task they are compared in. Members of a hub are dealt
    to blocks of about 2 * BLOCK, and every pair of blocks is a task of its own."""
    hubs = members.groupBy("centre").count().where(F.col("count") > 2 * BLOCK).select(
        "centre", F.ceil(F.col("count") / (2 * BLOCK)).cast("int").alias("blocks")
    )
    dealt = members.join(hubs, "centre", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    spread = own.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    return spread.select(
        "centre", "node", "fresh",
        (F.least("own", "other").cast("long") * F.col("blocks") + F.greatest("own", "other")).alias("task"),
        (F.col("own") > F.col("other")).alias("second"),
    )


def _refined(points: DataFrame, graph: DataFrame, settings: Settings, threshold: float):
    """One round: neighbours of neighbours."""
    flat = graph.select("node", F.explode(F.arrays_zip("nbrs", "fresh")).alias("e")).select(
        "node", F.col("e.nbrs").alias("nbr"), F.col("e.fresh").alias("fresh")
    )
    members = flat.select(F.col("node").alias("centre"), F.col("nbr").alias("node"), "fresh").union(
        flat.select("nbr", "node", "fresh")
    ).union(graph.select("node", "node", F.lit(False)))
    found = _tasks(members).join(
        points.select("node", "q").join(graph.select("node", "worst"), "node"), "node"
    ).select("centre", "task", "second", "node", "fresh", "worst", "q")
    found = found.repartition("centre", "task").sortWithinPartitions("centre", "task", "node")
    return _merged(
        found.mapInArrow(_local_joins(settings.k), ENTRIES), graph, settings, threshold
    )


def _audited(points, graph, settings, threshold, number) -> tuple[int, int, int]:
    """Points compared with all others, the links they have, and how many of these are found."""
    asked = points.select("node", "raw").orderBy(F.xxhash64("node")).limit(number).collect()
    if not asked:
        return 0, 0, 0
    ids = np.array([r["node"] for r in asked], np.int64)
    x = np.stack([np.frombuffer(r["raw"], np.float64) for r in asked])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CELL):
                part = batch.slice(at, CELL)
                who = part.column(0).to_numpy(zero_copy_only=False)
                y = _matrix(part.column(1), np.float64)
                a, b = np.nonzero((x @ y.T >= threshold) & (ids[:, None] != who[None, :]))
                yield table({"node": ids[a], "nbr": who[b]})

    true = points.select("node", "raw").mapInArrow(run, "node long, nbr long")
    # Links of two points with full lists are counted exactly; any other is in the list that is not full.
    full = F.size("nbrs") >= settings.cap_limit
    if "worst" in graph.columns:
        full = full & (F.col("worst") >= threshold - SLACK)
    held = graph.select("node", "nbrs", full.alias("full"))
    other = held.select(F.col("node").alias("nbr"), F.col("nbrs").alias("nbrs2"), F.col("full").alias("full2"))
    row = true.join(held, "node", "left").join(other, "nbr", "left").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.coalesce(F.array_contains("nbrs", F.col("nbr")) | (
            F.col("full") & (F.col("full2") | F.array_contains("nbrs2", F.col("node")))
        ), F.lit(False)).cast("int")).alias("hits"),
    ).first()
    return len(asked), row["n"], row["hits"] or 0


def audit(
    points: DataFrame, graph: DataFrame, settings: Settings, threshold: float
) -> tuple[float, bool]:
    """Share of the links of some points that are found, and whether enough links were seen to tell.

    More points are taken until `settings.audit_links` links were seen, or all points, or
    `settings.audit_most`; only the latter may see too few links.
    """
    first = points.select("raw").head(1)
    most = min(settings.audit_most, AUDIT_BYTES // max(len(first[0]["raw"]), 1)) if first else 1
    number = min(settings.audit, most)
    while True:
        asked, seen, hits = _audited(points, graph, settings, threshold, number)
        recall = hits / seen if seen else 1.0
        if asked < number or seen >= settings.audit_links:
            return recall, True
        if number >= most:
            return recall, points.count() <= asked
        number = min(4 * number, most)


def audit_recall(
    points: DataFrame, graph: DataFrame, settings: Settings, threshold: float
) -> float:
    """Share of the links of audited points that are found."""
    return audit(points, graph, settings, threshold)[0]


def _known(fresh: DataFrame, graph: DataFrame, settings: Settings, threshold: float) -> float:
    """Share of the links in lists from fresh orders that the graph holds already: fresh orders see
    a share of all links whatever the number of rows, also where links are rare."""
    found = fresh.select("node", F.explode(F.arrays_zip("nbrs", "sims")).alias("e")).where(
        F.col("e.sims") >= threshold
    )
    held = graph.select("node", F.col("nbrs").alias("held"))
    row = found.join(held, "node").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((
            F.array_contains("held", F.col("e.nbrs")) | (F.size("held") >= settings.cap_limit)
        ).cast("int")).alias("hits"),
    ).first()
    return row["hits"] / row["n"] if row["n"] else 1.0


def neighbour_graph(
    points: DataFrame, dim: int, threshold: float, settings: Settings
) -> tuple[DataFrame, float]:
    """The refined graph (node, nbrs, sims, ...) of points (node, raw, q) and its recall, below
    `settings.recall` only if further orders did not help."""
    rows = points.count()
    number = starts(rows, threshold, settings)
    runs = math.ceil(number / (2 * settings.orders))
    graph = None
    for run in range(runs):
        some = settings._replace(orders=math.ceil(number / runs))
        graph = _from_orders(points, some, threshold, dim, rows, (1, run), graph)
    for again in range(settings.repeats + 1):
        for _ in range(settings.rounds):
            graph = _refined(points, graph, settings, threshold)
            # Farther neighbours only lead to closer ones; they need not be the best there are.
            fresh = F.exists(
                F.arrays_zip("sims", "fresh"),
                lambda e: e["fresh"] & (e["sims"] >= threshold - settings.near),
            )
            if not graph.where(fresh).head(1):
                break
        recall, told = audit(points, graph, settings, threshold)
        if told and (recall >= settings.recall or again == settings.repeats):
            return graph, recall
        more = _from_orders(points, settings, threshold, dim, rows, (2, again))
        if not told:
            recall = min(recall, _known(more, graph, settings, threshold))
        graph = _merged(more, graph, settings, threshold)
        if not told and (recall >= settings.recall or again == settings.repeats):
            return graph, recall


def _exact(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (_matrix(batch.column(i), np.float64) for i in (2, 3))
            near = np.einsum("ij,ij->i", x, y) >= threshold
            yield batch.filter(pa.array(near)).select([0, 1, 4, 5])

    return run


def _cells(dim: int):
    """Rows by group: blocks of at most CELL points of one group, with ids, roots, copies and vectors
    side by side, a centre and the largest angle to it; and parts, runs of such blocks."""
    most = max(PART_BYTES // (8 * dim), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, ids, roots, copies = (
                batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)
            )
            bounds = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
            part, held = None, 0
            for a, b in zip(bounds[:-1], bounds[1:]):
                for at in range(a, b, CELL):
                    stop = min(at + CELL, b)
                    raws = b"".join(batch.column(4).slice(at, stop - at).to_pylist())
                    x = np.frombuffer(raws, np.float64).reshape(stop - at, dim)
                    centre = x.mean(0)
                    length = np.linalg.norm(centre)
                    # Without a direction in common any will do, as no angle is larger than pi.
                    centre = centre / length if length > 1e-6 else x[0]
                    if part is None or held + stop - at > most:
                        part, held = ids[at], 0
                    held += stop - at
                    yield table({
                        "part": [part], "cell": ids[at:at + 1],
                        **{name: pa.array([v[at:stop].tobytes()], pa.binary())
                           for name, v in (("ids", ids), ("roots", roots), ("copies", copies))},
                        "raws": pa.array([raws], pa.binary()),
                        "centre": pa.array([centre.tobytes()], pa.binary()),
                        "radius": [float(np.arccos(np.clip(x @ centre, -1, 1)).max())],
                    })

    return run


CELLS = (
    "part long, cell long, ids binary, roots binary, copies binary, raws binary, centre binary, "
    "radius double"
)


def _least_angles(x, rx, y, ry) -> np.ndarray:
    """Angles between points of cells are at least this; x, y: centres, rx, ry: radii."""
    return np.arccos(np.clip(x @ y.T, -1, 1)) - rx[:, None] - ry[None, :]


def _near_parts(threshold: float):
    """Rows of two blocks of parts: the pairs of parts that may hold a link."""
    limit = math.acos(max(min(threshold, 1.0), -1.0)) + MARGIN

    def side(row, end):
        cells = row["cells" + end]
        part = np.array([c["part"] for c in cells], np.int64)
        order = np.argsort(part, kind="stable")
        centre = np.stack([np.frombuffer(cells[i]["centre"], np.float64) for i in order])
        return part[order], centre, np.array([cells[i]["radius"] for i in order])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                (pa_, x, rx), (pb, y, ry) = side(row, ""), side(row, "2")
                bounds = np.flatnonzero(np.r_[True, pa_[1:] != pa_[:-1], True])
                for a, b in zip(bounds[:-1], bounds[1:]):
                    near = (_least_angles(x[a:b], rx[a:b], y, ry) <= limit).any(0)
                    other = np.unique(pb[near])
                    if row["block"] == row["block2"]:
                        other = other[other >= pa_[a]]
                    low, high = np.minimum(other, pa_[a]), np.maximum(other, pa_[a])
                    yield table({"part": low, "part2": high})

    return run


def _part_links(threshold: float, dim: int):
    """The cells of two parts, or of one: links of their points, and roots that links join."""
    limit = math.acos(max(min(threshold, 1.0), -1.0))

    def run(rows: pa.Table) -> pa.Table:
        cells = [
            {k: np.frombuffer(r[k], np.int64) for k in ("ids", "roots", "copies")} | {
                "x": np.frombuffer(r["raws"], np.float64).reshape(-1, dim), "side": r["side"],
                "links": np.zeros(len(r["ids"]) // 8, np.int64),
            }
            for r in rows.to_pylist()
        ]
        centre = np.stack([np.frombuffer(c, np.float64) for c in rows["centre"].to_pylist()])
        radius = rows["radius"].to_numpy()
        least = _least_angles(centre, radius, centre, radius)
        two = any(c["side"] for c in cells)
        joined = []
        for i, one in enumerate(cells):
            for j in range(i, len(cells)):
                other = cells[j]
                if (two and one["side"] == other["side"]) or least[i, j] > limit + MARGIN:
                    continue
                near = one["x"] @ other["x"].T >= threshold
                if i == j:
                    np.fill_diagonal(near, False)
                one["links"] += near @ other["copies"]
                if i != j:
                    other["links"] += near.T @ one["copies"]
                if (one["roots"] != one["roots"][0]).any() or (other["roots"] != one["roots"][0]).any():
                    a, b = np.nonzero(near)
                    a, b = one["roots"][a], other["roots"][b]
                    joined.append(local_forest(a[a != b], b[a != b]))
        a, b = (np.concatenate(x) for x in zip(*joined)) if joined else (np.zeros(0, np.int64),) * 2
        a, b = local_forest(a, b)
        node = np.concatenate([c["ids"] for c in cells])
        return pa.table({
            "a": np.concatenate([node, a]),
            "links": pa.array(np.concatenate([c["links"] for c in cells]).tolist() + [None] * len(a), pa.int64()),
            "b": pa.array([None] * len(node) + b.tolist(), pa.int64()),
        })

    return run


def _block_links(inside: DataFrame, dim: int, threshold: float) -> DataFrame:
    """All links among the points (group, node, root, copies, raw), whatever their roots: rows
    (a: node, links) to be summed, and rows (a, b) of roots that links join, where links is null.

    Cells are of one group. Pairs of parts are tasks of their own; the angle between centres rules
    out pairs of cells, and all others are compared in doubles.
    """
    cells = staged(
        inside.repartitionByRange("group", "node").sortWithinPartitions("group", "node").mapInArrow(
            _cells(dim), CELLS
        ),
        "neighbour-cells",
    )
    blocks = cells.select(F.countDistinct("part")).first()[0] // PART_BLOCK + 1
    outline = staged(
        cells.groupBy(F.pmod(F.xxhash64("part"), F.lit(blocks)).alias("block")).agg(
            F.collect_list(F.struct("part", "centre", "radius")).alias("cells")
        ),
        "neighbour-outline",
    )
    # Each pair of blocks is a task's row: a block's outline goes to the pairs it is of.
    last = F.lit(blocks - 1).cast("long")
    low = outline.select("block", "cells", F.explode(F.sequence("block", last)).alias("block2"))
    high = outline.select(
        F.explode(F.sequence(F.lit(0).cast("long"), "block")).alias("block"),
        F.col("block").alias("block2"), F.col("cells").alias("cells2"),
    )
    pairs = staged(
        low.join(high, ["block", "block2"]).mapInArrow(
            _near_parts(threshold), "part long, part2 long"
        ),
        "neighbour-parts",
    )
    one = cells.join(pairs, "part").withColumn("side", F.lit(0))
    two = cells.withColumnRenamed("part", "part2").join(pairs.where("part < part2"), "part2")
    both = one.unionByName(two.withColumn("side", F.lit(1)))
    return staged(
        both.groupBy("part", "part2").applyInArrow(
            _part_links(threshold, dim), "a long, links long, b long"
        ),
        "neighbour-counts",
    )


def _linked(base: DataFrame, dim: int, threshold: float, settings: Settings) -> DataFrame:
    """(node, links, root): links to other points of each node, copies counted, and its group."""
    points = base
    graph, recall = neighbour_graph(points, dim, threshold, settings)
    whole = recall < settings.recall  # then the lists do not suffice, and all points are compared
    if whole:
        logger.warning("recall %.4f is below %.4f: all points are compared", recall, settings.recall)
    pairs = graph.select("node", F.explode(F.arrays_zip("nbrs", "sims")).alias("e")).where(
        F.col("e.sims") >= threshold - SLACK
    ).select(F.least("node", "e.nbrs").alias("a"), F.greatest("node", "e.nbrs").alias("b")).distinct()
    one = points.select(F.col("node").alias("a"), F.col("raw").alias("x"), F.col("copies").alias("na"))
    two = points.select(F.col("node").alias("b"), F.col("raw").alias("y"), F.col("copies").alias("nb"))
    edges = staged(
        pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y", "na", "nb").mapInArrow(
            _exact(threshold), "a long, b long, na long, nb long"
        ),
        "neighbour-edges",
    )
    roots = staged(components(edges, "neighbour-groups"), "neighbour-roots")
    # Groups with a list that was full to the limit: all pairs of their points, within a group and
    # across, as two points with full lists may be linked without being in each other's list.
    full = points.select("node") if whole else graph.where(
        (F.size("nbrs") >= settings.cap_limit) & (F.col("worst") >= threshold - SLACK)
    ).select("node")
    # A full list need not hold a link: its entries are near the threshold only.
    full = full.join(roots, "node", "left").select(F.coalesce("root", "node").alias("root"))
    dense = staged(full.distinct(), "neighbour-dense")
    if dense.head(1):
        known = points.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        found = _block_links(
            known.join(dense, "root").select(
                (F.lit(0).cast("long") if whole else F.col("root")).alias("group"), "node", "root",
                "copies", "raw",
            ),
            dim, threshold,
        )
        merged = staged(
            components(found.where("links is null").select("a", "b"), "neighbour-merged"),
            "neighbour-joined",
        )
        sparse = edges.join(roots.withColumnRenamed("node", "a"), "a").join(dense, "root", "left_anti")
        counted = found.where("links is not null").select(F.col("a").alias("node"), "links")
        roots = known.select("node", "root").join(
            merged.select(F.col("node").alias("root"), F.col("root").alias("over")), "root", "left"
        ).select("node", F.coalesce("over", "root").alias("root"))
    else:
        sparse, counted = edges, edges.select(F.col("a").alias("node"), F.col("nb").alias("links")).limit(0)
    counted = counted.union(sparse.select("a", "nb")).union(sparse.select("b", "na"))
    links = counted.groupBy("node").agg(F.sum("links").alias("links"))
    return points.select("node", "first_id", "copies").join(roots, "node", "left").join(
        links, "node", "left"
    ).select(
        "node", "first_id", "copies", F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("root", "node").alias("root"),
    )


def near_duplicates(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    threshold: float = 0.95, settings: Settings | None = None,
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row.

    n_links counts the other rows at a cosine of at least `threshold`, equal vectors included;
    component_id is the smallest id reachable by links, the own one included; kept marks it.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor
    do vectors of different length. Rows that repeat an id are rows of their own; rows with a null
    id link, but name no component. Other columns are not looked at.
    """
    settings = settings or Settings()
    base = rows.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).alias("_v"))
    good = F.expr(
        "size(_v) > 0 and forall(_v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) "
        "and exists(_v, x -> x <> 0)"
    )
    grouped = staged(
        base.where(F.coalesce(good, F.lit(False))).groupBy("_v").agg(
            F.min("_id").alias("first_id"), F.count(F.lit(1)).alias("copies")
        ).withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )
    found = None
    for (dim,) in grouped.select(F.size("_v")).distinct().collect():  # usually one length
        points = staged(
            grouped.where(F.size("_v") == dim).select("_v", "node", "first_id", "copies").mapInArrow(
                _points, "node long, first_id long, copies long, raw binary, q binary"
            ),
            "points",
        )
        part = _linked(points, dim, threshold, settings)
        found = part if found is None else found.union(part)
    if found is None:
        return base.select(
            F.col("_id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
            F.col("_id").alias("component_id"), F.lit(True).alias("kept"),
        )
    found = staged(found, "vector-links")
    named = found.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = grouped.select("_v", "node").join(found, "node").join(named, "root")
    known = known.select("_v", (F.col("links") + F.col("copies") - 1).alias("n"), "component_id")
    out = base.withColumn("_good", F.coalesce(good, F.lit(False)))
    linked = out.where("_good").join(known, "_v").select("_id", "n", "component_id")
    alone = out.where("not _good").select("_id", F.lit(0).cast("long"), "_id")
    return linked.union(alone).select(
        F.col("_id").alias(id_col), F.col("n").alias("n_links"), "component_id",
        F.coalesce(F.col("_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
