import math

import numpy as np
import pytest

from shopgrain.llm import neighbours
from shopgrain.llm.neighbours import Settings


def planted(seed, noise=1500, dim=32, groups=(2, 2, 3, 5, 9, 20, 60)):
    rng = np.random.default_rng(seed)
    rows = [rng.standard_normal(dim) for _ in range(noise)]
    for size in groups:
        centre = rng.standard_normal(dim)
        rows += [centre + 0.12 * rng.standard_normal(dim) for _ in range(size)]
    # A chain: neighbours are linked, the ends are not.
    a, b = np.linalg.qr(rng.standard_normal((dim, 2)))[0].T
    rows += [math.cos(t) * a + math.sin(t) * b for t in np.arange(12) * 0.25]
    order = rng.permutation(len(rows))
    return [[float(np.float32(x)) for x in rows[i]] for i in order]


def slow(rows, threshold):
    """[(id, n_links, component, kept)]"""
    good = [
        i for i, (_, v) in enumerate(rows)
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    links = {i: set() for i in range(len(rows))}
    for dim in {len(rows[i][1]) for i in good}:
        at = [i for i in good if len(rows[i][1]) == dim]
        x = np.array([rows[i][1] for i in at], np.float64)
        x /= np.abs(x).max(1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(x @ x.T >= threshold)):
            if a != b:
                links[at[a]].add(at[b])
    out, seen = [], {}
    for i in range(len(rows)):
        if i not in seen:
            group, stack = {i}, [i]
            while stack:
                for j in links[stack.pop()]:
                    if j not in group:
                        group.add(j)
                        stack.append(j)
            least = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
            seen |= dict.fromkeys(group, least)
        out.append((rows[i][0], len(links[i]), seen[i], rows[i][0] is not None and rows[i][0] == seen[i]))
    return sorted(out, key=str)


def checked(spark, rows, settings=None, threshold=0.95, kind="float"):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(6)
    frame = frame.selectExpr("*", "1 as node", "'x' as raw", "2 as copies")
    found = neighbours.near_duplicates(frame, threshold=threshold, settings=settings).collect()
    assert sorted((tuple(r) for r in found), key=str) == slow(rows, threshold)


def test_planted_groups(spark):
    checked(spark, list(enumerate(planted(1))))


def test_saturated_lists_are_enlarged_and_dense_groups_counted(spark):
    rows = list(enumerate(planted(2, 300)))
    checked(spark, rows, Settings(k=4, cap_limit=8, audit=500))


def test_cells_of_a_large_group(spark, monkeypatch):
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(16)
    rows = [(i, [float(np.float32(x)) for x in centre + 0.25 * rng.standard_normal(16)]) for i in range(1300)]
    checked(spark, rows, Settings(k=8, cap_limit=16))


def tight_groups(rng, cosines, size, dim=64, spread=0.004):
    """Groups of close vectors; the cosine of each group's centre with the first one's."""
    axes = np.linalg.qr(rng.standard_normal((dim, len(cosines))))[0].T
    rows = []
    for axis, cosine in zip(axes, cosines):
        centre = cosine * axes[0] + math.sqrt(1 - cosine * cosine) * (axis if cosine < 1 else 0)
        rows += list(centre + spread * rng.standard_normal((size, dim)))
    return [(i, [float(np.float32(x)) for x in rows[k]]) for i, k in enumerate(rng.permutation(len(rows)))]


@pytest.mark.parametrize("part_bytes", [8 << 20, 40 * 8 * 64])
def test_links_between_dense_groups(spark, monkeypatch, part_bytes):
    # Linked with the first: the second group. Not linked with any: the last.
    rows = tight_groups(np.random.default_rng(6), (1, 0.96, 0.5), 200)
    monkeypatch.setattr(neighbours, "PART_BYTES", part_bytes)
    monkeypatch.setattr(neighbours, "PART_BLOCK", 2)
    checked(spark, rows)


def test_odd_vectors_copies_and_ids(spark):
    rows = [(i, v) for i, v in enumerate(planted(3, 60, 8, (3, 4)))]
    rows += [(900 + i, rows[5][1]) for i in range(40)] + [(5, rows[5][1]), (5, rows[6][1]), (None, rows[5][1])]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 8), (2003, [1.0, None] * 4), (2004, [float("nan")] * 8),
             (2005, [float("inf")] + [1.0] * 7), (2006, [1.0, 2.0]), (2007, [2.0, 4.0]), (None, None)]
    checked(spark, rows)


def test_doubles_and_scaled_copies(spark):
    rows = [(1, [1e-200, 2e-200]), (2, [3.0, 6.0]), (3, [1e200, 2e200]), (4, [-1.0, -2.0])]
    checked(spark, rows, kind="double")


def test_empty_table(spark):
    assert neighbours.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_audit_sees_missing_links(spark):
    import pyspark.sql.functions as F

    base = [(i, np.eye(4)[i % 2].tobytes()) for i in range(20)]
    points = spark.createDataFrame([(i, bytearray(raw)) for i, raw in base], "node long, raw binary")
    whole = [(i, [j for j in range(20) if j != i and j % 2 == i % 2]) for i in range(20)]
    graph = spark.createDataFrame(whole, "node long, nbrs array<long>")
    settings = Settings(audit=20)
    assert neighbours.audit_recall(points, graph, settings, 0.95) == 1.0
    half = graph.withColumn("nbrs", F.slice("nbrs", 1, 3))
    assert neighbours.audit_recall(points, half, settings, 0.95) == pytest.approx(3 / 9)


def test_missing_links_are_found_where_links_are_rare(spark):
    # One order and no refinement lose links; the audit must see it and act.
    rows = list(enumerate(planted(8, 3000, 32, (2,) * 12)))
    checked(spark, rows, Settings(orders=1, rounds=0, repeats=0, recall=1.0))


def test_too_few_audited_links_are_told(spark):
    base = [(i, bytearray(np.eye(16)[i % 16].tobytes())) for i in range(18)]
    points = spark.createDataFrame(base, "node long, raw binary")
    graph = spark.createDataFrame([(i, [], []) for i in range(18)], "node long, nbrs array<long>, sims array<float>")
    assert neighbours.audit(points, graph, Settings(audit=1), 0.95) == (0.0, True)
    assert not neighbours.audit(points, graph, Settings(audit=1, audit_most=3), 0.95)[1]
    fresh = spark.createDataFrame([(0, [16], [1.0]), (1, [2], [0.5])], graph.schema)
    assert neighbours._known(fresh, graph, Settings(), 0.95) == 0.0
    assert neighbours._known(fresh, fresh, Settings(), 0.95) == 1.0


def test_rare_links_are_judged_by_fresh_orders(spark):
    rows = list(enumerate(planted(9, 800, 32, (2, 3, 4))))
    checked(spark, rows, Settings(audit=4, audit_most=8))


@pytest.mark.parametrize("rows", [10 ** 4, 10 ** 6, 10 ** 8])
def test_start_orders_grow_with_the_rows(rows):
    depth = neighbours._depth(rows)
    together = (1 - math.acos(0.95) / math.pi) ** depth
    assert 1 - (1 - together) ** neighbours.starts(rows, 0.95, Settings()) >= 0.99


def test_all_members_of_a_hub_are_compared(spark):
    rng = np.random.default_rng(4)
    n = 900
    raw = rng.integers(-127, 128, (n, 16)).astype(np.int8)
    # Two equal vectors that only meet at the hub 0, with node ids far apart.
    raw[1] = raw[n - 1]
    x = raw / np.linalg.norm(raw.astype(float), axis=1, keepdims=True)
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    points = spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in enumerate(raw)], "node long, q binary")
    graph = spark.createDataFrame(
        [(0, [], [], [], 4, -1.0)] + [(i, [0], [float(sims[i, 0])], [True], 4, -1.0) for i in range(1, n)], neighbours.GRAPH
    )
    found = neighbours._refined(points, graph, Settings(k=4), 0.95).where("node > 0").collect()
    best = sims.argmax(1)
    assert {r["node"]: r["nbrs"][0] for r in found} == {i: best[i] for i in range(1, n)}
