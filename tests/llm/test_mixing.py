import random

import pytest

from shopgrain.llm import mixing


def test_quotas_reshare_until_none_is_above():
    assert mixing.quotas([100, 100, 100], [1, 2, 3], 3) == [50, 100, 150]
    # The third may take 30, the rest goes to the others by weight.
    assert mixing.quotas([200, 200, 10], [1, 2, 3], 3) == pytest.approx([380 / 3, 760 / 3, 30])
    assert mixing.quotas([0, 5], [3, 1], 3) == [0, 5]
    assert mixing.quotas([], [], 3) == []


def cost_of(flow, patterns):
    total = 0
    for (size, _), given in zip(patterns, flow):
        words = sum(given.values())
        for use in range(3):
            total += use * min(max(words - use * size, 0), size)
    return total


def test_flow_meets_quotas_at_least_cost():
    rng = random.Random(2)
    for _ in range(60):
        sources = rng.randint(1, 3)
        patterns = [
            (rng.randint(0, 4), sorted(rng.sample(range(sources), rng.randint(1, sources))))
            for _ in range(rng.randint(1, 3))
        ]
        wanted = [rng.randint(0, 5) for _ in range(sources)]
        flow = mixing.min_cost_flow(patterns, wanted, 3)
        for (size, members), given in zip(patterns, flow):
            assert set(given) <= set(members) and sum(given.values()) <= 3 * size
        got = [sum(g.get(s, 0) for g in flow) for s in range(sources)]
        assert all(g <= w for g, w in zip(got, wanted))
        # Against every way to hand out the words.
        best = None

        def walk(k, left, given):
            nonlocal best
            if k == len(patterns):
                total = sum(wanted) - sum(left)
                price = (-total, cost_of(given, patterns))
                best = price if best is None or price < best else best
                return
            size, members = patterns[k]

            def deal(i, room, now, left):
                if i == len(members):
                    walk(k + 1, left, [*given, now])
                    return
                for x in range(min(room, left[members[i]]) + 1):
                    rest = list(left)
                    rest[members[i]] -= x
                    deal(i + 1, room - x, {**now, members[i]: x}, rest)

            deal(0, 3 * size, {}, left)

        walk(0, wanted, [])
        assert (-sum(got), cost_of(flow, patterns)) == best


def documents(spark, n=600, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["b", "a", "a", "a", "ä", "Z", None])
        rows.append((i, " ".join(["w"] * rng.randint(0, 60)), source))
    rows += [(n, None, "a"), (n + 1, "", "tiny"), (n + 2, "one two", "tiny")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mix_comes_near_its_targets(spark):
    rows, frame = documents(spark)
    docs, sources = mixing.mix(frame)
    docs, sources = docs.collect(), {r["source"]: r for r in sources.collect()}
    sizes = {i: len((t or "").split()) for i, t, _ in rows}
    names = sorted({s for *_, s in rows if s is not None}) + [None]
    held = [sum(sizes[i] for i, _, s in rows if s == name) for name in names]
    targets = mixing.quotas(held, [(1, 2, 3)[k % 3] for k in range(len(names))], 3)
    assert len(docs) == len(rows)
    for name, size, target in zip(names, held, targets):
        assert (sources[name]["source_size"], sources[name]["target"]) == (size, pytest.approx(target))
        mine = [d for d in docs if d["source"] == name]
        assert abs(sum(d["taken"] for d in mine) - target) <= 31
    for d in docs:
        assert d["size"] == sizes[d["doc_id"]]
        assert d["taken"] == d["size"] * d["copies"] and 0 <= d["copies"] <= 3
    again, _ = mixing.mix(frame.repartition(7))
    assert sorted(map(str, again.collect())) == sorted(map(str, docs))


def test_overlapping_sources(spark):
    rng = random.Random(9)
    rows = [(i, "w " * rng.randint(1, 20), rng.choice([["a"], ["b"], ["a", "b"], [], None, ["b", "a"]]))
            for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    docs, sources = mixing.mix(frame, cycle=(1, 4))
    taken = sum(d["taken"] for d in docs.collect())
    wanted = sum(r["target"] for r in sources.collect())
    assert abs(taken - wanted) <= 20 * 4


def test_empty_table_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    docs, sources = mixing.mix(empty)
    assert docs.collect() == [] and sources.collect() == []
    same = spark.createDataFrame([(1, "a b", "s")] * 5 + [(None, "c", "s")], empty.schema)
    docs, _ = mixing.mix(same.selectExpr("*", "1 as size", "2 as copies", "'x' as pattern"))
    assert len(docs.collect()) == 6


@pytest.mark.parametrize("key", [7, None])
def test_rows_of_one_id_are_chosen_one_by_one(spark, key):
    rows = [(key, "a b c", "x")] * 200 + [(key, "a b c", "y")] * 100
    docs, sources = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    taken = {}
    for d in docs.collect():
        taken[d["source"]] = taken.get(d["source"], 0) + d["taken"]
    targets = {r["source"]: r["target"] for r in sources.collect()}
    assert targets == pytest.approx({"x": 300, "y": 600})
    assert all(abs(taken[s] - targets[s]) <= 3 for s in targets)


def test_too_many_patterns(spark):
    frame = spark.createDataFrame(
        [(i, "a", ["all", str(i)]) for i in range(5)], "doc_id long, text string, source array<string>"
    )
    with pytest.raises(ValueError):
        mixing.mix(frame, max_patterns=4)


@pytest.mark.parametrize("limit", ["10485760", "-1"])
def test_any_number_of_sources_of_their_own(spark, limit):
    frame = spark.range(30_000).selectExpr(
        "id as doc_id", "repeat('w ', cast(1 + id % 50 as int)) as text",
        "if(id % 3 = 0, 'hot', cast(id % 9000 as string)) as source",
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        docs, sources = mixing.mix(frame, max_patterns=4)
        docs, sources = docs.collect(), sources.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    sources.sort(key=lambda r: r["source"])
    wanted = mixing.quotas(
        [r["source_size"] for r in sources], [(1, 2, 3)[k % 3] for k in range(len(sources))], 3
    )
    assert len(docs) == 30_000 and len(sources) > 4
    assert [r["target"] for r in sources] == pytest.approx(wanted)
    taken, largest = {}, {}
    for d in docs:
        assert d["taken"] == d["size"] * d["copies"] and 0 <= d["copies"] <= 3
        taken[d["source"]] = taken.get(d["source"], 0) + d["taken"]
        largest[d["source"]] = max(largest.get(d["source"], 0), d["size"])
    assert all(abs(taken[r["source"]] - r["target"]) <= largest[r["source"]] for r in sources)


def test_overlaps_beside_sources_of_their_own(spark):
    """The flow sees the overlapping sources alone, and every source still gets its target."""
    rows = [(i, "w " * (1 + i % 7), [f"own{i % 40}"]) for i in range(2000)]
    rows += [(2000 + i, "w " * (1 + i % 5), ["p", "q"][: 1 + i % 2]) for i in range(400)]
    rows += [(2400 + i, "w", ["q\x1f=p"]) for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    docs, sources = mixing.mix(frame, max_patterns=2)
    targets = {r["source"]: r["target"] for r in sources.collect()}
    taken = {}
    for d in docs.collect():
        taken["+".join(d["source"])] = taken.get("+".join(d["source"]), 0) + d["taken"]
    own = [s for s in targets if s not in ("p", "q")]
    assert len(own) == 41
    assert all(abs(taken.get(s, 0) - targets[s]) <= 7 for s in own)
    assert abs(taken.get("p", 0) + taken.get("p+q", 0) - targets["p"] - targets["q"]) <= 10
