"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents that belong to the same set of sources are one node of the flow. A pattern can give its
words up to `epochs` times, each further time at a higher cost; each source asks for its quota.
The flow says how many words each pattern gives; documents are then chosen in the order of a
seeded hash. Sources, patterns and cuts stay in Spark, however many there are: a source that
overlaps no other takes its quota from its own words, which needs no flow. Only the patterns of
overlapping sources reach the driver.
"""

from __future__ import annotations

from collections import deque
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from shopgrain.llm.common import staged, unique_ids
from shopgrain.operators.lookup import lookup_join

WORDS = r"[^\x20\x09-\x0D]+"
# Bits of the seeded hash that one refinement step looks at, and bits of the hash.
STEP_BITS, PLACE_BITS = 12, 60


def quotas(sizes: list[float], weights: list[float], epochs: int) -> list[float]:
    """Shares of the total by weight; none above `epochs` times its size, the rest reshared.

    The rule on lists; `_targets` applies it to a table of sources.
    """
    total, left = float(sum(sizes)), set(range(len(sizes)))
    out = [0.0] * len(sizes)
    while left:
        weight = sum(weights[k] for k in left)
        over = {k for k in left if total * weights[k] / weight > epochs * sizes[k]}
        if not over:
            for k in left:
                out[k] = total * weights[k] / weight
            break
        for k in over:
            out[k] = float(epochs * sizes[k])
        total -= sum(out[k] for k in over)
        left -= over
    return out


def min_cost_flow(
    patterns: list[tuple[int, list[int]]], wanted: list[int], epochs: int
) -> list[dict[int, int]]:
    """Words each pattern gives to each of its sources.

    `patterns` holds (size, sources). The k-th use of a pattern's words costs k - 1 a word.
    Successive shortest paths; each path fills a whole capacity, so there are few of them.
    """
    n, m = len(patterns), len(wanted)
    start, end = n + m, n + m + 1
    graph: list[list[int]] = [[] for _ in range(n + m + 2)]
    to, room, cost = [], [], []

    def arc(a: int, b: int, capacity: int, price: int) -> int:
        for x, y, c, p in ((a, b, capacity, price), (b, a, 0, -price)):
            graph[x].append(len(to))
            to.append(y), room.append(c), cost.append(p)
        return len(to) - 2

    given: list[dict[int, int]] = []
    for p, (size, members) in enumerate(patterns):
        for use in range(epochs):
            arc(start, p, size, use)
        given.append({s: arc(p, n + s, epochs * size, 0) for s in members})
    for s, words in enumerate(wanted):
        arc(n + s, end, words, 0)
    while True:
        best = [None] * len(graph)
        best[start], by, queue, queued = 0, [-1] * len(graph), deque([start]), {start}
        while queue:
            a = queue.popleft()
            queued.discard(a)
            for e in graph[a]:
                if room[e] > 0 and (best[to[e]] is None or best[a] + cost[e] < best[to[e]]):
                    best[to[e]], by[to[e]] = best[a] + cost[e], e
                    if to[e] not in queued:
                        queue.append(to[e])
                        queued.add(to[e])
        if best[end] is None:
            return [{s: room[e ^ 1] for s, e in out.items()} for out in given]
        path, at = [], end
        while at != start:
            path.append(by[at])
            at = to[by[at] ^ 1]
        amount = min(room[e] for e in path)
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount


def source_key(source: Column) -> Column:
    """A source as text that is never null and tells a null from every name."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("-"))


def _weighted(sources: DataFrame, cycle: tuple[float, ...]) -> DataFrame:
    """`sources` with the weight of each: those of `cycle` in turn, in code point order, null last.

    Sorted by range and counted per task, so that no task sees all of them.
    """
    order = [F.col("source").asc_nulls_last()]
    ranged = sources.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = staged(ranged.withColumn("_at", F.monotonically_increasing_id()), "mix-order")
    task, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    # A row for each task that wrote any.
    held = numbered.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    before = held.select("_task", F.expr("sum(_n) over (order by _task) - _n").alias("_before"))
    place = F.pmod(F.col("_before") + row, F.lit(len(cycle))).cast("int")
    weight = F.get(F.array(*[F.lit(float(w)) for w in cycle]), place)
    return numbered.withColumn("_task", task).join(F.broadcast(before), "_task").withColumn(
        "weight", weight
    ).drop("_at", "_task", "_before")


def _targets(sources: DataFrame, total: float, epochs: int) -> DataFrame:
    """`sources` (source_size, capacity, weight) with the target of each.

    Every round counts the sources that would get more than they can give; the rest share what these
    leave. The share of a weight only grows, so nobody leaves the list again.
    """
    left, weight, capped = float(total), None, -1
    while True:
        if weight is None:
            weight = sources.agg(F.sum("weight")).first()[0] or 0.0
        share = F.lit(left) * F.col("weight") / F.lit(weight) if weight else F.lit(float("inf"))
        over = share > F.col("capacity")
        found = sources.agg(
            F.count_if(over).alias("n"),
            F.sum(F.when(over, F.col("capacity"))).alias("given"),
            F.sum(F.when(~over, F.col("weight"))).alias("weight"),
        ).first()
        if found["n"] == capped:
            return sources.withColumn("target", F.when(over, F.col("capacity")).otherwise(share))
        capped, left = found["n"], float(total) - (found["given"] or 0.0)
        weight = found["weight"] or 0.0


def _flow_of_overlaps(
    patterns: DataFrame, sources: DataFrame, epochs: int, max_patterns: int
) -> DataFrame | None:
    """(_key, given) of the patterns whose sources overlap; None without any."""
    spark = patterns.sparkSession
    shared = sources.where("widest > 1").select("source_key", "target")
    met = patterns.select("_key", F.explode("_key").alias("source_key"))
    tied = patterns.join(
        met.join(shared, "source_key", "left_semi").select("_key").distinct(), "_key", "left_semi"
    )
    found = sorted((tuple(r["_key"]), r["size"]) for r in tied.limit(max_patterns + 1).collect())
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} combinations of overlapping sources")
    if not found:
        return None
    # No more of them than members of those patterns.
    wanted = sorted((r["source_key"], r["target"]) for r in shared.collect())
    number = {s: k for k, (s, _) in enumerate(wanted)}
    flow = min_cost_flow(
        [(words, [number[s] for s in key]) for key, words in found],
        [round(t) for _, t in wanted], epochs,
    )
    return spark.createDataFrame(
        [(list(key), sum(out.values())) for (key, _), out in zip(found, flow)],
        "_key array<string>, given long",
    )


def _cuts(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """(_key, cut): for each pattern the hash below which its documents hold about `words` words.

    Sums by leading hash bits find the range in which a cut lies, then only the documents of that
    range are looked at more closely, until it holds one. A pattern has at most 2 ** STEP_BITS
    ranges a step, and its documents spread over them.
    """
    state, cuts = wanted.select("_key", F.lit(0).cast("long").alias("low"), "words"), []
    for bits in range(0, PLACE_BITS, STEP_BITS):
        shift = PLACE_BITS - STEP_BITS - bits
        slot = F.shiftright("place", shift)
        rows = sized.select(
            "_key", "size", slot.alias("slot"), F.shiftright(slot, STEP_BITS).alias("low")
        )
        if bits:
            rows = rows.join(state.select("_key", "low"), ["_key", "low"], "left_semi")
        sums = rows.groupBy("_key", "slot").agg(
            F.sum("size").alias("held"), F.count(F.lit(1)).alias("docs")
        )
        running = sums.join(state.select("_key", "words"), "_key").withColumn("upto", F.expr(
            "sum(held) over (partition by _key order by slot)"
        ))
        # The slot in which the wanted sum is reached.
        hit = running.where("upto >= words").groupBy("_key").agg(
            F.min(F.struct("slot", "upto", "held", "docs", "words")).alias("x")
        ).select("_key", "x.*")
        missing = F.col("words") - (F.col("upto") - F.col("held"))
        near = F.col("slot") + F.when(2 * missing >= F.col("held"), 1).otherwise(0)
        found = staged(hit.select(
            "_key", F.col("slot").alias("low"), missing.alias("words"),
            F.shiftleft(near, shift).alias("cut"),
            ((F.col("docs") == 1) | F.lit(shift == 0)).alias("last"),
        ), "mix-cuts")
        cuts.append(found.where("last").select("_key", "cut"))
        state = found.where(~F.col("last"))
        if state.isEmpty():
            break
    return reduce(DataFrame.unionAll, cuts)


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    cycle: tuple[float, ...] = (1, 2, 3), epochs: int = 3, seed: int = 42,
    max_patterns: int = 200_000,
) -> tuple[DataFrame, DataFrame]:
    """(documents, sources) of the mix.

    documents: id, source (as given, a string or an array of strings), size (words),
    copies (how often the mix holds it) and taken (size * copies). sources: source, source_size,
    target. Sources in code point order, null last, get the weights of `cycle` in turn. A
    document of several sources counts in the size of each and is given once.

    Texts that are null or empty have size 0 and are taken 0 words. A null source, or an empty
    array, is a source of its own. Rows with null or repeated ids are documents of their own and are
    chosen one by one. An empty table gives empty results. Patterns of sources that overlap come to the
    driver, which refuses more than `max_patterns` of them; there may be any number of other sources.
    """
    many = isinstance(docs.schema[source_col].dataType, ArrayType)
    docs, _ = unique_ids(docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(source_col).alias("_source")
    ), "_id", "_text", "_uid")
    members = F.array_sort(F.array_distinct(F.col("_source"))) if many else F.array("_source")
    members = F.when(F.size(F.coalesce(members, F.array())) > 0, members).otherwise(
        F.array(F.lit(None).cast("string"))
    )
    size = F.coalesce(F.regexp_count(F.col("_text"), F.lit(WORDS)), F.lit(0)).cast("long")
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("_uid")), 64 - PLACE_BITS)
    sized = staged(docs.select(
        "_id", "_source",
        F.transform(members.cast("array<string>"), source_key).alias("_key"),
        size.alias("size"), place.alias("place"),
    ), "mix-sizes")
    patterns = staged(sized.groupBy("_key").agg(F.sum("size").alias("size")), "mix-patterns")
    found = patterns.select(F.explode("_key").alias("source_key"), F.size("_key").alias("n"), "size")
    found = found.groupBy("source_key").agg(
        F.sum("size").alias("source_size"), F.max("n").alias("widest")
    ).withColumn(
        "source", F.when(F.col("source_key") != "-", F.expr("substring(source_key, 2)"))
    )
    weighted = _weighted(found, cycle)
    sums = weighted.agg(F.sum("source_size")).first()[0] or 0
    total = patterns.agg(F.sum("size")).first()[0] or 0
    # Shares are of the words there are, also where sources overlap.
    scale = total / sums if sums else 0.0
    capacity = F.col("source_size") * F.lit(float(epochs * scale))
    sources = staged(
        _targets(weighted.withColumn("capacity", capacity), total, epochs), "mix-sources"
    )
    given = sources.where("widest = 1").select(
        F.array("source_key").alias("_key"), F.rint("target").cast("long").alias("given")
    )
    if many:
        flow = _flow_of_overlaps(patterns, sources, epochs, max_patterns)
        given = given if flow is None else given.unionAll(flow)
    whole = F.when(F.col("size") > 0, F.expr("given div size")).otherwise(F.lit(0))
    asked = staged(patterns.join(given, "_key").withColumn("whole", whole).select(
        "_key", "whole", (F.col("given") - F.col("whole") * F.col("size")).alias("words")
    ), "mix-given")
    cuts = _cuts(sized, asked.where("words > 0"))
    chosen = staged(asked.join(cuts, "_key", "left").select(
        "_key", "whole", F.coalesce("cut", F.lit(0)).alias("cut")
    ), "mix-chosen")
    documents = lookup_join(sized, chosen, ["_key"]).withColumn(
        "copies", (F.col("whole") + (F.col("place") < F.col("cut")).cast("int")).cast("int")
    ).select(
        F.col("_id").alias(id_col), F.col("_source").alias(source_col), "size", "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )
    return documents, sources.select("source", "source_size", "target")
