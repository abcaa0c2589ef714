import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from shopgrain.llm import simhash
from shopgrain.llm.common import components


def slow_fingerprint(text, shingle=3):
    raw = bytearray((text or "").encode())
    for i, b in enumerate(raw):
        if 65 <= b <= 90:
            raw[i] = b + 32
    words, word = [], b""
    for b in bytes(raw) + b" ":
        if b == 32 or 9 <= b <= 13:
            if word:
                words.append(word)
            word = b""
        else:
            word += bytes([b])
    if not words:
        return 0
    grams = [b" ".join(words[i:i + shingle]) for i in range(max(len(words) - shingle + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(fingerprints, distance=2):
    """{id: smallest id reachable}"""
    least = {i: i for i, _ in fingerprints}
    changed = True
    while changed:
        changed = False
        for i, a in fingerprints:
            for j, b in fingerprints:
                if bin(a ^ b).count("1") <= distance and least[j] < least[i]:
                    least[i], changed = least[j], True
    return least


def test_fingerprint_of_odd_texts(spark):
    rng = random.Random(1)
    texts = [None, "", " \t\n", "One", "ONE two", "a b c", "É É é é", "x\x1cy\x85z w",
             " ".join(rng.choice("abcdef") for _ in range(9000))]
    for text in texts:
        assert simhash.simhash(text, 3) == slow_fingerprint(text)
    h = spark.range(1).select(F.xxhash64(F.lit("one two three"))).first()[0]
    assert h % 2 ** 64 == xxhash.xxh64_intdigest(b"one two three", 42)


def crowded(rng, n):
    """Fingerprints in chains and clusters, so that distances of 1 to 4 are frequent."""
    out = [rng.getrandbits(64) for _ in range(n // 4)]
    while len(out) < n:
        value = rng.choice(out)
        for _ in range(rng.randint(1, 3)):
            value ^= 1 << rng.randrange(64)
        out.append(value)
    return out


def test_groups_match_all_pairs(spark):
    rng = random.Random(7)
    values = sorted(set(crowded(rng, 600)))
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    for pairwise in (simhash.PAIRWISE, 2):  # 2: nearly every bucket is connected through values
        found = {r["node"]: r["root"] for r in simhash.linked(frame, 2, pairwise).collect()}
        expected = slow_groups([(s, s % 2 ** 64) for s in signed])
        assert {s: found.get(s, s) for s in signed} == expected


def test_larger_distance(spark):
    rng = random.Random(3)
    signed = sorted({int(np.uint64(v).astype(np.int64)) for v in crowded(rng, 200)})
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {r["node"]: r["root"] for r in simhash.linked(frame, 3).collect()}
    expected = slow_groups([(s, s % 2 ** 64) for s in signed], 3)
    assert {s: found.get(s, s) for s in signed} == expected


def test_thresholds_add_up_and_cover_all_bits():
    rng = np.random.default_rng(0)
    octets = rng.integers(0, 50, (8, 256))
    for rows in (10, 10 ** 5, 10 ** 9):
        parts = simhash.allocate(list(range(64)), octets, rows, 2)
        assert sorted(b for p in parts for b in p.bits) == list(range(64))
        assert sum(p.threshold for p in parts) == 2 - len(parts) + 1


def test_documents_with_nulls_ties_and_clashing_columns(spark):
    text = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(5, text, "a"), (5, text, "b"), (3, text.upper(), None), (None, text, "c"),
            (9, None, "d"), (8, "", "e"), (7, "something else entirely here", "f"), (None, "lone one", "g")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumn(
        "component_id", F.lit("x")
    )
    found = sorted(
        (tuple(r) for r in simhash.near_duplicates(frame).collect()), key=lambda r: (str(r[0]), str(r[2]))
    )
    by = {}
    for doc, fp, root in found:
        by.setdefault(doc, []).append(root)
    assert len(found) == len(rows)
    assert by[5] == [3, 3] and by[3] == [3] and by[9] == [8] and by[8] == [8] and by[7] == [7]
    assert sorted(by[None], key=str) == [3, None]
    assert simhash.near_duplicates(frame.limit(0)).collect() == []


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)]
    edges += [(rng.randrange(5000, 5400), rng.randrange(5000, 5400)) for _ in range(250)]
    rng.shuffle(edges)
    least = {}

    def find(x):
        while least.setdefault(x, x) != x:
            x = least[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        least[max(x, y)] = min(x, y)
    frame = spark.createDataFrame(edges, "a long, b long").repartition(16)
    found = {r["node"]: r["root"] for r in components(frame).collect()}
    assert found == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def test_distance_of_one_in_full_buckets(spark):
    rng = random.Random(11)
    signed = sorted({int(np.uint64(v).astype(np.int64)) for v in crowded(rng, 300)})
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {r["node"]: r["root"] for r in simhash.linked(frame, 1, 2).collect()}
    assert {s: found.get(s, s) for s in signed} == slow_groups([(s, s % 2 ** 64) for s in signed], 1)
