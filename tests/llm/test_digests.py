import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from shopgrain.llm import digests
from shopgrain.llm.common import RollingHash

COLUMNS = "doc_id long, text string"


def slow_class(window):
    value = sum(int(digests._gain()[:c].sum()) for c in Counter(window).values())
    most = int(digests._gain().sum())
    return (most - value) * 1000 // most


def slow_features(text, ranks):
    """Windows by popularity, one text at a time, without numpy tricks."""
    n, chosen = len(text) - 63, []
    if n > 0:
        rank = [int(ranks[slow_class(text[i:i + 64])]) for i in range(n)]
        votes = Counter()
        for q in range(n - 63):
            votes[min(range(q, q + 64), key=lambda i: (rank[i], i))] += 1
        chosen = sorted(p for p, v in votes.items() if v >= 16 and rank[p] < digests.CLASSES)
    found = [text[p:p + 64] for p in chosen]
    if text and (not found or len(text) < 512):
        width = min(5, len(text))
        found += dict.fromkeys(text[i:i + width] for i in range(len(text) - width + 1))
    return found


def slow_digest(text, ranks):
    windows = slow_features(text, ranks)
    hashes = []
    for w in windows:
        if len(w) == 64:
            x = np.zeros(1, np.uint64)
            for k, part in enumerate(np.frombuffer(w, "<u8")):
                x = RollingHash.mixed(x * np.uint64(31) + part + np.uint64(k + 1))
            hashes.append(int(x[0]))
        else:
            hashes.append(int(RollingHash(7).windows(np.frombuffer(w, np.uint8), len(w))[0]))
    out = []
    for at in range(0, len(hashes), 160):
        bits = 0
        for h in hashes[at:at + 160]:
            for k in range(5):
                bits |= 1 << (h >> 11 * k & 2047)
        out.append(bits)
    return out


def slow_likeness(a, b):
    if not a or not b:
        return float(len(a) == len(b))
    ones = lambda x: sum(bin(v).count("1") for v in x)
    if len(a) > len(b) or len(a) == len(b) and ones(a) > ones(b):
        a, b = b, a
    total = 0.0
    for x in a:
        best = 0.0
        for y in b:
            nx, ny = bin(x).count("1"), bin(y).count("1")
            most, chance = min(nx, ny), nx * ny / 2048
            least = chance + 0.3 * (most - chance)
            best = max(best, (bin(x & y).count("1") - least) / max(most - least, 1e-9))
        total += min(max(best, 0.0), 1.0)
    return total / len(a)


def as_bits(raw):
    out = []
    for at in range(0, len(raw), 256):
        marks = np.unpackbits(np.frombuffer(raw[at:at + 256], np.uint8))
        out.append(sum(1 << int(i) for i in np.flatnonzero(marks)))
    return out


def slow(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""), reverse=True)
    texts = [t or "" for _, t in rows]
    counts = np.zeros(1001, np.int64)
    for t in texts:
        raw = t.encode()
        for i in range(len(raw) - 63):
            counts[slow_class(raw[i:i + 64])] += 1
    ranks = digests.rarity_ranks(counts)
    made = [slow_digest(t.encode(), ranks) for t in texts]
    out = []
    for i, (doc, _) in enumerate(rows):
        text, after = texts[i], texts[(i + 1) % len(texts)]
        n = len(text)
        new = text[:n - n // 3] + after[:n // 3]
        changed = slow_digest(new.encode(), ranks)
        out.append((doc, n, hashlib.sha256(new.encode()).hexdigest(), made[i], changed,
                    slow_likeness(made[i], changed), slow_likeness(made[i], made[(i + 1) % len(made)])))
    return out


def sample(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        kind = rng.random()
        letters = "abcdefghij é中 " if kind < 0.8 else "ab"
        out.append((i * 7, "".join(rng.choices(letters, k=rng.choice([0, 3, 20, 63, 64, 130, 600, 900])))))
    out += [(10_000, "a" * 300), (10_001, None), (10_002, out[3][1]), (10_003, out[5][1][:-9] + "changed")]
    return out


def checked(spark, rows, parts):
    frame = spark.createDataFrame(rows, COLUMNS).repartition(parts).selectExpr("*", "'x' as uid", "1 as n_chars")
    found = digests.fingerprints(frame).collect()
    assert len(found) == len(rows)
    key = lambda r: (str(r[0]), r[1], r[2])
    got = sorted(
        ((r["doc_id"], r["n_chars"], r["edited_sha256"], as_bits(r["fingerprint"]),
          as_bits(r["edited_fingerprint"]), r["near_edited"], r["near_next"]) for r in found), key=key,
    )
    expected = sorted(slow(rows), key=key)
    for a, b in zip(got, expected):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:])


def test_against_slow_version(spark):
    checked(spark, sample(1, 40), 5)


def test_repeated_and_null_ids(spark):
    rows = sample(2, 8)
    checked(spark, rows + [(None, "one"), (None, "two" * 50), (7, rows[4][1]), (7, rows[4][1])], 3)


def test_one_row_and_none(spark):
    checked(spark, [(1, "just one text " * 30)], 1)
    assert digests.fingerprints(spark.createDataFrame([], COLUMNS)).collect() == []


def test_short_texts_tell_how_much_is_left():
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(400)]
    for size in (6, 12, 20, 40, 90):
        one, two, three = (" ".join(rng.choices(words, k=size)).encode() for _ in range(3))
        new = digests.edited(one, two)
        ranks = digests.rarity_ranks(np.bincount(digests.entropy_classes(
            np.frombuffer(one + two + three, np.uint8)), minlength=1001))
        made = [digests.Digests.of(*digests._buffer([t]), ranks) for t in (one, new, three)]
        assert digests.likeness(made[0], 0, made[1], 0) > 0.25
        assert digests.likeness(made[0], 0, made[2], 0) < 0.1


def test_long_text_has_chained_filters():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 123, 60_000).astype(np.uint8)
    ranks = digests.rarity_ranks(np.bincount(digests.entropy_classes(data), minlength=1001))
    offsets = np.array([0, 30_000, 60_000])
    found = digests.Digests.of(data, offsets, ranks)
    assert found.first[1] > 1
    assert digests.likeness(found, 0, found, 0) == pytest.approx(1.0)
    assert digests.likeness(found, 0, found, 1) < 0.2
    half = np.concatenate([data[:15_000], data[40_000:55_000]])
    other = digests.Digests.of(half, np.array([0, 30_000]), ranks)
    assert digests.likeness(found, 0, other, 0) > 0.3


def test_entropy_classes():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 6, 70_000).astype(np.uint8)
    got = digests.entropy_classes(data)
    for p in [0, 1, 500, *range(65_500, 65_600)]:
        counts = Counter(data[p:p + 64].tolist()).values()
        entropy = -sum(c / 64 * math.log2(c / 64) for c in counts)
        assert got[p] == pytest.approx(entropy / 6 * 1000, abs=1.1)
