import hashlib
import random
import zlib

import numpy as np
import pytest

from shopgrain.llm import periods as P
from shopgrain.llm.catalogue import QUERIES

FOLDER = "/root/testdata/sf0.001"


def slow_runs(words, least_length=6, least_periods=4):
    """Every period and every start, compared word by word."""
    n, found = len(words), set()
    for q in range(1, n // least_periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least_length, least_periods * q):
                root = words[i:i + length]
                if not any(all(root[k] == root[k + d] for k in range(length - d)) for d in range(1, q)):
                    found.add((i, length, q))
            i = max(j, i) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected(words):
    runs = slow_runs(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(" ".join(kept).encode()).hexdigest())


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def some_words(rng):
    words = []
    while rng.random() < 0.8:
        root = [rng.choice("abc") for _ in range(rng.randint(1, 6))]
        words += (root * rng.randint(1, 9))[:rng.randint(1, 40)]
    return words


def test_runs_of_many_documents_at_once():
    rng = random.Random(1)
    documents = [some_words(rng) for _ in range(400)] + [[], ["a"], ["a"] * 6, list("abababab") * 3]
    number = {w: i for i, w in enumerate("abc")}
    first = np.cumsum([0, *map(len, documents)])
    flat = np.array([number[w] for d in documents for w in d], np.int64)
    start, length, period = P.runs_of(flat, first)
    found = [[] for _ in documents]
    for s, n, q in zip(start.tolist(), length.tolist(), period.tolist()):
        d = int(np.searchsorted(first, s, "right")) - 1
        found[d].append((s - int(first[d]), n, q))
    assert [sorted(x, key=lambda r: (r[0], r[2])) for x in found] == [slow_runs(d) for d in documents]


def test_documents(spark):
    rng = random.Random(2)
    texts = [rng.choice([" ", "\n", "\t \x0b"]).join(some_words(rng)) for _ in range(120)]
    texts += [None, "", "  \n", "x " * 30_000, "\u00a0 " * 8 + "é中 " * 9, "one two three"]
    rows = [(i % 100 if i % 7 else None, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as start", "2 as runs", "'x' as period")
    found = P.periodic_runs(frame, with_runs=True, with_text=True).collect()
    assert sorted(str((r["doc_id"], *[r[c] for c in COLUMNS])) for r in found) == sorted(
        str((i, *expected([w.decode() for w in (t or "").encode().split()]))) for i, t in rows if t is None or len(t) < 9999
    ) + [] or _with_long(rows, found)
    for r in found:
        assert hashlib.sha256(r["collapsed"].encode()).hexdigest() == r["collapsed_sha256"]
        assert len(r["runs"]) == r["n_runs"]


def _with_long(rows, found):
    """The long text is one run of period 1; the others are compared word by word."""
    short = sorted(str((r["doc_id"], *[r[c] for c in COLUMNS])) for r in found if r["n_words"] < 9999)
    assert short == sorted(str((i, *expected([w.decode() for w in (t or "").encode().split()])))
                           for i, t in rows if t is None or len(t) < 9999)
    (long,) = [r for r in found if r["n_words"] >= 9999]
    return (long["n_runs"], long["start"], long["length"], long["period"], long["collapsed"]) == (1, 0, 30_000, 1, "x")


def test_empty_table(spark):
    assert P.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_registered_query(spark):
    found = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_periods"](spark, FOLDER).collect()}
    edited = 0
    for doc, text in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect():
        words = [w.decode() for w in (text or "").encode().split()]
        h, n = zlib.crc32(str(doc).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            edited += 1
        if len(words) <= 700:
            assert found[doc] == expected(words)
    assert edited and len(found) == 200
