import random
import zlib
from fractions import Fraction
from functools import cache

import numpy as np
import pytest
from tokenizers import Tokenizer

from shopgrain.llm import packing as K
from shopgrain.llm.bytelevel import ByteLevelIds, parts_of
from shopgrain.llm.catalogue import QUERIES, byte_tokenizer

DDL = "doc_id long, text string, source string"
FOLDER = "/root/testdata/sf0.001"


@cache
def library():
    return Tokenizer.from_buffer(byte_tokenizer())


def library_ids(text):
    return library().encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_librarys(monkeypatch):
    from shopgrain.llm import bytelevel

    rng, encoder = random.Random(1), ByteLevelIds(byte_tokenizer())
    parts = list("ab é中😀\n\t \u3000\x1c1.'!") + ["'re", "  ", " \n", "word", " the", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(2000)] + [" " * 300_000, "x" * 200_000]
    expected = [library_ids(text) for text in texts]
    assert [encoder.ids(text).tolist() for text in texts] == expected
    monkeypatch.setattr(bytelevel, "WHOLE", 7)
    assert all("".join(parts_of(text, 7)) == text for text in texts[:500])
    assert [encoder.ids(text).tolist() for text in texts[:-2]] == expected[:-2]


def slow_windows(totals, weights, size):
    """Deficit round-robin one window after the other, in fractions, until a queue could run dry."""
    left, deficit, out = list(totals), [Fraction(0)] * len(totals), []
    total = sum(map(Fraction, weights))
    quantum = [Fraction(size) * Fraction(w) / total for w in weights]
    carried = [Fraction(0)] * len(totals)
    while all(n > q for n, q in zip(left, quantum)):
        carried = [c + q for c, q in zip(carried, quantum)]
        given = [t - n for t, n in zip(totals, left)]
        serve = [int(c) - g for c, g in zip(carried, given)]
        deficit = [c - int(c) for c in carried]
        spare = size - sum(serve)
        for j in sorted(range(len(left)), key=lambda j: (-deficit[j], j))[:spare]:
            serve[j] += 1
        left = [n - s for n, s in zip(left, serve)]
        out.append(serve)
    return out


@pytest.mark.parametrize("weights", [[1, 1, 2], [5, 3, 8], [16, 16, 32]])
def test_windows_equal_round_robin_by_steps(weights):
    totals = [w * 997 for w in weights]
    (phase, *_) = K.plan(totals, weights, 64)
    steps = slow_windows(totals, weights, 64)
    upto = phase.upto(np.arange(phase.windows + 1))
    mine = np.diff(upto, axis=0).tolist()
    assert mine == steps[:len(mine)] and len(mine) >= len(steps) - 2


@pytest.mark.parametrize("seed", range(12))
def test_every_token_lies_in_one_place(seed):
    rng = random.Random(seed)
    queues, size = rng.randint(1, 5), rng.choice([16, 64])
    lengths = [[rng.randint(1, rng.choice([3, 40, 400])) for _ in range(rng.randint(0, 30))] for _ in range(queues)]
    totals = [sum(x) for x in lengths]
    weights = [max(t, sum(totals) / 16) for t in totals] if seed % 2 else [rng.randint(1, 3) for _ in totals]
    phases = K.plan(totals, weights, size)
    queue = np.array([j for j, x in enumerate(lengths) for _ in x], np.int64)
    length = np.array([n for x in lengths for n in x], np.int64)
    place = np.array([sum(x[:i]) for x in lengths for i in range(len(x))], np.int64)
    seen, cells = {}, {}
    for rows in K.pieces_of(phases, queue, place, length):
        for row, start, n, sequence, offset in zip(*(x.tolist() for x in rows)):
            seen.setdefault(row, []).append((start, n))
            cells.setdefault(sequence, []).append((offset, n))
    for row, n in enumerate(length.tolist()):
        at = 0
        for start, more in sorted(seen[row]):
            assert start == at
            at += more
        assert at == n
    full = 0
    for sequence, parts in cells.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        full += at == size
        assert at <= size and at & (at - 1) == 0
    assert sorted(cells) == list(range(len(cells))) and full == sum(totals) // size


def check_pieces(rows, found, end_id=0):
    """Pieces cover each document's ids, sequences are whole, and shares hold in all full windows."""
    at, mix = {}, {}
    for r in found:
        at.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        mix.setdefault(r["sequence_id"], []).append(r)
    for doc, text, _ in rows:
        ids = library_ids(text) + [end_id]
        pieces = sorted(at[doc, len(ids)], key=lambda r: r["start"])
        place = 0
        for r in pieces:
            assert r["start"] == place
            place += r["length"]
            part = np.array(ids[r["start"]:place], "<u4")
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
        assert place == len(ids)
    for parts in mix.values():
        place = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == place
            place += r["length"]
        assert place & (place - 1) == 0
    return mix


def test_registered_query_holds_the_mix_in_every_window(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select(
        "doc_id", "text", "source").collect()]
    found = QUERIES["op11_packing"](spark, FOLDER).collect()
    mix = check_pieces(rows, found)
    total = sum(r["length"] for r in found)
    share = {}
    for r in found:
        share[r["source"]] = share.get(r["source"], 0) + r["length"] / total
    heads = {s for s, x in share.items() if x * 1024 >= 16}
    whole = [parts for parts in mix.values() if sum(r["length"] for r in parts) == 1024]
    assert len(whole) == total // 1024
    for parts in whole[:-3]:
        held = {}
        for r in parts:
            held[r["source"]] = held.get(r["source"], 0) + r["length"]
        if len(heads) == len(share):
            assert all(abs(held.get(s, 0) - 1024 * share[s]) < 2 for s in heads)


def test_many_small_sources_nulls_and_repeats(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["word", "a", "été"], k=rng.randint(0, 30))), f"s{i % 90}") for i in range(300)]
    rows += [(i, "hot " * 20, "hot") for i in range(300, 400)] + [(401, None, None), (402, "", None), (403, " " * 3000, "hot")]
    frame = spark.createDataFrame(rows, DDL).selectExpr("*", "1 as n", "2 as queue", "'x' as ids", "3 as offset")
    found = K.pack(frame, byte_tokenizer(), size=128, least=16, with_ids=True).collect()
    check_pieces(rows, found)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in found)
    again = [(1, "same text", "a"), (1, "same text", "a"), (None, "b", "a"), (None, None, "b")]
    found = K.pack(spark.createDataFrame(again, DDL), byte_tokenizer(), size=8, least=1).collect()
    assert sum(r["length"] for r in found) == sum(len(library_ids(t)) + 1 for _, t, _ in again)
    texts = K.pack(spark.createDataFrame([("x", "b", "s"), ("y", "c", "s")], "doc_id string, text string, source string"),
                   byte_tokenizer(), size=8, least=1).collect()
    assert {r["doc_id"] for r in texts} == {"x", "y"}


def test_given_weights_hold_until_a_source_runs_dry(spark):
    rows = [(i, "word " * 30, "ab"[i % 2]) for i in range(200)]
    found = K.pack(spark.createDataFrame(rows, DDL), byte_tokenizer(), size=64, weights={"a": 3.0, "b": 1.0}).collect()
    mix = check_pieces(rows, found)
    first = [sum(r["length"] for r in mix[k] if r["source"] == "a") for k in range(20)]
    assert all(47 <= n <= 49 for n in first)
    with pytest.raises(ValueError):
        K.pack(spark.createDataFrame(rows, DDL), byte_tokenizer(), size=64, weights={"a": 0.01, "b": 1.0})


def test_empty_table(spark):
    assert K.pack(spark.createDataFrame([], DDL), byte_tokenizer()).collect() == []
