import hashlib
import random

import numpy as np
import pytest

from shopgrain.llm import substrings
from shopgrain.llm.common import RollingHash


def slow(rows, width):
    """{(id, text): [(spans)]} by looking at every string of `width` bytes."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    seen, out = set(), []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - width + 1):
            piece = raw[p:p + width]
            if piece in seen:
                gone[p:p + width] = b"\x01" * width
            seen.add(piece)
        spans, p = [], 0
        while p < len(raw):
            if gone[p]:
                stop = p
                while stop < len(raw) and gone[stop]:
                    stop += 1
                spans.append((p, stop))
                p = stop
            else:
                p += 1
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc, len(raw), tuple(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(frame):
    return sorted(
        (
            (r["doc_id"], r["n_bytes"], tuple((s["start"], s["stop"]) for s in r["spans"]),
             hashlib.sha256(bytes(r["kept"])).hexdigest())
            for r in frame.collect()
        ),
        key=str,
    )


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeéß ", k=rng.randint(2, 9)))
    text = lambda k: "".join(word() for _ in range(k))
    shared = [text(rng.randint(5, 60)) for _ in range(6)] + ["ab" * 120, "z" * 400, text(9)[:45]]
    rows = []
    for i in range(n):
        parts = [text(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            piece = rng.choice(shared)
            cut = rng.randint(0, max(len(piece) - 5, 0) // 2)
            parts += [piece[cut:], text(rng.randint(0, 12))]
        rows.append((i * 3, "".join(parts)))
    rows += [(1000, rows[3][1]), (1001, rows[3][1]), (1002, ""), (1003, None), (1004, "short")]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_every_string(spark, seed):
    rows = corpus(seed)
    random.Random(seed).shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    frame = frame.selectExpr("*", "1 as uid", "'x' as spans", "'y' as kept")
    expected = slow(rows, 100)
    assert rows_of(substrings.without_repeats(frame)) == expected
    # Every lead that more than 3 suffixes share is dealt by window.
    assert rows_of(substrings.without_repeats(frame, run_rows=3)) == expected


def test_other_widths(spark):
    rows = corpus(5, 30)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for width, lead in ((50, 20), (64, 1), (30, 30)):
        assert rows_of(substrings.without_repeats(frame, width=width, lead=lead)) == slow(rows, width)


def test_repeated_and_null_ids(spark):
    long = "".join(random.Random(0).choices("abcdefgh", k=300))
    rows = [(7, long), (7, long), (None, long), (2, long[50:260]), (7, long[::-1]), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(substrings.without_repeats(frame)) == slow(rows, 100)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.without_repeats(frame).collect() == []


def test_whole_characters(spark):
    shared = "é" * 70
    rows = [(1, "x" + shared), (2, "è" + shared[:60] + "y"), (3, "日本" * 60), (4, "本日" * 60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for row in substrings.without_repeats(frame, whole_characters=True).collect():
        kept = bytes(row["kept"]).decode()
        assert kept == "" or set(kept) <= set("".join(t for _, t in rows))


def test_suffix_choice_depends_on_the_window_only():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 200_000).astype(np.uint8)
    offsets = np.array([0, 10, 10, 109, 209, 70_000, 140_500, 200_000])
    rolling = RollingHash()
    text, at, first, last, _ = substrings.sampled_suffixes(data, offsets, 100, 36, rolling)
    hashed = rolling.windows(data, 36) & ~np.uint64(0xFFFF)
    seen = 0
    for t, x, a, b in zip(text, at, first, last):
        assert offsets[t] <= a and b + 100 <= offsets[t + 1]
        for p in {a, b, (a + b) // 2}:
            assert x == p + int(np.argmin(hashed[p:p + 65]))
        seen += b - a + 1
    assert seen == sum(max(n - 99, 0) for n in np.diff(offsets))
