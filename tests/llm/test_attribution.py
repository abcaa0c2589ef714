import random

import numpy as np
import pytest

from shopgrain.llm import attribution as A
from shopgrain.llm.catalogue import rank_file


@pytest.fixture(scope="module")
def encoder():
    return A.Encoder(*rank_file())


def slow(ends, sections, rule):
    tokens, crossing = [0.0] * len(sections), [0] * len(sections)
    begin = 0
    for end in ends:
        parts = [max(0, min(end, b) - max(begin, a)) for a, b in sections]
        for s, part in enumerate(parts):
            crossing[s] += 0 < part < end - begin
        if rule == "share":
            for s, part in enumerate(parts):
                tokens[s] += part / (end - begin)
        elif rule == "start":
            for s, (a, b) in enumerate(sections):
                tokens[s] += a <= begin < b
        elif max(parts, default=0) > 0:
            tokens[parts.index(max(parts))] += 1
        begin = end
    return tokens, crossing


@pytest.mark.parametrize("rule", A.RULES)
def test_allocation_against_every_pair(rule):
    rng = random.Random(4)
    for _ in range(300):
        ends = np.cumsum([rng.randint(1, 6) for _ in range(rng.randint(0, 12))]).astype(np.int64)
        length = int(ends[-1]) if len(ends) else 0
        cuts = sorted(rng.choices(range(length + 1), k=2 * rng.randint(0, 4)))
        sections = list(zip(cuts[::2], cuts[1::2]))
        starts, stops = (np.array([s[k] for s in sections], np.int64) for k in (0, 1))
        tokens, crossing = A.allocate(ends, starts, stops, rule)
        expected = slow(ends.tolist(), sections, rule)
        assert tokens.tolist() == pytest.approx(expected[0])
        assert crossing.tolist() == expected[1]


def test_spans_are_those_of_the_tokens(encoder):
    for text in ["", "hello  world\n\n", "é中😀 naïve", "x" * 5000, " " * 300, "\x00\u0085"]:
        ids = encoder.encoding.encode_ordinary(text)
        pieces = [encoder.encoding.decode_single_token_bytes(i) for i in ids]
        assert encoder.ends(text).tolist() == np.cumsum([len(p) for p in pieces]).tolist()
        assert b"".join(pieces) == text.encode()


def test_lines_of_documents(spark, encoder):
    rng = random.Random(6)
    texts = ["\n".join("".join(rng.choices("ab é中.!\t", k=rng.randint(0, 40))) for _ in range(rng.randint(1, 6)))
             for _ in range(60)] + ["", None, "\n", "a\n\n\nb", "word " * 9000]
    rows = list(enumerate(texts)) + [(None, "null id"), (4, "again"), (4, "again")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as section", "'x' as start")
    ranks, pattern = rank_file()
    for rule in A.RULES:
        found = A.token_counts(frame, ranks, pattern, rule=rule).collect()
        expected = []
        for doc, text in rows:
            raw, at = (text or "").encode(), 0
            sections = []
            for line in [x for x in raw.replace(b"\n", b"\n\x00").split(b"\x00") if x]:
                sections.append((at, at + len(line)))
                at += len(line)
            tokens, crossing = slow(encoder.ends(text or "").tolist(), sections, rule)
            expected += [(doc, s, a, b, pytest.approx(t), c)
                         for s, ((a, b), t, c) in enumerate(zip(sections, tokens, crossing))]
        assert sorted((tuple(r) for r in found), key=lambda r: (str(r[0]), r[1], r[3])) == sorted(
            expected, key=lambda r: (str(r[0]), r[1], r[3]))
        if rule != "most":
            total = sum(r["n_tokens"] for r in found)
            assert total == pytest.approx(sum(len(encoder.ends(t or "")) for _, t in rows))


def test_given_sections_in_code_points(spark, encoder):
    text = "éé title\nbody of 中中 text and more"
    rows = [(1, text, [(0, 8), (9, 20), (25, 400)]), (2, text, []), (3, text, None), (4, None, [(0, 1)]),
            (5, text, [(3, None), (4, 6)])]
    frame = spark.createDataFrame(rows, "doc_id long, text string, parts array<struct<start: int, stop: int>>")
    ranks, pattern = rank_file()
    found = {}
    for r in A.token_counts(frame, ranks, pattern, sections_col="parts", rule="share").collect():
        found.setdefault(r["doc_id"], []).append((r["start"], r["stop"], r["n_tokens"]))
    place = lambda k: len(text[:k].encode())
    spans = [(place(0), place(8)), (place(9), place(20)), (place(25), len(text.encode()))]
    tokens, _ = slow(encoder.ends(text).tolist(), spans, "share")
    assert set(found) == {1, 5}
    assert [f[:2] for f in found[1]] == spans and [f[2] for f in found[1]] == pytest.approx(tokens)
    assert found[5][0] == (place(3), place(3), 0.0)


def test_rules_and_empty_table(spark):
    ranks, pattern = rank_file()
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert A.token_counts(empty, ranks, pattern).collect() == []
    with pytest.raises(ValueError):
        A.token_counts(empty, ranks, pattern, rule="none")


def test_long_texts_are_cut_as_the_library_cuts_them(encoder, monkeypatch):
    rng = random.Random(8)
    parts = list("ab é中😀\n\t 1.'!") + ["'re", "  ", " \n", "word", " the"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(3000)]
    whole = [encoder.ends(text).tolist() for text in texts]
    monkeypatch.setattr(A, "WHOLE", 0)
    assert [encoder.ends(text).tolist() for text in texts] == whole


@pytest.mark.parametrize("run", [" ", "a", "é", "!", "\n"])
def test_runs_of_millions_of_characters(spark, encoder, run):
    text = "begin\n" + run * 2_000_000 + "\nend"
    ends = encoder.ends(text)
    assert ends[-1] == len(text.encode()) and (np.diff(ends) > 0).all()
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    ranks, pattern = rank_file()
    found = A.token_counts(frame, ranks, pattern, rule="start").collect()
    assert sum(r["n_tokens"] for r in found) == len(ends)


def test_registered_query(spark, encoder):
    from shopgrain.llm.catalogue import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    found = {}
    for r in QUERIES["op6_token_counts"](spark, folder).collect():
        found.setdefault(r["doc_id"], []).append((r["section"], r["start"], r["stop"], r["n_tokens"], r["n_crossing"]))
    for doc, text in texts:
        raw, at, sections = (text or "").encode(), 0, []
        for line in raw.splitlines(keepends=True) if raw.count(b"\n") == len(raw.splitlines()) - (not raw.endswith(b"\n")) else [
                x for x in raw.replace(b"\n", b"\n\x00").split(b"\x00") if x]:
            sections.append((at, at + len(line)))
            at += len(line)
        if len(text or "") * len(sections) > 200_000:
            continue  # the slow allocation is quadratic
        tokens, crossing = slow(encoder.ends(text or "").tolist(), sections, "most")
        assert sorted(found.get(doc, [])) == [
            (s, a, b, t, c) for s, ((a, b), t, c) in enumerate(zip(sections, tokens, crossing))]
