"""Registered queries on the smallest data set, against SQL or against brute force."""

import hashlib
import re
import zlib

import duckdb
import pytest
import sentencepiece

from oracle import compare, connect
from shopgrain.llm.catalogue import ORACLES, QUERIES, piece_model
from test_simhash import slow_fingerprint, slow_groups

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select(
        "doc_id", "text", "source").collect()]


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) == ""


def test_calls_match_sql_with_faulty_turns(spark, tmp_path):
    """Repeated, missing and odd turns, against the registered SQL."""
    said = [
        (1, 0, "system", "be \"brief\"\n\tor \\ not"), (1, 1, "user", "a"), (1, 2, "assistant", "b é"),
        (1, 3, "user", "c"), (1, 5, "user", "d"), (1, 6, "assistant", "e"), (1, 6, "assistant", "f"),
        (2, 0, "user", "x" * 401), (2, 2, "user", ""), (2, 4, "user", None), (2, 5, "assistant", None),
        (2, 9, "assistant", "no call"), (3, 4, "user", "late"), (3, 6, None, "no role"), (3, 6, "user", "both"),
    ]
    frame = spark.createDataFrame(said, "conv_id long, turn long, role string, text string")
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    connection = duckdb.connect()
    connection.execute(f"create view conversations as from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert compare(QUERIES["op5_tool_calls"](spark, str(tmp_path)), connection, ORACLES["op5_tool_calls"]) == ""


def test_edited_texts(spark, documents):
    found = {r["doc_id"]: r for r in QUERIES["op2_digests"](spark, FOLDER).collect()}
    rows = sorted(documents, reverse=True)
    assert set(found) == {r[0] for r in rows}
    by_text = {}
    for i, (doc, text, _) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        new = text[:len(text) - len(text) // 3] + after[:len(text) // 3]
        row = found[doc]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
        assert by_text.setdefault(text, row["fingerprint"]) == row["fingerprint"]
        by_text.setdefault(new, row["edited_fingerprint"])


def test_simhash(spark, documents):
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op3_simhash"](spark, FOLDER).collect()}
    values = [(doc, slow_fingerprint(text)) for doc, text, _ in documents]
    groups = slow_groups(values)
    assert found == {doc: (f"{fp:016x}", groups[doc]) for doc, fp in values}


@pytest.mark.parametrize("name, limit", [("op4_line_quality", 0.7), ("op7_toxicity", 0.3)])
def test_scores(spark, documents, name, limit):
    found = QUERIES[name](spark, FOLDER).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(d for d, *_ in documents)
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= limit)


def test_mixing(spark, documents):
    found = {r["doc_id"]: r for r in QUERIES["op8_mixing"](spark, FOLDER).collect()}
    sizes = {d: len(re.findall("[^\\x20\\x09-\\x0D]+", t or "")) for d, t, _ in documents}
    assert {d: r["size"] for d, r in found.items()} == sizes
    for source in {s for *_, s in documents}:
        mine = [found[d] for d, _, s in documents if s == source]
        assert {r["source_size"] for r in mine} == {sum(r["size"] for r in mine)}
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= max(r["size"] for r in mine)


def test_pieces(spark, documents):
    library = sentencepiece.SentencePieceProcessor(model_proto=piece_model())
    found = {r["doc_id"]: r for r in QUERIES["op9_pieces"](spark, FOLDER).collect()}
    for doc, text, _ in documents:
        ids = library.encode(text)
        assert found[doc]["n_tokens"] == len(ids)
        assert found[doc]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[doc]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
