import hashlib
import random

import pytest
import sentencepiece

from shopgrain.llm import pieces
from shopgrain.llm.catalogue import piece_model

PARTS = ["a", "b", " ", "  ", "\n", "\t", "é", "中", "😀", "▁", "<s>", "</s>", "<unk>", "<0x41>", "the",
         "ing", ".", "\x00", "\r", "ß", "﻿", "​", "ﬁ", "　", "½", "１", "▁▁", "\u0085", "ing "]


@pytest.fixture(scope="module")
def model():
    return piece_model()


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def texts(n, seed=3):
    rng = random.Random(seed)
    out = ["", " ", "  ", "▁", "a", " a ", "word " * 5000, "x" * 30000, " " * 500]
    return out + ["".join(rng.choices(PARTS, k=rng.randint(1, 25))) for _ in range(n)]


def test_model_may_be_cut(model):
    assert pieces.ChunkTable(model).cut


def test_same_ids_and_text_as_the_library(spark, model, library):
    rows = [(i, t) for i, t in enumerate(texts(1500))] + [(None, None), (3, "again"), (3, "again")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids", "2 as n_tokens")
    found = pieces.encode(frame, model, keep=("doc_id", "text"), digests=True).collect()
    assert len(found) == len(rows)
    for row in found:
        ids = library.encode(row["text"] or "")
        assert row["ids"] == ids and row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_decode(spark, model, library):
    rows = [(i, library.encode(t)) for i, t in enumerate(texts(50))] + [(-1, None)]
    frame = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    found = {r["doc_id"]: r["text"] for r in pieces.decode(frame, model).collect()}
    assert found[-1] is None
    assert all(found[i] == library.decode(ids) for i, ids in rows if ids is not None)


def test_full_table_starts_anew(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_ROWS", 20)
    table = pieces.ChunkTable(model)
    for text in texts(300, 8):
        assert [i for row in table.chunks(text) for i in row[0]] == library.encode(text)


def test_models_that_cross_markers_are_not_cut(model, library):
    table = pieces.ChunkTable(model)
    table.cut = False
    assert table.chunks("some words here")[0][0] == library.encode("some words here")


def test_empty_table(spark, model):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.encode(frame, model).collect() == []
