"""The pipeline's stages against plain versions of their decisions."""

import hashlib
import random

import pytest
import sentencepiece

import corpus_pipeline as P
from shopgrain.llm import recurrent
from shopgrain.llm.catalogue import piece_model
from test_simhash import slow_fingerprint, slow_groups
from test_substrings import slow

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def texts(frame):
    return sorted((tuple(r) for r in frame.select(*P.COLUMNS).collect()), key=str)


def make(spark, rows):
    frame = spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in rows], SCHEMA)
    return frame.selectExpr("*", "1 as uid", "'x' as score", "2 as copies")


def corpus():
    rng = random.Random(3)
    text = lambda k: " ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(k))
    passage = text(60)
    rows = [(i, text(rng.randint(5, 80)), rng.choice(["a", "b", None])) for i in range(40)]
    rows += [(100 + i, text(10) + passage + text(10), "b") for i in range(4)]
    rows += [(200, rows[3][1], "a"), (201, rows[3][1], "a"), (201, rows[3][1], "a"), (None, "no id here", "a"),
             (202, None, "a"), (203, "", "b"), (203, "same id, other text", "b")]
    return rows


def test_names_and_order():
    assert [name for name, _ in P.STAGES] == ["toxicity", "simhash", "substrings", "mixing", "pieces"]


def test_toxic_documents_go(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = recurrent.trained(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    bad = {r["doc_id"] for r in recurrent.score(docs, model).where("score >= 0.3").collect()}
    kept = P.toxicity(spark, docs, FOLDER)
    assert kept.columns == list(P.COLUMNS)
    assert texts(kept) == [r for r in texts(docs) if r[0] not in bad]


def test_one_document_of_each_group_stays(spark):
    rows = corpus()
    kept = texts(P.near_duplicates(spark, make(spark, rows), FOLDER))
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or ""))
    groups = slow_groups([(i, slow_fingerprint(t)) for i, (_, t, _) in enumerate(ordered)])
    expected = [(d, t, "en", s, len(t or "")) for i, (d, t, s) in enumerate(ordered) if groups[i] == i]
    assert kept == sorted(expected, key=str)


def test_repeated_passages_are_cut(spark):
    rows = corpus()
    kept = P.substring_dedup(spark, make(spark, rows), FOLDER)
    assert kept.columns == list(P.COLUMNS)
    # All of these texts are ASCII: whole characters are bytes.
    gone = slow([(d, t) for d, t, _ in rows], 100)
    assert sorted(r["n_chars"] for r in kept.collect()) == sorted(
        size - sum(b - a for a, b in spans) for _, size, spans, _ in gone
    )
    assert all(r["n_chars"] == len(r["text"]) for r in kept.collect())


def test_mixture_repeats_rows(spark):
    rows = corpus()
    kept = P.mixture(spark, make(spark, rows), FOLDER).collect()
    words = {}
    for r in kept:
        words[r["source"]] = words.get(r["source"], 0) + len((r["text"] or "").split())
    total = sum(len((t or "").split()) for _, t, _ in rows)
    assert abs(sum(words.values()) - total) <= 3 * 80
    assert all(kept.count(r) <= 3 * sum(1 for d, t, s in rows if (d, t, s) == (r[0], r[1], r[3])) for r in kept)


def test_whole_run(spark):
    library = sentencepiece.SentencePieceProcessor(model_proto=piece_model())
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).persist()
    expected = sorted((r["doc_id"], library.encode(r["text"])) for r in docs.collect())
    found = P.run(spark, FOLDER).collect()
    assert sorted((r["doc_id"], r["ids"]) for r in found) == expected


def test_texts_are_encoded_and_decoded(spark):
    library = sentencepiece.SentencePieceProcessor(model_proto=piece_model())
    rows = [(1, "two  words ", "a"), (1, "zürich 北京 😀 a▁b", "b"), (None, None, "a"), (3, "", None), (4, " \n\t x" * 50, "a")]
    found = P.encoding(spark, make(spark, rows), FOLDER).collect()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    expected = []
    for doc, text, source in rows:
        ids = library.encode(text or "")
        expected.append((doc, source, len(ids), ids, sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_empty_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.collect() == []
    with pytest.raises(KeyError):
        dict(P.STAGES)["other"]
