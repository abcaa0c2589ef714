import hashlib
import random

import sentencepiece
from tokenizers import Tokenizer

from shopgrain.llm import alignment as L
from shopgrain.llm.catalogue import QUERIES, byte_tokenizer, piece_model

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


class Slow:
    def __init__(self):
        self.a = Tokenizer.from_buffer(byte_tokenizer())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model())
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}

    def tokens(self, text):
        if not text:
            return [], []
        a = [(i, bytes(self.of[c] for c in self.a.id_to_token(i)))
             for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("\u2581", " ").encode()))
        whole = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])

    def measures(self, texts):
        """From the definition, over all texts with repeats."""
        links, shapes, counts = [], [], {}
        for text in texts:
            sides = self.tokens(text)
            ends = []
            for side in sides:
                at, out = 0, []
                for i, raw in side:
                    at += len(raw)
                    out.append((i, at))
                ends.append(out)
            common = sorted({e for _, e in ends[0]} & {e for _, e in ends[1]})
            groups, low = [], 0
            for high in common:
                groups.append("|".join(",".join(str(i) for i, e in side if low < e <= high) for side in ends))
                low = high
            second = {}
            for j, e in ends[1]:
                second.setdefault(e, []).append(j)
            mine = [(i, j) for i, e in ends[0] for j in second.get(e, [])]
            for pair in mine:
                counts[pair] = counts.get(pair, 0) + 1
            links.append(mine)
            shapes.append((len(sides[0]), len(sides[1]), len(groups),
                           hashlib.sha256(";".join(groups).encode()).hexdigest() if sides[0] else ""))
        best = {}
        for (_, j), n in counts.items():
            best[j] = max(best.get(j, 0), n)
        return [(a, b, g, len(mine), sum(counts[p] == best[p[1]] for p in mine), sum(counts[p] for p in mine), sha)
                for (a, b, g, sha), mine in zip(shapes, links)], counts, best


def test_texts_of_all_kinds(spark, monkeypatch):
    rng = random.Random(4)
    parts = list("ab cdé中😀\n\t \u3000.,!'1s\u2581\x1c") + ["  ", "   ", "word", "the", "'re", "<|endoftext|>", "</s>", "<0x41>"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 15))) for _ in range(300)]
    texts += [None, "", " ", "\u2581", "the same words here"] + ["copy of a text"] * 50 + ["long " * 3000, " " * 2000]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as digest", "2 as a", "'x' as block", "3 as n_a")
    expected, counts, best = Slow().measures(texts)
    monkeypatch.setattr(L, "BLOCK_BYTES", 300)  # many blocks
    documents, pairs = L.align(frame, byte_tokenizer(), piece_model())
    found = sorted(str((r["doc_id"], *[r[c] for c in COLUMNS])) for r in documents.collect())
    assert found == sorted(str((i, *x)) for (i, _), x in zip(rows, expected))
    assert {(r["a"], r["b"]): (r["number"], r["best"]) for r in pairs.collect()} == {
        p: (n, n == best[p[1]]) for p, n in counts.items()}


def test_empty_table(spark):
    documents, pairs = L.align(spark.createDataFrame([], "doc_id long, text string"), byte_tokenizer(), piece_model())
    assert documents.collect() == [] and pairs.collect() == []


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    expected, _, _ = Slow().measures([t for _, t in rows])
    found = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_alignment"](spark, FOLDER).collect()}
    assert found == {doc: x for (doc, _), x in zip(rows, expected)}
