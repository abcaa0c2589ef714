"""Alignment of two tokenizers over the distinct texts of a corpus.

Texts are grouped by their full text, so every distinct one is tokenized and aligned once and
counts as often as it occurs. Tokens of both tokenizers that end at the same byte are linked, and
the common ends cut a text into groups. Counts of linked id pairs are summed over the corpus,
weighted by the copies of the texts, and go back to blocks of texts, each pair of a block once;
a text's measures go to the ids of all its copies by the text's SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.bytelevel import ByteLevelIds
from shopgrain.llm.common import staged, text_steps
from shopgrain.llm.pieces import MARK
from shopgrain.operators.lookup import lookup_join

MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
# Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 8 << 20
_PAIR = np.dtype([("a", "<u4"), ("b", "<u4")])


class Aligner:
    """Both tokenizers over a space and a text.

    The first is a byte-level one, given the space; the second a SentencePiece model that adds
    it. Strings of special tokens are plain text to both.
    """

    def __init__(self, file_a: bytes, model_b: bytes):
        self.a = ByteLevelIds(file_a, plain=True)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.sizes = [np.array([len(x) for x in side], np.int64)
                      for side in (self.a.token_bytes, self.bytes_b)]
        if not set(bytes([x]) for x in range(256)) <= set(self.a.token_bytes):
            raise ValueError("the first tokenizer must have every byte as a token")
        # What an id is written as: before another of its side, and at its side's end in a group;
        # padded with zero bytes.
        self.written = np.array([
            f"{i}{mark}" for side, end in ((self.a.token_bytes, "|"), (self.bytes_b, ";"))
            for mark in (",", end) for i in range(len(side))
        ], "S")
        self.written = self.written.view(np.uint8).reshape(len(self.written), -1)

    def _piece(self, number: int) -> bytes:
        if self.b.is_byte(number):
            return bytes([int(self.b.id_to_piece(number)[3:5], 16)])
        return self.b.id_to_piece(number).replace(MARK, " ").encode()

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both for each text; none for an empty one, or where a side's bytes differ."""
        out, none = [], np.zeros(0, np.int64)
        for text, ids_b in zip(texts, self.b.encode(texts, num_threads=1)):
            raw = (" " + text).encode()
            # Byte-level ids lose nothing.
            if text and b"".join(map(self.bytes_b.__getitem__, ids_b)) == raw:
                ids_a = self.a.ids(" " + text).astype(np.int64)
                out.append((ids_a, np.array(ids_b, np.int64)))
                continue
            out.append((none, none))
        return out

    def texts(self, texts: list[str]) -> list[tuple[int, int, int, str, bytes]]:
        """(tokens of the first, of the second, groups, groups_sha256, linked pairs) of each text.

        The tokens of all texts are laid end to end. Both sides end together at every text's
        end, so no group reaches over it.
        """
        tokens = self.tokens(texts)
        ids = [np.concatenate([pair[k] for pair in tokens]) for k in (0, 1)]
        # No token is without bytes, so every end belongs to one token of a side.
        ends = [np.cumsum(self.sizes[k][ids[k]]) for k in (0, 1)]
        if not len(ids[0]):
            return [(0, 0, 0, "", b"")] * len(texts)
        match = np.searchsorted(ends[1], ends[0])
        shared = ends[1][match] == ends[0]
        last = [shared, np.zeros(len(ids[1]), bool)]
        last[1][match[shared]] = True
        group = [np.cumsum(x) - x for x in last]
        pairs = np.stack([ids[k][last[k]] for k in (0, 1)], axis=1).astype("<u4")
        # Written ids in the order of groups, those of the first side ahead of the second's.
        sizes = [len(x) for x in self.sizes]
        code = np.concatenate([
            ids[0] + sizes[0] * last[0], ids[1] + sizes[1] * last[1] + 2 * sizes[0]
        ])[np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")]
        wide = self.written[code]
        filled = wide != 0
        named = wide[filled].tobytes()
        place = np.concatenate([[0], np.cumsum(filled.sum(1))])
        out = []
        first_a = token = first_group = 0
        for ids_a, ids_b in tokens:
            if not len(ids_a):
                out.append((0, 0, 0, "", b""))
                continue
            stop = token + len(ids_a) + len(ids_b)
            text = named[int(place[token]):int(place[stop]) - 1]
            token, first_a = stop, first_a + len(ids_a)
            last_group = int(group[0][first_a - 1]) + 1
            linked = pairs[first_group:last_group]
            out.append((len(ids_a), len(ids_b), len(linked), hashlib.sha256(text).hexdigest(),
                        linked.tobytes()))
            first_group = last_group
        return out


def aligned(texts: DataFrame, file_a: bytes, model_b: bytes) -> DataFrame:
    """(digest, copies, block, n_a, n_b, n_groups, groups_sha256, pairs) of distinct texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(file_a, model_b)
        held, block = BLOCK_BYTES, None
        for batch in batches:
            for part, data, offsets in text_steps(batch, 0, 2 << 20):
                raw, texts, blocks = data.tobytes(), [], []
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                    if held + b - a > BLOCK_BYTES:  # named after its first text
                        held, block = 0, part.column(1)[i].as_py()
                    held += b - a
                    blocks.append(block)
                    texts.append(raw[a:b].decode("utf-8", "replace"))
                columns = list(zip(*aligner.texts(texts)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(2), pa.array(blocks, pa.string()),
                     *[pa.array(columns[c], pa.int64()) for c in range(3)],
                     pa.array(columns[3], pa.string()), pa.array(columns[4], pa.binary())],
                    names=["digest", "copies", "block", "n_a", "n_b", "n_groups", "groups_sha256",
                           "pairs"],
                )

    return texts.select("text", "digest", "copies").mapInArrow(
        run, "digest string, copies long, block string, n_a long, n_b long, n_groups long, "
        "groups_sha256 string, pairs binary"
    )


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, a, b, weight): the linked pairs of a block, each once, with how often they occur.

    Rows of a block follow each other; it is summed up when the next begins.
    """
    held: list[tuple[np.ndarray, int]] = []
    current = None

    def out() -> pa.RecordBatch:
        pairs = np.concatenate([x for x, _ in held])
        weight = np.repeat([c for _, c in held], [len(x) for x, _ in held])
        different, at = np.unique(pairs, return_inverse=True)
        total = np.zeros(len(different), np.int64)
        np.add.at(total, at.reshape(-1), weight)
        return pa.RecordBatch.from_arrays(
            [pa.array([current] * len(different), pa.string()),
             pa.array((different >> np.uint64(32)).astype(np.int64)),
             pa.array((different & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(total)],
            names=["block", "a", "b", "weight"],
        )

    for batch in batches:
        for block, copies, pairs in zip(*[c.to_pylist() for c in batch.columns]):
            if held and block != current:
                yield out()
                held = []
            current = block
            if pairs:
                held.append((_wide(pairs), copies))
    if held:
        yield out()


def _wide(pairs: bytes) -> np.ndarray:
    """Both ids of each pair in one number."""
    found = np.frombuffer(pairs, _PAIR)
    return (found["a"].astype(np.uint64) << np.uint64(32)) | found["b"]


_MEASURED = (
    "digest string, n_a long, n_b long, n_groups long, n_links long, n_best long, "
    "count_sum long, groups_sha256 string"
)


def _measure(texts: pa.Table, counts: pa.Table) -> pa.Table:
    """The measures of a block's texts from the corpus counts of its pairs."""
    key = (counts["a"].to_numpy().astype(np.uint64) << np.uint64(32)) | counts[
        "b"].to_numpy().astype(np.uint64)
    order = np.argsort(key)
    key = key[order]
    number = counts["number"].to_numpy()[order].astype(np.int64)
    best = counts["best"].to_numpy(zero_copy_only=False)[order]
    n_links, n_best, total = [], [], []
    for pairs in texts["pairs"]:
        raw = pairs.as_py()
        at = np.searchsorted(key, _wide(raw)) if raw else np.zeros(0, np.int64)
        n_links.append(len(at))
        n_best.append(int(best[at].sum()) if len(at) else 0)
        total.append(int(number[at].sum()) if len(at) else 0)
    return pa.table({
        "digest": texts["digest"], "n_a": texts["n_a"], "n_b": texts["n_b"],
        "n_groups": texts["n_groups"], "n_links": pa.array(n_links, pa.int64()),
        "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(total, pa.int64()),
        "groups_sha256": texts["groups_sha256"],
    })


def align(
    docs: DataFrame, file_a: bytes, model_b: bytes, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs) of the alignment.

    documents: a row per row of `docs` with id, n_a and n_b (tokens), n_groups, n_links (pairs of
    tokens that end together), n_best (links whose corpus count is the highest of their second id,
    ties included), count_sum (corpus counts added up over the links) and groups_sha256. pairs: a
    row per linked id pair with a, b, number (links in the corpus) and best.

    Null and empty texts, and those whose tokens' bytes are not a space and the text, have no
    tokens: zeros and an empty groups_sha256. Null and repeated ids and rows need no care: each
    row gets its text's measures. An empty table gives no rows. The files are of fixed size.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    distinct = docs.select(text.alias("text")).groupBy("text").agg(
        F.count(F.lit(1)).alias("copies")
    ).select("text", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "copies")
    texts = staged(aligned(distinct, file_a, model_b), "alignment-texts")
    # A block's texts were written one after the other by one task; the sort keeps them together
    # also where its file is read in several parts, and summing up twice does no harm.
    blocks = staged(
        texts.select("block", "copies", "pairs").mapInArrow(
            _block_pairs, "block string, a long, b long, weight long"
        ), "alignment-blocks",
    )
    counted = staged(
        blocks.groupBy("a", "b").agg(F.sum("weight").alias("number")), "alignment-counts"
    )
    highest = counted.groupBy("b").agg(F.max("number").alias("highest"))
    # A row for each id of the second vocabulary.
    pairs = staged(
        counted.join(F.broadcast(highest), "b").select(
            "a", "b", "number", (F.col("number") == F.col("highest")).alias("best")
        ), "alignment-pairs",
    )
    wanted = lookup_join(blocks.select("block", "a", "b").distinct(), pairs, ["a", "b"],
                         key_source=blocks.select("a", "b"))
    measured = texts.drop("copies").groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(
        _measure, _MEASURED
    )
    measured = staged(measured, "alignment-measures")
    named = docs.select(
        F.col(id_col).alias("_id"), F.sha2(text.cast("binary"), 256).alias("digest")
    )
    documents = lookup_join(named, measured, ["digest"]).select(
        F.col("_id").alias(id_col), *MEASURES, "groups_sha256"
    )
    return documents, pairs
