"""SentencePiece encoding and decoding through tables of distinct chunks.

Where no piece of the model goes on past a whitespace marker, a text's pieces are those of its
marked words one after the other. Each task cuts its texts into marked words, has the library
segment each distinct one once, and joins ids and decoded bytes back by position.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
# Distinct chunks a task keeps; beyond that its table starts anew.
TABLE_ROWS = 400_000
# Longer chunks are segmented where they stand and not kept.
KEPT_CHARS = 200
ID_BYTES = array("i").itemsize

# Texts are cut with a blank in place of each marker: strings of one byte a character stay such.
_chunk = regex.compile(" *[^ ]+| +")


def splits_at_marks(processor: sentencepiece.SentencePieceProcessor) -> bool:
    """Whether every piece has markers at its front only, and the model adds one to a text's
    front and otherwise leaves texts as they are."""
    pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
    plain = processor.normalize("a  b c ") == f"{MARK}a{MARK}{MARK}b{MARK}c{MARK}"
    return plain and not any(MARK in piece.lstrip(MARK) for piece in pieces)


class ChunkTable:
    """Ids of chunks, each segmented once by the library, as bytes of 32-bit integers. For digests each
    is decoded as well; its text is kept only where it is other than the chunk's own."""

    def __init__(self, model: bytes, digests: bool = True):
        self.digests = digests
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.cut = splits_at_marks(self.processor)
        self.rows: dict[str, bytes] = {}
        self.others: dict[str, str] = {}
        self.numbers = [str(i).encode() for i in range(self.processor.get_piece_size())]

    def _row(self, text: str) -> tuple[bytes, str | None]:
        ids = self.processor.encode(text)
        decoded = self.processor.decode(ids) if self.digests else text
        return array("i", ids).tobytes(), None if decoded == text else decoded

    def _rows(self, text: str) -> tuple[list[str], list[bytes], dict[str, str]]:
        """The chunks of a text that may be cut, the ids of each, and the decoded text of those that
        decode to another and are not kept."""
        rows = self.rows
        if len(rows) > TABLE_ROWS:
            rows.clear()
            self.others.clear()
        words = _chunk.findall(" " + text.replace(MARK, " "))
        try:
            return words, [rows[word] for word in words], {}
        except KeyError:
            out, apart = [], {}
            for word in words:
                row = rows.get(word)
                if row is None:
                    if word == " ":  # a text's last space
                        row, other = array("i", [self.processor.piece_to_id(MARK)]).tobytes(), None
                    else:
                        # The library puts the first marker itself.
                        row, other = self._row(word[1:])
                    kept = len(word) <= KEPT_CHARS
                    if kept:
                        rows[word] = row
                    if other is not None:
                        (self.others if kept else apart)[word] = other
                out.append(row)
            return words, out, apart

    def encoded(self, text: str) -> tuple[bytes, str]:
        """The ids of a text and, for digests, what they decode to."""
        if not text:
            return b"", ""
        if not self.cut:
            ids, other = self._row(text)
            return ids, text if other is None else other
        words, rows, apart = self._rows(text)
        if not apart and self.others.keys().isdisjoint(words):
            return b"".join(rows), text.replace(MARK, " ")
        own = [self.others.get(word, word[1:]) for word in words]
        if apart:
            own = [apart.get(word, text) for word, text in zip(words, own)]
        return b"".join(rows), " ".join(own)

    def joined(self, ids: bytes) -> bytes:
        """The ids as numbers with commas."""
        return b",".join(map(self.numbers.__getitem__, memoryview(ids).cast("i")))

    def chunks(self, text: str) -> list[tuple[list[int], str]]:
        """Ids and text of each chunk, in order."""
        if not text:
            return []
        if not self.cut:
            return [(list(memoryview(self._row(text)[0]).cast("i")), text)]
        words, rows, _ = self._rows(text)
        return [(list(memoryview(row).cast("i")), word) for row, word in zip(rows, words)]


def _fields(frame: DataFrame, keep: list[str]) -> str:
    return ", ".join(f"`{c}` {frame.schema[c].dataType.simpleString()}" for c in keep)


def encode(
    docs: DataFrame, model: bytes, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
    with_ids: bool = True, digests: bool = False,
) -> DataFrame:
    """The columns `keep`, `n_tokens`, and `ids` and/or the digests of ids and decoded text.

    Ids are exactly the library's for the whole text, without begin or end ids. `model` is the
    model file's bytes, a fixed size. Null texts count as empty and give no ids. Every row is
    encoded by itself, so repeated rows and ids need no care.
    """
    keep = list(keep)
    extra = ", ids array<int>" * with_ids + ", ids_sha256 string, decoded_sha256 string" * digests

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model, digests)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                counts, ids, ids_sha, text_sha = [], [], [], []
                for value in part.column(0):
                    found, decoded = table.encoded(value.as_py() or "")
                    counts.append(len(found) // ID_BYTES)
                    if with_ids:
                        ids.append(found)
                    if digests:
                        ids_sha.append(hashlib.sha256(table.joined(found)).hexdigest())
                        text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
                columns = [*part.columns[1:], pa.array(counts, pa.int64())]
                names = [*keep, "n_tokens"]
                if with_ids:
                    ends = np.cumsum([0, *counts], dtype=np.int64)
                    columns.append(pa.ListArray.from_arrays(
                        pa.array(ends, pa.int32()),
                        pa.array(np.frombuffer(b"".join(ids), np.int32)),
                    ))
                    names.append("ids")
                if digests:
                    columns += [pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
                    names += ["ids_sha256", "decoded_sha256"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"{_fields(docs, keep)}, n_tokens long{extra}".lstrip(", ")
    return docs.select(F.col(text_col).alias("_text"), *keep).mapInArrow(run, schema)


def decode(
    rows: DataFrame, model: bytes, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns `keep` and `text`, the library's text for the ids; null ids give null."""
    keep = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        for batch in batches:
            texts = [
                None if (ids := x.as_py()) is None else processor.decode(ids)
                for x in batch.column(0)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(texts, pa.string())], names=[*keep, "text"]
            )

    schema = f"{_fields(rows, keep)}, text string".lstrip(", ")
    return rows.select(F.col(ids_col).alias("_ids"), *keep).mapInArrow(run, schema)
