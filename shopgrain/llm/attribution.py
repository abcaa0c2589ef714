"""Token counts of sections, from one encoding of the whole document.

A document is encoded once; the byte lengths of its tokens give every token's span. Spans are
joined with the sections' spans in order, and a token across a boundary is allocated by a rule:

* `start`: to the section that holds its first byte;
* `most`: to the section that holds most of its bytes, the first of them in a tie;
* `share`: to each section in proportion to its bytes.

Sections lie side by side in order; bytes outside all of them belong to none.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import text_steps

RULES = ("start", "most", "share")
# Characters the library encodes at once.
WHOLE = 50_000


def token_bytes(ranks_file: bytes) -> dict[bytes, int]:
    """Tokens and ids of a rank file: a base64 token and its id on each line."""
    rows = (line.split() for line in ranks_file.splitlines() if line)
    return {base64.b64decode(token): int(number) for token, number in rows}


class Encoder:
    """Byte-level encoding whose tokens' bytes add up to the text's."""

    def __init__(self, ranks_file: bytes, pattern: str):
        ranks = token_bytes(ranks_file)
        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding(
            "given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, number in ranks.items():
            self.length[number] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """Where each token ends, in bytes.

        Long texts are cut by the pattern first and each piece is encoded by itself, as the
        library does; its own pattern engine has no room for a long run of one class.
        """
        if len(text) <= WHOLE:
            ids = self.encoding.encode_ordinary(text)
        else:
            ids = [
                i for piece in self.pattern.finditer(text)
                for i in self.encoding._encode_single_piece(piece.group())
            ]
        return np.cumsum(self.length[np.asarray(ids, np.int64)])


def allocate(
    ends: np.ndarray, starts: np.ndarray, stops: np.ndarray, rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing tokens) of each section.

    A token is crossing for every section it lies in with a part only.
    """
    n = len(starts)
    tokens, crossing = np.zeros(n), np.zeros(n, np.int64)
    if not n or not len(ends):
        return tokens, crossing
    begins = np.concatenate([[0], ends[:-1]])
    low = np.searchsorted(stops, begins, "right")  # first section that ends behind the token's start
    high = np.searchsorted(starts, ends, "left")  # first section that starts behind its end
    count = np.maximum(high - low, 0)
    token = np.repeat(np.arange(len(ends)), count)
    base = np.cumsum(count) - count
    section = np.arange(len(token)) - base[token] + low[token]
    overlap = np.minimum(ends[token], stops[section]) - np.maximum(begins[token], starts[section])
    token, section, overlap = token[overlap > 0], section[overlap > 0], overlap[overlap > 0]
    size = (ends - begins)[token]
    np.add.at(crossing, section[overlap < size], 1)
    if rule == "share":
        np.add.at(tokens, section, overlap / size)
    elif rule == "start":
        chosen = starts[section] <= begins[token]
        np.add.at(tokens, section[chosen], 1)
    else:
        order = np.lexsort((section, -overlap, token))
        first = np.ones(len(order), bool)
        first[1:] = token[order][1:] != token[order][:-1]
        np.add.at(tokens, section[order][first], 1)
    return tokens, crossing


def line_sections(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the lines, each with its line break; an empty text has none."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    stops = np.flatnonzero(data == 10) + 1
    if not len(stops) or stops[-1] != len(data):
        stops = np.append(stops, len(data))
    return np.concatenate([[0], stops[:-1]]), stops


def _byte_places(data: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Byte offsets of code point offsets; those beyond the text are its end."""
    heads = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    return heads[np.clip(points, 0, len(heads) - 1)]


def token_counts(
    docs: DataFrame, ranks_file: bytes, pattern: str, id_col: str = "doc_id",
    text_col: str = "text", sections_col: str | None = None, rule: str = "most",
) -> DataFrame:
    """(id, section, start, stop, n_tokens, n_crossing): a row for each section of each document.

    `sections_col` holds an array of structs (start, stop) in code points, in order and without
    overlap; without it the sections are the lines. start and stop come out in bytes, section is
    the number from 0. Null and empty texts, and null or empty arrays, give no row; sections with
    null ends count as empty. Each row is worked on by itself, so repeated rows and ids need no
    care. `ranks_file` is the rank file's content, of fixed size.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    kind = docs.schema[id_col].dataType.simpleString()
    given = F.lit(None).cast("array<struct<start:bigint,stop:bigint>>") if sections_col is None \
        else F.expr(
            f"transform(`{sections_col}`, x -> named_struct('start', cast(x.start as bigint), "
            "'stop', cast(x.stop as bigint)))"
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks_file, pattern)
        for batch in batches:
            for part, data, offsets in text_steps(batch, 0, 2 << 20):
                rows, columns = [], [[], [], [], [], []]
                for i in range(part.num_rows):
                    text = data[offsets[i]:offsets[i + 1]]
                    if sections_col is None:
                        starts, stops = line_sections(text)
                    else:
                        spans = part.column(2)[i].as_py() or []
                        points = np.array(
                            [(s["start"] or 0, max(s["stop"] or 0, s["start"] or 0)) for s in spans],
                            np.int64,
                        ).reshape(-1, 2)
                        starts, stops = _byte_places(text, points).T if len(points) else (
                            np.zeros(0, np.int64), np.zeros(0, np.int64)
                        )
                    if not len(starts) or not len(text):
                        continue
                    tokens, crossing = allocate(
                        encoder.ends(text.tobytes().decode("utf-8", "replace")), starts, stops, rule
                    )
                    rows.append(np.full(len(starts), i))
                    for column, values in zip(
                        columns, (np.arange(len(starts)), starts, stops, tokens, crossing)
                    ):
                        column.append(values)
                if not rows:
                    continue
                section, start, stop, tokens, crossing = map(np.concatenate, columns)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1).take(pa.array(np.concatenate(rows))),
                     pa.array(section.astype(np.int64)), pa.array(start.astype(np.int64)),
                     pa.array(stop.astype(np.int64)), pa.array(tokens.astype(np.float64)),
                     pa.array(crossing.astype(np.int64))],
                    names=["_id", "section", "start", "stop", "n_tokens", "n_crossing"],
                )

    out = docs.select(
        F.col(text_col).alias("_text"), F.col(id_col).alias("_id"), given.alias("_sections")
    ).mapInArrow(
        run, f"_id {kind}, section long, start long, stop long, n_tokens double, n_crossing long"
    )
    return out.withColumnRenamed("_id", id_col)
