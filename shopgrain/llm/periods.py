"""Periodic runs of words, found with a dictionary of basic factors.

A factor is a stretch of 2**k words. Factors of a document that are equal share a name: those of
one word by the word, those of twice the length by the names of their halves. A factor whose next
occurrence starts within its own length lies with it in a stretch of twice that length, which
proposes their distance as a period; positions side by side with the same distance are one
arithmetic progression. A run of period q that is at least four periods long is found whole at the
smallest length that reaches q: there the next occurrence of a factor inside the run is q words on
and no nearer, as the run's root is no power of a shorter one. So the progression's end gives the
run's end, and every run appears at one length only.

Factors that occur once in their document lie in no run and are dropped from the longer lengths, so
the work is on what repeats.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import text_steps

# Runs are found where they hold this many periods; fewer would not be whole at one length.
LEAST_PERIODS = 4


def _names(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that puts equal keys together, the name of each key in that order, and how many
    share it."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    starts = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    sizes = np.diff(np.append(starts, len(ranked)))
    return order, np.repeat(np.arange(len(starts)), sizes), np.repeat(sizes, sizes)


def runs_of(
    words: np.ndarray, first: np.ndarray, least_length: int = 6, least_periods: int = LEAST_PERIODS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs of all documents, by start and period.

    `words` are the word numbers of the documents one after the other, below 2**31 different
    ones, and `first` (n + 1) says where each begins. Starts are counted over all words.
    """
    least_periods = max(least_periods, LEAST_PERIODS)
    sizes = np.diff(first)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if not len(words):
        return (np.zeros(0, np.int64),) * 3
    document = np.repeat(np.arange(len(sizes)), sizes)
    ends = first[1:][document]
    keys = document.astype(np.int64) * (int(words.max()) + 1) + words
    places = np.arange(len(words))
    length = 1
    while len(places):
        order, name, shared = _names(keys)
        ranked = places[order]
        # The distance to the next occurrence of the same factor; 0 without one.
        ahead = np.zeros(len(places), np.int64)
        same = name[1:] == name[:-1]
        ahead[order[:-1][same]] = (ranked[1:] - ranked[:-1])[same]
        near = np.flatnonzero((2 * ahead > length) & (ahead <= length))
        if len(near):
            at, period = places[near], ahead[near]
            fresh = np.append(True, (np.diff(at) != 1) | (np.diff(period) != 0))
            begin = np.flatnonzero(fresh)
            end = np.append(begin[1:], len(at)) - 1
            start, period = at[begin], period[begin]
            long = at[end] + period + length - start
            good = long >= np.maximum(least_length, least_periods * period)
            found.append((start[good], long[good], period[good]))
        # Factors of twice the length, from those that repeat and do not pass the document's end.
        dense = np.full(len(words), -1, np.int64)
        repeated = shared > 1
        dense[ranked[repeated]] = name[repeated]
        places = places[np.sort(order[repeated])]
        places = places[places + 2 * length <= ends[places]]
        places = places[dense[places + length] >= 0]
        keys = dense[places] * len(words) + dense[places + length]
        length *= 2
    start, long, period = map(np.concatenate, zip(*found)) if found else (
        np.zeros(0, np.int64),) * 3
    order = np.lexsort((period, start))
    return start[order], long[order], period[order]


def greatest(length: np.ndarray, period: np.ndarray) -> int:
    """The run of greatest length / period, the first of several; compared as whole numbers."""
    best = 0
    for i in range(1, len(length)):
        if int(length[i]) * int(period[best]) > int(length[best]) * int(period[i]):
            best = i
    return best


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6,
    least_periods: int = LEAST_PERIODS, with_runs: bool = False, with_text: bool = False,
) -> DataFrame:
    """A row per document: id, n_words, n_runs, start, length, period, exponent_milli, runs_sha256
    and collapsed_sha256; with `with_runs` also `runs`, with `with_text` also `collapsed`.

    A run is a stretch of words, of smallest period q and at least `least_length` words and
    `least_periods` (4 or more) periods, that cannot be extended. start, length, period and
    exponent_milli are those of the run of greatest length / period (ties: smallest start, then
    period), null without runs. The collapsed text holds the words that no run has behind its first
    period, joined by a space. Words are separated by space and \\x09 to \\x0D. A null or empty text
    has no words and an empty collapsed text. Each row is worked on by itself, so null and repeated
    ids need no care; an empty table gives no rows. A task holds about 8 MB of text, or one text.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    more = ", runs array<struct<start:bigint,length:bigint,period:bigint>>" * with_runs
    more += ", collapsed string" * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_steps(batch, 0):
                yield _found(part, data.tobytes(), offsets)

    def _found(part: pa.RecordBatch, raw: bytes, offsets: np.ndarray) -> pa.RecordBatch:
        split = [raw[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        first = np.zeros(len(split) + 1, np.int64)
        np.cumsum([len(words) for words in split], out=first[1:])
        number: dict[bytes, int] = defaultdict(count().__next__)
        ids = np.fromiter(
            (number[word] for words in split for word in words), np.int64, int(first[-1])
        )
        start, length, period = runs_of(ids, first, least_length, least_periods)
        cut = np.searchsorted(start, first)
        rows: list[tuple] = []
        for i, words in enumerate(split):
            a, b = int(cut[i]), int(cut[i + 1])
            if a == b:
                text = b" ".join(words)
                rows.append((len(words), 0, None, None, None, None, b"", text, []))
                continue
            s, n, q = start[a:b] - first[i], length[a:b], period[a:b]
            # Words behind a run's first period are counted up and down at the stretch's ends.
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, s + q, 1)
            np.add.at(edge, s + n, -1)
            kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
            text = b" ".join([words[k] for k in kept.tolist()])
            listed = list(zip(s.tolist(), n.tolist(), q.tolist()))
            best = listed[greatest(n, q)]
            lines = "".join(f"{x},{y},{z}\n" for x, y, z in listed).encode()
            rows.append((len(words), b - a, *best, 1000 * best[1] // best[2], lines, text, listed))
        numbers = [pa.array([row[c] for row in rows], pa.int64()) for c in range(6)]
        digests = [
            pa.array([hashlib.sha256(row[c]).hexdigest() for row in rows], pa.string())
            for c in (6, 7)
        ]
        columns = [part.column(1), *numbers, *digests]
        names = ["_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli",
                 "runs_sha256", "collapsed_sha256"]
        if with_runs:
            shape = pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])
            columns.append(pa.array(
                [[dict(zip(("start", "length", "period"), x)) for x in row[8]] for row in rows],
                pa.list_(shape),
            ))
            names.append("runs")
        if with_text:
            columns.append(pa.array([row[7].decode() for row in rows], pa.string()))
            names.append("collapsed")
        return pa.RecordBatch.from_arrays(columns, names=names)

    out = docs.select(F.col(text_col).alias("_text"), F.col(id_col).alias("_id")).mapInArrow(
        run, f"_id {kind}, n_words long, n_runs long, start long, length long, period long, "
        f"exponent_milli long, runs_sha256 string, collapsed_sha256 string{more}"
    )
    return out.withColumnRenamed("_id", id_col)
