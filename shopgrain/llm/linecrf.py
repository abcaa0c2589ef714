"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's features are counts of its own bytes and words and those of
the lines before and after it; neighbouring labels depend on each other. Forward and backward
passes give each line's chance of being good; weighted by length, these make up the document's
quality, which a logistic curve turns into a score. Learned in numpy on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import (
    RollingHash,
    SPACES,
    byte_set,
    labelled_sample,
    text_steps,
    word_spans,
)

NEWLINE = 10
# Classes of bytes that are counted.
KINDS = (
    byte_set(bytes(range(65, 91))),  # capitals
    byte_set(bytes(range(97, 123)) + bytes(range(128, 256))),  # other letters
    byte_set(bytes(range(48, 58))),
    byte_set(b".,;:?'\"()-"),
    byte_set(b"!"),
    byte_set(b"|"),
    byte_set(b"#$%&*@^~"),
    byte_set(b"<>{}[]\\=+_/`"),
    byte_set(SPACES),
)
FEATURES = len(KINDS) + 9


class Settings(NamedTuple):
    sample: int = 4000  # labelled documents to learn from, at most
    segment: int = 64  # lines of a training sequence, at most
    rounds: int = 150
    rate: float = 0.05
    decay: float = 1e-3


def line_features(
    data: np.ndarray, offsets: np.ndarray, rolling: RollingHash
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, bytes of each line, first line of each text, n + 1). Every text has a line."""
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == NEWLINE)
    # A line starts with its text or after a break of that text.
    text = np.concatenate([np.arange(n), np.searchsorted(offsets, breaks, "right") - 1])
    order = np.lexsort((np.concatenate([offsets[:-1], breaks + 1]), text))
    starts, text = np.concatenate([offsets[:-1], breaks + 1])[order], text[order]
    first = np.searchsorted(text, np.arange(n + 1))
    ends = np.empty(len(starts), np.int64)
    last = np.ones(len(starts), bool)
    last[:-1] = text[1:] != text[:-1]
    ends[~last] = starts[1:][~last[:-1]] - 1
    ends[last] = offsets[1:]
    size = ends - starts
    out = np.zeros((len(starts), FEATURES))
    length = np.maximum(size, 1)
    for k, kind in enumerate(KINDS):
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(kind[data], out=sums[1:])
        out[:, k] = (sums[ends] - sums[starts]) / length
    a, b, _ = word_spans(data, offsets, byte_set(SPACES))
    word_first = np.searchsorted(a, starts)
    words = np.searchsorted(a, ends) - word_first
    many = np.maximum(words, 1)
    hashed = rolling.spans(data, a, b)
    line = np.searchsorted(starts, a, "right") - 1 if len(a) else np.zeros(0, np.int64)
    again = np.zeros(len(a) + 1, np.int64)
    new = np.zeros(len(a) + 1, np.int64)
    if len(a):
        same = np.r_[False, (hashed[1:] == hashed[:-1]) & (line[1:] == line[:-1])]
        np.cumsum(same, out=again[1:])
        number = pd.factorize(hashed)[0]
        np.cumsum(~pd.Series(line * (number.max() + 1) + number).duplicated().to_numpy(), out=new[1:])
    k = len(KINDS)
    stop = word_first + words
    out[:, k] = (again[stop] - again[word_first]) / many
    out[:, k + 1] = (new[stop] - new[word_first]) / many
    out[:, k + 2] = np.log1p(size)
    out[:, k + 3] = np.log1p(words)
    out[:, k + 4] = np.minimum(size / many, 40) / 10
    final = data[np.maximum(ends - 1, 0)] if len(data) else np.zeros(len(ends), np.uint8)
    out[:, k + 5] = (size > 0) & np.isin(final, np.frombuffer(b".!?", np.uint8))
    out[:, k + 6] = size == 0
    content = rolling.spans(data, starts, ends) if len(data) else np.zeros(len(starts), np.uint64)
    copy = pd.DataFrame({"t": text, "h": content}).duplicated(keep=False).to_numpy()
    out[:, k + 7] = copy & (size > 0)
    out[:, k + 8] = np.diff(first)[text] == 1
    return out, size, first


def with_neighbours(features: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A line's own features, those of the lines before and after (zeros at the ends), and 1."""
    before, after = np.zeros_like(features), np.zeros_like(features)
    before[1:] = features[:-1]
    after[:-1] = features[1:]
    starts = first[:-1]
    before[starts] = 0
    after[first[1:] - 1] = 0
    return np.hstack([features, before, after, np.ones((len(features), 1))])


def marginals(
    emission: np.ndarray, transition: np.ndarray, first: np.ndarray, pairs: bool = False
):
    """Chance of each line to be good; with `pairs` also the summed chances of label pairs.

    Chains run side by side, the longest first, so that a step works on those still running.
    """
    count = np.diff(first)
    order = np.argsort(-count, kind="stable")
    begin, count = first[:-1][order], count[order]
    good = 1 / (1 + np.exp(-np.clip(emission, -30, 30)))
    local = np.column_stack([1 - good, good])
    move = np.exp(transition)
    longest = int(count[0]) if len(count) else 0
    running = np.searchsorted(-count, -np.arange(1, longest + 1), "right")
    forward = np.empty_like(local)
    for t in range(longest):
        at = begin[:running[t]] + t
        now = local[at] if t == 0 else (forward[at - 1] @ move) * local[at]
        forward[at] = now / now.sum(1, keepdims=True)
    backward = np.ones_like(local)
    for t in range(longest - 2, -1, -1):
        at = begin[:running[t + 1]] + t
        now = (local[at + 1] * backward[at + 1]) @ move.T
        backward[at] = now / now.sum(1, keepdims=True)
    both = forward * backward
    chance = both[:, 1] / both.sum(1)
    if not pairs:
        return chance
    inner = np.ones(len(emission), bool)
    inner[first[1:] - 1] = False
    a = np.flatnonzero(inner)
    joint = forward[a][:, :, None] * move[None] * (local[a + 1] * backward[a + 1])[:, None, :]
    joint /= joint.sum((1, 2), keepdims=True)
    return chance, joint


class Model(NamedTuple):
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    transition: np.ndarray
    curve: np.ndarray


def _emission(model: Model, features: np.ndarray, first: np.ndarray) -> np.ndarray:
    return with_neighbours((features - model.mean) / model.spread, first) @ model.weights


def _summary(chance: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each text the length-weighted mean chance, also as log odds, and 1."""
    weight = size + 1.0
    mean = np.add.reduceat(chance * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])
    clipped = np.clip(mean, 1e-4, 1 - 1e-4)
    return np.column_stack([mean, np.log(clipped / (1 - clipped)), np.ones(len(mean))])


def _buffer(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def train(sample: list[tuple[str, int]], settings: Settings | None = None) -> Model:
    """Learn from (text, quality) rows; each line is taken to have its text's label.

    Maximum likelihood by Adam, every text weighing the same. Without rows, or with one label only, the
    score is constant.
    """
    settings = settings or Settings()
    width = 3 * FEATURES + 1
    blank = Model(
        np.zeros(FEATURES), np.ones(FEATURES), np.zeros(width), np.zeros((2, 2)), np.zeros(3)
    )
    labels = np.array([y for _, y in sample], np.float64)
    if not len(labels) or labels.min() == labels.max():
        if len(labels):
            blank.curve[2] = 4.0 if labels[0] else -4.0
        return blank
    data, offsets = _buffer([t.encode("utf-8", "surrogatepass") for t, _ in sample])
    features, size, first = line_features(data, offsets, RollingHash())
    mean, spread = features.mean(0), features.std(0) + 1e-3
    x = with_neighbours((features - mean) / spread, first)
    text = np.repeat(np.arange(len(labels)), np.diff(first))
    place = np.arange(len(text)) - first[text]
    pieces = np.append(np.flatnonzero(place % settings.segment == 0), len(text))
    share = (1.0 / np.diff(first))[text]
    share *= len(share) / share.sum()
    inner = np.ones(len(text), bool)
    inner[pieces[1:] - 1] = False
    y = labels[text]
    params = [np.zeros(x.shape[1]), np.zeros((2, 2))]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    true_pairs = np.zeros((int(inner.sum()), 2, 2))
    same = y[inner].astype(int)
    true_pairs[np.arange(len(same)), same, same] = 1
    pair_share = share[inner][:, None, None]
    for step in range(1, settings.rounds + 1):
        chance, joint = marginals(x @ params[0], params[1], pieces, pairs=True)
        grads = [
            x.T @ ((chance - y) * share) / len(y) + settings.decay * params[0],
            ((joint - true_pairs) * pair_share).sum(0) / len(y) + settings.decay * params[1],
        ]
        for p, g, (m, v) in zip(params, grads, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= settings.rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    model = Model(mean, spread, params[0], params[1], np.zeros(3))
    chance = marginals(_emission(model, features, first), model.transition, first)
    z, w = _summary(chance, size, first), np.zeros(3)
    for _ in range(50):  # logistic curve by Newton steps
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(3)
        w += np.linalg.solve(hessian, z.T @ (labels - p) - 0.1 * w)
    return model._replace(curve=w)


def scores(model: Model, data: np.ndarray, offsets: np.ndarray, rolling: RollingHash):
    """(score of each text, chance of each line to be good, first line of each text)."""
    features, size, first = line_features(data, offsets, rolling)
    chance = marginals(_emission(model, features, first), model.transition, first)
    z = _summary(chance, size, first) @ model.curve
    return 1 / (1 + np.exp(-np.clip(z, -50, 50))), chance, first


def score(
    docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
    lines: bool = False,
) -> DataFrame:
    """The columns `keep`, `score` and, with `lines`, the chance of each line to be good.

    A null text is empty; an empty text is one empty line. Rows are scored one by one, so
    repeated rows and ids need no care.
    """
    keep = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = RollingHash()
        for batch in batches:
            for part, data, offsets in text_steps(batch, 0, 4 << 20):
                got, chance, first = scores(model, data, offsets, rolling)
                columns, names = [*part.columns[1:], pa.array(got)], [*keep, "score"]
                if lines:
                    columns.append(pa.ListArray.from_arrays(first.astype(np.int32), chance))
                    names.append("lines")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return docs.select(F.col(text_col).alias("_text"), *keep).mapInArrow(
        run, f"{fields}score double{', lines array<double>' * lines}"
    )


def trained(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Model:
    """A model of `labels.quality`, learned from rows that are not held out."""
    settings = settings or Settings()
    return train(labelled_sample(docs, labels, "quality", settings.sample), settings)
