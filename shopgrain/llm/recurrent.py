"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Each word comes in with what the labelled texts say about it as a word and about its character
3- to 5-grams. A small network reads windows of words in both directions, pools its states by
attention and gives a logit; a document is as toxic as its worst window. Windows overlap by half
and cover the whole text. Everything is trained in numpy on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import RollingHash, labelled_sample, text_steps, word_spans

# Bytes that end a word: white space, controls and ASCII punctuation.
SEPARATOR = np.array([not (chr(b).isalnum() and b < 128 or b >= 128) for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
GRAMS = (3, 4, 5)
# Weight of the prior in a word's evidence, in documents.
PRIOR = 10.0
INPUTS = 5
# Bytes of text scored at once: their words and n-grams take about 50 times that.
STEP_BYTES = 2 << 20


class Settings(NamedTuple):
    sample: int = 3000  # labelled documents to learn from, at most
    window: int = 32  # words
    stride: int = 16
    hidden: int = 8
    buckets: int = 1 << 18  # hashed words and n-grams
    passes: int = 5  # over the chosen windows, for each choice
    choices: int = 2  # times the windows to learn from are chosen anew
    batch: int = 256  # windows of a training step; fewer where there are few windows
    seed: int = 42


class Words(NamedTuple):
    """Words of consecutive texts: the distinct ones, and which one stands where."""

    number: np.ndarray  # of each word in order, its distinct word
    first: np.ndarray  # first word of each text, n + 1
    hashed: np.ndarray  # of each distinct word
    length: np.ndarray  # bytes of each distinct word
    grams: np.ndarray  # hashes of all n-grams of the distinct words, in order
    gram_first: np.ndarray  # first n-gram of each distinct word


def read_words(data: np.ndarray, offsets: np.ndarray, rolling: RollingHash) -> Words:
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, SEPARATOR)
    hashed = rolling.spans(data, starts, ends)
    number, distinct = pd.factorize(hashed)
    size = len(distinct)
    where = np.zeros(size, np.int64)
    where[number[::-1]] = np.arange(len(number))[::-1]
    a, length = starts[where], (ends - starts)[where]
    # ^word$ one after the other
    base = np.zeros(size + 1, np.int64)
    np.cumsum(length + 2, out=base[1:])
    index = np.arange(base[-1]) + np.repeat(a - base[:-1] - 1, length + 2)
    joined = data[np.clip(index, 0, max(len(data) - 1, 0))] if size else data[:0]
    joined = joined.copy()
    joined[base[:-1]] = ord("^")
    joined[base[1:] - 1] = ord("$")
    owner = np.repeat(np.arange(size), length + 2)
    grams, owners = [], []
    for n in GRAMS:
        got = rolling.windows(joined, n)
        inside = owner[:len(got)] == owner[n - 1:n - 1 + len(got)] if len(got) else np.zeros(0, bool)
        grams.append(got[inside])
        owners.append(owner[:len(got)][inside])
    grams, owners = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return Words(
        number, first, np.asarray(distinct, np.uint64), length, grams[order],
        np.searchsorted(owners[order], np.arange(size)),
    )


class Evidence(NamedTuple):
    """What labelled documents say about hashed words and n-grams."""

    word: np.ndarray
    count: np.ndarray
    gram: np.ndarray

    @classmethod
    def of(cls, words: Words, labels: np.ndarray, chosen: np.ndarray, buckets: int) -> Evidence:
        text = np.repeat(np.arange(len(labels)), np.diff(words.first))
        pairs = np.unique(text * (len(words.hashed) + 1) + words.number)
        text, word = pairs // (len(words.hashed) + 1), pairs % (len(words.hashed) + 1)
        here = chosen[text]
        text, word = text[here], word[here]
        rate = min(max(labels[chosen].mean() if chosen.any() else 0.5, 1e-3), 1 - 1e-3)
        bucket = (words.hashed & np.uint64(buckets - 1)).astype(np.int64)
        seen = np.bincount(bucket[word], minlength=buckets)
        bad = np.bincount(bucket[word], weights=labels[text], minlength=buckets)
        each_seen = np.bincount(word, minlength=len(words.hashed))
        each_bad = np.bincount(word, weights=labels[text], minlength=len(words.hashed))
        owner = np.zeros(len(words.grams), np.int64)
        owner[words.gram_first[words.gram_first < len(owner)]] = 1
        owner = np.cumsum(owner) - 1
        gram = (words.grams & np.uint64(buckets - 1)).astype(np.int64)
        gram_seen = np.bincount(gram, weights=each_seen[owner], minlength=buckets)
        gram_bad = np.bincount(gram, weights=each_bad[owner], minlength=buckets)

        def log_odds(bad, seen):
            return np.log((bad + PRIOR * rate) / ((seen + PRIOR) * rate)).astype(np.float32)

        return cls(
            log_odds(bad, seen), (np.log1p(seen) / 5).astype(np.float32),
            log_odds(gram_bad, gram_seen),
        )

    def inputs(self, words: Words) -> np.ndarray:
        """INPUTS numbers for each distinct word."""
        mask = np.uint64(len(self.word) - 1)
        out = np.zeros((len(words.hashed), INPUTS), np.float32)
        if not len(out):
            return out
        bucket = (words.hashed & mask).astype(np.int64)
        grams = self.gram[(words.grams & mask).astype(np.int64)]
        counts = np.diff(np.append(words.gram_first, len(grams)))
        out[:, 0] = self.word[bucket]
        out[:, 1] = self.count[bucket]
        out[:, 2] = np.maximum.reduceat(grams, words.gram_first)
        out[:, 3] = np.add.reduceat(grams, words.gram_first) / counts
        out[:, 4] = np.minimum(words.length, 40) / 10
        return out


def windows(first: np.ndarray, size: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, words) of the windows of all texts: overlapping, the last one flush with the
    text's end; a shorter or empty text has one."""
    count = np.diff(first)
    each = 1 + -(-np.maximum(count - size, 0) // stride)
    text = np.repeat(np.arange(len(count)), each)
    base = np.zeros(len(count) + 1, np.int64)
    np.cumsum(each, out=base[1:])
    start = np.minimum((np.arange(base[-1]) - base[text]) * stride, np.maximum(count - size, 0)[text])
    return text, first[text] + start, np.minimum(count[text], size)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters by name; `f` reads forward, `b` backward."""

    def __init__(self, inputs: int, hidden: int, rng: np.random.Generator):
        self.hidden = hidden
        p = {}
        for d in "fb":
            p[f"W{d}"] = rng.normal(0, 0.4, (inputs, 3 * hidden))
            p[f"U{d}"] = rng.normal(0, 0.3, (hidden, 3 * hidden))
            p[f"c{d}"] = np.zeros(3 * hidden)
        p["a"] = rng.normal(0, 0.3, 2 * hidden)
        p["w"] = rng.normal(0, 0.3, 2 * hidden)
        p["o"] = np.zeros(1)
        self.p = {k: v.astype(np.float32) for k, v in p.items()}

    def projected(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        """What each distinct word adds to the gates; the last row stands for no word: its
        update gate keeps the state."""
        out = {}
        for d in "fb":
            gates = np.zeros((len(inputs) + 1, 3 * self.hidden), np.float32)
            gates[:-1] = inputs @ self.p[f"W{d}"] + self.p[f"c{d}"]
            gates[-1, self.hidden:2 * self.hidden] = 40
            out[d] = gates
        return out

    def _read(self, gates: np.ndarray, index: np.ndarray, direction: str, keep: list | None):
        hidden, u = self.hidden, self.p[f"U{direction}"]
        steps = index.shape[1]
        state = np.zeros((len(index), hidden), np.float32)
        states = np.empty((steps, len(index), hidden), np.float32)
        for t in range(steps) if direction == "f" else reversed(range(steps)):
            x = gates[index[:, t]]
            back = state @ u
            rz = _sigmoid(x[:, :2 * hidden] + back[:, :2 * hidden])
            r, z = rz[:, :hidden], rz[:, hidden:]
            n = np.tanh(x[:, 2 * hidden:] + r * back[:, 2 * hidden:])
            if keep is not None:
                keep.append((t, state, r, z, n, back[:, 2 * hidden:]))
            state = n + z * (state - n)
            states[t] = state
        return states

    def logits(self, gates: dict, index: np.ndarray, mask: np.ndarray, keep: dict | None = None):
        kept = {d: [] if keep is not None else None for d in "fb"}
        states = np.concatenate(
            [self._read(gates[d], index, d, kept[d]) for d in "fb"], axis=2
        )
        score = np.where(mask.T, states @ self.p["a"], np.float32(-1e9))
        weight = np.exp(score - score.max(0))
        weight /= weight.sum(0)
        pooled = np.einsum("tb,tbh->bh", weight, states)
        if keep is not None:
            keep.update(kept, states=states, weight=weight, pooled=pooled)
        return pooled @ self.p["w"] + self.p["o"][0]

    def gradients(self, gates, inputs, index, mask, target) -> dict[str, np.ndarray]:
        keep: dict = {}
        logit = self.logits(gates, index, mask, keep)
        error = (_sigmoid(logit) - target) / len(target)
        grad = {"w": keep["pooled"].T @ error, "o": np.array([error.sum()])}
        d_pooled = error[:, None] * self.p["w"]
        states, weight = keep["states"], keep["weight"]
        d_weight = np.einsum("bh,tbh->tb", d_pooled, states)
        d_score = weight * (d_weight - (weight * d_weight).sum(0))
        grad["a"] = np.einsum("tb,tbh->h", d_score, states)
        d_states = weight[:, :, None] * d_pooled + d_score[:, :, None] * self.p["a"]
        padded = np.vstack([inputs, np.zeros((1, inputs.shape[1]), np.float32)])
        hidden = self.hidden
        for k, d in enumerate("fb"):
            u = self.p[f"U{d}"]
            d_u, d_w = np.zeros_like(u), np.zeros_like(self.p[f"W{d}"])
            d_c = np.zeros(3 * hidden, np.float32)
            flow = np.zeros((len(index), hidden), np.float32)
            for t, state, r, z, n, back in reversed(keep[d]):
                flow = flow + d_states[t][:, k * hidden:(k + 1) * hidden]
                d_n = flow * (1 - z) * (1 - n * n)
                d_z = flow * (state - n) * z * (1 - z)
                d_r = d_n * back * r * (1 - r)
                at = np.concatenate([d_r, d_z, d_n], axis=1)
                at *= mask[:, t, None]
                through = np.concatenate([at[:, :2 * hidden], at[:, 2 * hidden:] * r], axis=1)
                d_u += state.T @ through
                d_w += padded[index[:, t]].T @ at
                d_c += at.sum(0)
                flow = flow * z + through @ u.T
            grad |= {f"U{d}": d_u, f"W{d}": d_w, f"c{d}": d_c}
        return grad


class Classifier(NamedTuple):
    evidence: Evidence
    network: Network
    scale: tuple[float, float, float]  # logit, log of the number of windows, constant
    settings: Settings


def _worst(network, gates, words: Words, settings: Settings, step: int = 4096):
    """(text, start, length, logit) of all windows."""
    text, start, count = windows(words.first, settings.window, settings.stride)
    logit = np.empty(len(text), np.float32)
    none = len(gates["f"]) - 1
    for at in range(0, len(text), step):
        index, mask = _index(words, start[at:at + step], count[at:at + step], settings, none)
        logit[at:at + step] = network.logits(gates, index, mask)
    return text, start, count, logit


def _index(words: Words, start, count, settings: Settings, none: int):
    place = np.arange(settings.window)
    mask = place[None, :] < count[:, None]
    if not len(words.number):
        return np.full(mask.shape, none, np.int64), mask
    at = np.minimum(start[:, None] + place, len(words.number) - 1)
    return np.where(mask, words.number[at], none), mask


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a lightly regularised logistic regression, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        move = np.linalg.solve(hessian, x.T @ (y - p) - 1e-2 * w)
        w += move
        if np.abs(move).max() < 1e-6:
            break
    return w


def train(sample: list[tuple[str, int]], settings: Settings | None = None) -> Classifier:
    """Learn from (text, label) rows.

    Evidence for a text's words comes from the other half of the sample, so that the network
    does not learn from what a text says about itself. It learns from the worst windows of each
    text, chosen anew as it gets better, and from as many others of clean texts. An empty sample gives a
    classifier that knows nothing.
    """
    settings = settings or Settings()
    rng = np.random.default_rng(settings.seed)
    rolling = RollingHash()
    network = Network(INPUTS, settings.hidden, rng)
    raw = [t.encode("utf-8", "surrogatepass") for t, _ in sample]
    offsets = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(t) for t in raw], out=offsets[1:])
    words = read_words(np.frombuffer(b"".join(raw), np.uint8), offsets, rolling)
    labels = np.array([y for _, y in sample], np.float64)
    everything = Evidence.of(words, labels, np.ones(len(labels), bool), settings.buckets)
    if not len(labels) or labels.min() == labels.max():
        constant = 0.0 if not len(labels) else (4.0 if labels[0] else -4.0)
        return Classifier(everything, network, (0.0, 0.0, constant), settings)
    half = rng.random(len(labels)) < 0.5
    inputs = [
        Evidence.of(words, labels, side, settings.buckets).inputs(words) for side in (half, ~half)
    ]
    # Distinct words once per half; the words of a text use the row of the other half's evidence.
    both = np.vstack(inputs)
    text_of = np.repeat(np.arange(len(labels)), np.diff(words.first))
    crossed = words._replace(number=words.number + np.where(half[text_of], len(words.hashed), 0))
    text, start, count = windows(words.first, settings.window, settings.stride)
    strong = np.maximum(both[crossed.number, 0], 0) if len(crossed.number) else np.zeros(1)
    sums = np.concatenate([[0.0], np.cumsum(strong)])
    logit = sums[np.minimum(start + count, len(sums) - 1)] - sums[np.minimum(start, len(sums) - 1)]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.p.items()}
    steps, rate = 0, 0.03
    for choice in range(settings.choices):
        if choice:
            text, start, count, logit = _worst(network, network.projected(both), crossed, settings)
        order = np.lexsort((-logit, text))
        first = np.r_[True, text[order][1:] != text[order][:-1]]
        rank = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
        top = order[rank == 0]
        clean = np.flatnonzero(labels[text] == 0)
        other = rng.choice(clean, min(len(clean), len(top)), replace=False)
        chosen = np.concatenate([top, other])
        batch = min(max(len(chosen) // 30, 16), settings.batch)
        for _ in range(settings.passes):
            for at in np.array_split(rng.permutation(chosen), max(1, len(chosen) // batch)):
                index, mask = _index(crossed, start[at], count[at], settings, len(both))
                here, index = np.unique(index, return_inverse=True)
                index = index.reshape(mask.shape)
                if here[-1] < len(both):  # the last row stands for no word
                    here = np.append(here, len(both))
                some = both[here[:-1]]
                gates = network.projected(some)
                target = labels[text[at]].astype(np.float32)
                steps += 1
                for k, g in network.gradients(gates, some, index, mask, target).items():
                    m, v = moments[k]
                    g = g + 1e-4 * network.p[k]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    move = m / (1 - 0.9 ** steps) / (np.sqrt(v / (1 - 0.999 ** steps)) + 1e-8)
                    network.p[k] -= (rate * move).astype(np.float32)
        rate /= 2
    text, _, _, logit = _worst(network, network.projected(both), crossed, settings)
    worst = np.full(len(labels), -np.inf)
    np.maximum.at(worst, text, logit)
    many = np.log(np.bincount(text, minlength=len(labels)))
    scale = _logistic(np.column_stack([worst, many, np.ones(len(labels))]), labels)
    return Classifier(everything, network, tuple(float(x) for x in scale), settings)


def scores(model: Classifier, data: np.ndarray, offsets: np.ndarray, rolling: RollingHash):
    """The score of each text, 0 to 1."""
    words = read_words(data, offsets, rolling)
    gates = model.network.projected(model.evidence.inputs(words))
    text, _, _, logit = _worst(model.network, gates, words, model.settings)
    worst = np.full(len(offsets) - 1, -np.inf)
    np.maximum.at(worst, text, logit)
    many = np.log(np.bincount(text, minlength=len(offsets) - 1))
    a, b, c = model.scale
    return 1 / (1 + np.exp(-np.clip(a * worst + b * many + c, -50, 50)))


def score(
    docs: DataFrame, model: Classifier, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns `keep` and `score` of every row; null texts are empty, empty ones have one
    window without words. Rows are scored one by one, so repeated rows and ids need no care."""
    keep = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = RollingHash()
        for batch in batches:
            for part, data, offsets in text_steps(batch, 0, STEP_BYTES):
                got = scores(model, data, offsets, rolling)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(got)], names=[*keep, "score"]
                )

    fields = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return docs.select(F.col(text_col).alias("_text"), *keep).mapInArrow(run, f"{fields}score double")


def trained(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Classifier:
    """A classifier of `labels.toxic`, learned from rows that are not held out."""
    settings = settings or Settings()
    return train(labelled_sample(docs, labels, "toxic", settings.sample), settings)
