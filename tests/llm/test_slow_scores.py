"""The registered scores of op4 and op7 against slow versions that go byte by byte and word by word."""

import math
import random
import re

import numpy as np
import pytest

from shopgrain.llm import linecrf, recurrent
from shopgrain.llm.catalogue import QUERIES
from shopgrain.llm.common import RollingHash, labelled_sample

HASH = RollingHash()


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


# --- op4 ----------------------------------------------------------------------------------------

KINDS = (
    range(65, 91), [*range(97, 123), *range(128, 256)], range(48, 58), b".,;:?'\"()-", b"!", b"|",
    b"#$%&*@^~", b"<>{}[]\\=+_/`", b" \t\n\x0b\x0c\r",
)


def slow_features(lines):
    rows = []
    for line in lines:
        words = [w for w in re.split(rb"[ \t\n\x0b\x0c\r]+", line) if w]
        size, many = len(line), max(len(words), 1)
        row = [sum(b in kind for b in line) / max(size, 1) for kind in KINDS]
        row.append(sum(a == b for a, b in zip(words, words[1:])) / many)
        row.append(len(set(words)) / many)
        row += [math.log(1 + size), math.log(1 + len(words)), min(size / many, 40) / 10]
        row += [line[-1:] in (b".", b"!", b"?"), size == 0, size > 0 and lines.count(line) > 1,
                len(lines) == 1]
        rows.append([float(x) for x in row])
    return rows


def slow_quality(text, model):
    lines = (text or "").encode().split(b"\n")
    scaled = [
        [(x - m) / s for x, m, s in zip(row, model.mean, model.spread)] for row in slow_features(lines)
    ]
    none = [0.0] * len(model.mean)
    good = []
    for i, row in enumerate(scaled):
        before = scaled[i - 1] if i else none
        after = scaled[i + 1] if i + 1 < len(scaled) else none
        emission = sum(x * w for x, w in zip([*row, *before, *after, 1.0], model.weights))
        good.append(sigmoid(min(max(emission, -30), 30)))
    local = [(1 - g, g) for g in good]
    move = [[math.exp(x) for x in row] for row in model.transition]

    def passed(chances, step):
        out = [(1.0, 1.0)]
        for one in chances:
            total = [out[-1][y] * one[y] for y in (0, 1)]
            out.append(tuple(sum(total[y] * step(y, z) for y in (0, 1)) for z in (0, 1)))
            out[-1] = tuple(v / sum(out[-1]) for v in out[-1])
        return out

    forward = passed(local, lambda y, z: move[y][z])
    backward = passed(local[::-1], lambda y, z: move[z][y])[::-1]
    forward[0] = backward[-1] = (1.0, 1.0)
    weight = total = 0.0
    for i, line in enumerate(lines):
        both = [forward[i][y] * local[i][y] * backward[i + 1][y] for y in (0, 1)]
        total += both[1] / sum(both) * (len(line) + 1)
        weight += len(line) + 1
    mean = total / weight
    near = min(max(mean, 1e-4), 1 - 1e-4)
    a, b, c = model.curve
    return sigmoid(a * mean + b * math.log(near / (1 - near)) + c)


# --- op7 ----------------------------------------------------------------------------------------


def hashed(data):
    return int(HASH.spans(np.frombuffer(data, np.uint8), np.array([0]), np.array([len(data)]))[0])


def words_of(text):
    raw = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return re.findall(rb"[0-9A-Za-z\x80-\xff]+", raw)


def grams_of(word):
    framed = b"^" + word + b"$"
    for n in recurrent.GRAMS:
        for i in range(len(framed) - n + 1):
            yield int(HASH.windows(np.frombuffer(framed[i:i + n], np.uint8), n)[0])


def slow_evidence(sample, buckets):
    """Log odds of words, their counts, log odds of n-grams, each by bucket."""
    rate = min(max(sum(y for _, y in sample) / len(sample), 1e-3), 1 - 1e-3)
    seen, bad = [0] * buckets, [0] * buckets
    gram_seen, gram_bad = [0] * buckets, [0] * buckets
    for text, label in sample:
        for word in set(words_of(text)):
            at = hashed(word) % buckets
            seen[at] += 1
            bad[at] += label
            for gram in grams_of(word):
                gram_seen[gram % buckets] += 1
                gram_bad[gram % buckets] += label

    def odds(b, n):
        return math.log((b + recurrent.PRIOR * rate) / ((n + recurrent.PRIOR) * rate))

    return (
        [odds(b, n) for b, n in zip(bad, seen)], [math.log(1 + n) / 5 for n in seen],
        [odds(b, n) for b, n in zip(gram_bad, gram_seen)],
    )


def slow_toxicity(text, model, evidence):
    word_odds, counts, gram_odds = evidence
    buckets, hidden, p = len(word_odds), model.network.hidden, model.network.p

    def inputs(word):
        at = hashed(word) % buckets
        grams = [gram_odds[g % buckets] for g in grams_of(word)]
        return np.array([
            word_odds[at], counts[at], max(grams), sum(grams) / len(grams), min(len(word), 40) / 10
        ])

    def read(rows, d):
        state, states = np.zeros(hidden), []
        for row in rows:
            x, back = row @ p[f"W{d}"] + p[f"c{d}"], state @ p[f"U{d}"]
            gate = [1 / (1 + np.exp(-(x[k:k + hidden] + back[k:k + hidden]))) for k in (0, hidden)]
            new = np.tanh(x[2 * hidden:] + gate[0] * back[2 * hidden:])
            state = (1 - gate[1]) * new + gate[1] * state
            states.append(state)
        return states

    words, size, stride = words_of(text), model.settings.window, model.settings.stride
    starts = [0]
    while starts[-1] + size < len(words):
        starts.append(min(starts[-1] + stride, len(words) - size))
    logits = []
    for start in starts:
        rows = [inputs(w) for w in words[start:start + size]]
        both = [np.concatenate(s) for s in zip(read(rows, "f"), read(rows[::-1], "b")[::-1])]
        pooled = np.zeros(2 * hidden)
        if both:
            weight = np.exp([s @ p["a"] for s in both])
            pooled = sum(w * s for w, s in zip(weight / weight.sum(), both))
        logits.append(float(pooled @ p["w"] + p["o"][0]))
    a, b, c = model.scale
    return sigmoid(a * max(logits) + b * math.log(len(logits)) + c)


# --- both ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Texts of many shapes with labels, as the given tables."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices(["ka", "lo", "Mi", "tu", "é", "x9"], k=rng.randint(1, 4)))
    rows, marks = [], []
    for i in range(160):
        bad, poor = rng.random() < 0.3, rng.random() < 0.3
        lines = []
        for _ in range(rng.randint(1, 9)):
            words = [word() for _ in range(rng.randint(0, 18))]
            if bad and words:
                words[-1] = "Grub" + rng.choice(["ble", "ster"])
            lines.append((" | " if poor else " ").join(words) + rng.choice(["", ".", "!!"]))
        if rng.random() < 0.2:
            lines.append(lines[0])
        rows.append((i, "\n".join(lines)))
        # Some labels are wrong, so that scores are not all at the ends.
        marks.append((i, int(bad != (rng.random() < 0.2)), int(poor == (rng.random() < 0.2))))
    rows += [(160, None), (161, ""), (162, "\n\n"), (163, "ka ka ka"), (163, "ka ka ka"), (164, "...")]
    base = str(tmp_path_factory.mktemp("scores"))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, toxic long, quality long").write.parquet(f"{base}/labels.parquet")
    return base


def tables(spark, folder):
    return [spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels")]


def scored(spark, folder, name):
    found = {r["doc_id"]: r["score"] for r in QUERIES[name](spark, folder).collect()}
    texts = {r["doc_id"]: r["text"] for r in tables(spark, folder)[0].collect()}
    assert set(found) == set(texts)
    return [(texts[i], score) for i, score in found.items()]


def test_op4_against_the_slow_version(spark, folder):
    model = linecrf.trained(*tables(spark, folder))
    rows = scored(spark, folder, "op4_line_quality")
    for text, score in rows:
        assert score == pytest.approx(slow_quality(text, model), abs=1e-6)
    assert len({round(score, 3) for _, score in rows}) > 20


def test_op7_against_the_slow_version(spark, folder):
    docs, labels = tables(spark, folder)
    model = recurrent.trained(docs, labels)
    sample = labelled_sample(docs, labels, "toxic", model.settings.sample)
    evidence = slow_evidence(sample, model.settings.buckets)
    for name, slow in zip(("word", "count", "gram"), evidence):
        assert np.allclose(getattr(model.evidence, name), slow, atol=1e-5)
    rows = scored(spark, folder, "op7_toxicity")
    for text, score in rows:
        assert score == pytest.approx(slow_toxicity(text, model, evidence), abs=1e-3)
    assert len({round(score, 3) for _, score in rows}) > 20


def test_a_sample_keeps_to_its_bytes(spark, folder):
    docs, labels = tables(spark, folder)
    whole = labelled_sample(docs, labels, "toxic", 1000)
    size = sum(len(t.encode()) for t, _ in whole)
    for most in (0, size // 3, size - 1, size):
        part = labelled_sample(docs, labels, "toxic", 1000, most_bytes=most)
        assert sum(len(t.encode()) for t, _ in part) <= most
        assert part == whole[:len(part)]
        assert len(part) == len(whole) or sum(len(t.encode()) for t, _ in whole[:len(part) + 1]) > most
