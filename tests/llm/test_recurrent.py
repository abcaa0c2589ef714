import random

import numpy as np
import pytest

from shopgrain.llm import recurrent as R
from shopgrain.llm.common import RollingHash


def buffer(texts):
    raw = [t.encode() for t in texts]
    offsets = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(t) for t in raw], out=offsets[1:])
    return np.frombuffer(b"".join(raw), np.uint8), offsets


def sample(n, seed, longest=400):
    """Toxic texts hold a word of a bad stem somewhere."""
    rng = random.Random(seed)
    syllables = ["ka", "lo", "mi", "tu", "re", "sha", "no", "pe"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    rows = []
    for _ in range(n):
        words = [word() for _ in range(rng.randint(1, longest))]
        bad = rng.random() < 0.25
        if bad:
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = "Grub" + rng.choice(["ble", "ster", "ly", "ka"])
        rows.append((" ".join(words) + rng.choice([".", "", "!"]), int(bad)))
    return rows


def test_words_of_texts():
    texts = ["", "Hello, hello WORLD\nx", "  ", "été été-hello", "a"]
    data, offsets = buffer(texts)
    words = R.read_words(data, offsets, RollingHash())
    assert np.diff(words.first).tolist() == [0, 4, 0, 3, 1]
    assert words.number.tolist() == [0, 0, 1, 2, 3, 3, 0, 4]
    assert words.length.tolist() == [5, 5, 1, 5, 1]
    grams = np.diff(np.append(words.gram_first, len(words.grams)))
    # ^word$ of n + 2 bytes has n trigrams, n - 1 of four and n - 2 of five
    assert grams.tolist() == [12, 12, 1, 12, 1]


def test_windows_cover_every_word_and_overlap():
    first = np.array([0, 0, 5, 37, 137])
    text, start, count = R.windows(first, 32, 16)
    for t in range(4):
        mine = [(s, c) for x, s, c in zip(text, start, count) if x == t]
        covered = {w for s, c in mine for w in range(s, s + c)}
        assert covered == set(range(first[t], first[t + 1])) and len(mine) >= 1
        assert all(s + c <= first[t + 1] for s, c in mine)
    assert [c for t, c in zip(text, count) if t == 0] == [0]


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    network = R.Network(R.INPUTS, 3, rng)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    inputs = rng.normal(size=(6, R.INPUTS))
    index = np.array([[0, 1, 2, 3], [4, 5, 6, 6], [2, 2, 1, 6]])
    mask = index < 6
    target = np.array([1.0, 0.0, 1.0])

    def loss():
        z = network.logits(network.projected(inputs), index, mask)
        return float(np.mean(np.log1p(np.exp(z)) - target * z))

    found = network.gradients(network.projected(inputs), inputs, index, mask, target)
    for name, value in network.p.items():
        for place in list(np.ndindex(value.shape))[:7]:
            kept = value[place]
            value[place] = kept + 1e-2
            up = loss()
            value[place] = kept - 1e-2
            down = loss()
            value[place] = kept
            assert found[name][place] == pytest.approx((up - down) / 2e-2, abs=2e-3)


def test_learns_and_holds_on_other_texts(spark):
    model = R.train(sample(600, 1), R.Settings(passes=4))
    rows = [(i, t, y) for i, (t, y) in enumerate(sample(400, 2))]
    rows += [(1000, None, 0), (1001, "", 0), (1002, "kalo " * 20_000 + "grubster", 1), (1002, "ka", 0), (None, "ka", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, y int").selectExpr("*", "'x' as score")
    found = R.score(frame, model, keep=("doc_id", "text", "y")).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    right = [(r["score"] >= 0.3) == bool(r["y"]) for r in found]
    assert np.mean(right) > 0.93
    again = R.train(sample(600, 1), R.Settings(passes=4))
    assert again.scale == model.scale


def test_no_rows_and_one_label(spark):
    frame = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert R.score(frame, R.train([])).first()["score"] == 0.5
    assert R.score(frame, R.train([("a", 0), ("b", 0)])).first()["score"] < 0.1
    assert R.score(frame.limit(0), R.train([])).collect() == []


def test_sample_leaves_out_held_out_rows(spark):
    import zlib

    docs = spark.createDataFrame([(i, f"text {i}") for i in range(200)] + [(None, "x"), (5, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(0, 200, 2)] + [(3, 1, 1), (None, 1, 1)],
                                   "doc_id long, toxic int, quality int")
    from shopgrain.llm.common import labelled_sample

    got = labelled_sample(docs, labels, "toxic", 1000)
    ids = {int(t.split()[1]) for t, _ in got}
    assert ids == {i for i in [*range(0, 200, 2), 3] if zlib.crc32(str(i).encode()) % 4 != 2}
    assert len(labelled_sample(docs, labels, "toxic", 10)) == 10
    assert len(labelled_sample(docs, labels, "quality", 10)) <= 1
