"""Similarity digests from improbable features.

Every window of 64 bytes has an entropy. Over the whole corpus, entropies are counted; the rarer
a window's entropy, the better its rank. A window that ranks best in enough of the
neighbourhoods of 64 windows around it is a feature. Features go into chained Bloom filters of
256 bytes, 160 features each; likeness is the overlap of filter bits, normalised between what
chance gives and the most there can be.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.llm.common import RollingHash, byte_view, staged, table, unique_ids

WINDOW, NEIGHBOURS, POPULAR = 64, 64, 16
CLASSES = 1001
# Entropy classes below this say too little, whatever their rarity.
LEAST_CLASS = 100
FILTER_BYTES, FILTER_FEATURES, HASHES = 256, 160, 5
FILTER_BITS = FILTER_BYTES * 8
# Texts of fewer bytes than this have too few features to tell how much of them is left: their
# windows of SHORT bytes are features as well, as are those of texts without any other.
FEW_BYTES, SHORT = 512, 5
# Overlap counts from this share of the way between chance and the most there can be.
CUTOFF = 0.3
STEP_BYTES = 4 << 20
_CHUNK = 1 << 16
_ONE = 1 << 16


def _gain() -> np.ndarray:
    """What one more equal byte adds to the sum of c * log2(c), in fixed point."""
    c = np.arange(WINDOW + 1, dtype=np.float64)
    value = np.where(c > 0, c * np.log2(np.maximum(c, 1)), 0.0)
    return np.round(np.diff(value) * _ONE).astype(np.int64)


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """0 to 1000 for every window of the bytes: its entropy in thousandths of the greatest."""
    n = len(data) - WINDOW + 1
    out = np.empty(max(n, 0), np.uint16)
    gain = _gain()
    most = int(gain.sum())
    for at in range(0, n, _CHUNK):
        stop = min(at + _CHUNK, n)
        part = data[at:stop + WINDOW - 1]
        after, before = np.zeros(len(part), np.uint8), np.zeros(len(part), np.uint8)
        for d in range(1, min(WINDOW, len(part))):
            equal = (part[:-d] == part[d:]).view(np.uint8)
            after[:-d] += equal
            before[d:] += equal
        sums = np.empty(stop - at, np.int64)
        sums[0] = gain[before[:WINDOW]].sum()
        if len(sums) > 1:
            change = gain[before[WINDOW:]] - gain[after[:len(sums) - 1]]
            np.cumsum(change, out=sums[1:])
            sums[1:] += sums[0]
        out[at:stop] = (most - sums) * (CLASSES - 1) // most
    return out


def _inside(offsets: np.ndarray, n: int, width: int) -> np.ndarray:
    """Whether the `width` bytes from each of n positions lie in one text."""
    edge = np.zeros(n + 2, np.int32)
    fits = np.diff(offsets) >= width
    np.add.at(edge, offsets[:-1][fits], 1)
    np.add.at(edge, offsets[1:][fits] - width + 1, -1)
    return np.cumsum(edge[:n]) > 0


def features(
    data: np.ndarray, offsets: np.ndarray, ranks: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(text, 64-bit hash) of the features of every text, in order of text and position."""
    texts, hashes = [], []
    n = len(data) - WINDOW + 1
    if n > 0:
        rank = ranks[entropy_classes(data)].astype(np.int64)
        usable = rank < CLASSES
        reach = n - NEIGHBOURS + 1
        chosen = np.zeros(0, np.int64)
        if reach > 0:
            hoods = _inside(offsets, reach, WINDOW + NEIGHBOURS - 1)
            votes = np.zeros(n, np.int32)
            for at in range(0, reach, _CHUNK):
                stop = min(at + _CHUNK, reach)
                best = (rank[at:stop + NEIGHBOURS - 1] << 32) | np.arange(
                    at, stop + NEIGHBOURS - 1
                )
                step = 1
                while step < NEIGHBOURS:
                    best = np.minimum(best[:-step], best[step:])
                    step *= 2
                won = (best & 0xFFFFFFFF)[hoods[at:stop]]
                if len(won):
                    low = int(won.min())
                    got = np.bincount(won - low)
                    votes[low:low + len(got)] += got.astype(np.int32)
            chosen = np.flatnonzero((votes >= POPULAR) & usable)
        if len(chosen):
            texts.append(np.searchsorted(offsets, chosen, "right") - 1)
            words = data[chosen[:, None] + np.arange(WINDOW)].view("<u8")
            mixed = np.zeros(len(chosen), np.uint64)
            for k in range(words.shape[1]):
                mixed = RollingHash.mixed(mixed * np.uint64(31) + words[:, k] + np.uint64(k + 1))
            hashes.append(mixed)
    have = np.zeros(len(offsets) - 1, bool)
    if texts:
        have[texts[0]] = True
    rolling = RollingHash(7)
    size = np.diff(offsets)
    for i in np.flatnonzero((size > 0) & (~have | (size < FEW_BYTES))):
        text = data[offsets[i]:offsets[i + 1]]
        got = rolling.windows(text, min(SHORT, len(text)))
        got = got[np.sort(np.unique(got, return_index=True)[1])]
        texts.append(np.full(len(got), i))
        hashes.append(got)
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    text, hashed = np.concatenate(texts), np.concatenate(hashes)
    order = np.argsort(text, kind="stable")
    return text[order], hashed[order]


class Digests:
    """Chained Bloom filters of consecutive texts: `first[i]` is text i's first filter."""

    def __init__(self, bits: np.ndarray, first: np.ndarray):
        self.bits, self.first = bits, first
        self.ones = np.bitwise_count(bits).sum(1, dtype=np.int64)

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray, ranks: np.ndarray) -> Digests:
        text, hashed = features(data, offsets, ranks)
        n = len(offsets) - 1
        count = np.bincount(text, minlength=n)
        filters = -(-count // FILTER_FEATURES)
        first = np.zeros(n + 1, np.int64)
        np.cumsum(filters, out=first[1:])
        base = np.zeros(n + 1, np.int64)
        np.cumsum(count, out=base[1:])
        which = first[text] + (np.arange(len(text)) - base[text]) // FILTER_FEATURES
        marks = np.zeros((int(first[-1]), FILTER_BITS), bool)
        for k in range(HASHES):
            place = (hashed >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)
            marks[which, place.astype(np.int64)] = True
        bits = np.packbits(marks, axis=1).view(np.uint64)
        return cls(bits.reshape(-1, FILTER_BYTES // 8), first)

    def raw(self, i: int) -> bytes:
        return self.bits[self.first[i]:self.first[i + 1]].tobytes()

    def joined(self, other: Digests) -> Digests:
        return Digests(
            np.concatenate([self.bits, other.bits]),
            np.concatenate([self.first, other.first[1:] + self.first[-1]]),
        )

    def part(self, start: int, stop: int) -> Digests:
        a, b = self.first[start], self.first[stop]
        return Digests(self.bits[a:b], self.first[start:stop + 1] - a)


def _scores(a: np.ndarray, a_ones: np.ndarray, b: np.ndarray, b_ones: np.ndarray) -> np.ndarray:
    both = np.bitwise_count(a & b).sum(-1, dtype=np.int64)
    most = np.minimum(a_ones, b_ones)
    chance = a_ones * b_ones / FILTER_BITS
    least = chance + CUTOFF * (most - chance)
    return np.clip((both - least) / np.maximum(most - least, 1e-9), 0.0, 1.0)


def likeness(x: Digests, i: int, y: Digests, j: int) -> float:
    """0 to 1: for each filter of the shorter digest the best match in the other, on average.
    Two digests without filters are alike; one without is like no other."""
    a, a_ones = x.bits[x.first[i]:x.first[i + 1]], x.ones[x.first[i]:x.first[i + 1]]
    b, b_ones = y.bits[y.first[j]:y.first[j + 1]], y.ones[y.first[j]:y.first[j + 1]]
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b) or len(a) == len(b) and int(a_ones.sum()) > int(b_ones.sum()):
        a, a_ones, b, b_ones = b, b_ones, a, a_ones
    total = 0.0
    step = max(1, 200_000 // len(b))
    for at in range(0, len(a), step):
        scores = _scores(
            a[at:at + step, None], a_ones[at:at + step, None], b[None], b_ones[None]
        )
        total += float(scores.max(1).sum())
    return total / len(a)


def likenesses(x: Digests, y: Digests) -> np.ndarray:
    """Likeness of text i of both, for every i; single filters are compared all at once."""
    n = len(x.first) - 1
    out = np.zeros(n)
    single = (np.diff(x.first) == 1) & (np.diff(y.first) == 1)
    a, b = x.first[:-1][single], y.first[:-1][single]
    out[single] = _scores(x.bits[a], x.ones[a], y.bits[b], y.ones[b])
    for i in np.flatnonzero(~single):
        out[i] = likeness(x, i, y, i)
    return out


def entropy_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """How many windows of all texts have each entropy class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES, np.int64)
        for batch in batches:
            data, offsets = byte_view(batch.column(0))
            for a, b in _steps(offsets):
                part = offsets[a:b + 1] - offsets[a]
                got = entropy_classes(data[offsets[a]:offsets[b]])
                total += np.bincount(
                    got[_inside(part, len(got), WINDOW)], minlength=CLASSES
                )
        kind = np.flatnonzero(total)
        yield table({"kind": kind.astype(np.int32), "n": total[kind]})

    counts = np.zeros(CLASSES, np.int64)
    rows = docs.select(text_col).mapInArrow(run, "kind int, n long")
    for kind, n in rows.groupBy("kind").agg(F.sum("n")).collect():  # at most CLASSES rows
        counts[kind] = n
    return counts


def rarity_ranks(counts: np.ndarray) -> np.ndarray:
    """Rank 0 for the rarest entropy class; classes that say too little rank behind all."""
    ranks = np.empty(CLASSES, np.int64)
    ranks[np.lexsort((np.arange(CLASSES), counts))] = np.arange(CLASSES)
    ranks[:LEAST_CLASS] = CLASSES
    return ranks


def _steps(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    start = 0
    while start < len(offsets) - 1:
        stop = int(np.searchsorted(offsets, offsets[start] + STEP_BYTES, "right")) - 1
        stop = min(max(stop, start + 1), len(offsets) - 1)
        yield start, stop
        start = stop


def _buffer(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def _cut(text: bytes, points: int) -> int:
    """Where the first `points` code points of a UTF-8 text end."""
    if points <= 0:
        return 0
    data = np.frombuffer(text, np.uint8)
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    return len(text) if points >= len(starts) else int(starts[points])


def _points(text: bytes) -> int:
    return int(((np.frombuffer(text, np.uint8) & 0xC0) != 0x80).sum())


def edited(text: bytes, following: bytes) -> bytes:
    """The last third of the code points, rounded down, replaced by the first ones of the next."""
    n = _points(text)
    return text[:_cut(text, n - n // 3)] + following[:_cut(following, n // 3)]


RESULT = (
    "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)


def _results(
    texts: list[bytes], following: list[bytes], own: Digests, after: Digests, ranks: np.ndarray
) -> dict:
    changed = [edited(a, b) for a, b in zip(texts, following)]
    new = Digests.of(*_buffer(changed), ranks)
    n = len(texts)
    return {
        "n_chars": pa.array([_points(t) for t in texts], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in changed], pa.string()),
        "fingerprint": pa.array([own.raw(i) for i in range(n)], pa.binary()),
        "edited_fingerprint": pa.array([new.raw(i) for i in range(n)], pa.binary()),
        "near_edited": likenesses(own, new),
        "near_next": likenesses(own, after),
    }


def _neighbours(ranks: np.ndarray):
    """Rows in descending order: each text with the next of its partition. The last row of a
    partition comes out open, its first row is marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        uids, texts, digests, begun = [], [], None, False
        for batch in batches:
            data, offsets = byte_view(batch.column(1))
            ids = batch.column(0).to_pylist()
            for a, b in _steps(offsets):
                part = offsets[a:b + 1] - offsets[a]
                piece = data[offsets[a]:offsets[b]]
                got = Digests.of(piece, part, ranks)
                digests = got if digests is None else digests.joined(got)
                uids += ids[a:b]
                texts += [piece[part[i]:part[i + 1]].tobytes() for i in range(b - a)]
                n = len(texts) - 1
                if n:
                    rows = _results(
                        texts[:-1], texts[1:], digests.part(0, n), digests.part(1, n + 1), ranks
                    )
                    yield table({
                        "uid": pa.array(uids[:-1], pa.int64()),
                        "part": np.full(n, number, np.int32),
                        "first": np.arange(n) == (0 if not begun else -1),
                        "open": np.zeros(n, bool),
                        **rows,
                    })
                    begun = True
                    uids, texts, digests = uids[-1:], texts[-1:], digests.part(n, n + 1)
        if uids:
            none = {
                "n_chars": pa.nulls(1, pa.int64()), "edited_sha256": pa.nulls(1, pa.string()),
                "fingerprint": pa.nulls(1, pa.binary()),
                "edited_fingerprint": pa.nulls(1, pa.binary()),
                "near_edited": pa.nulls(1, pa.float64()), "near_next": pa.nulls(1, pa.float64()),
            }
            yield table({
                "uid": pa.array(uids, pa.int64()), "part": np.full(1, number, np.int32),
                "first": np.array([not begun]), "open": np.ones(1, bool), **none,
            })

    return run


def _pairs(ranks: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one, two = ((batch.column(k)[i].as_py() or "").encode() for k in (1, 2))
                own, after = (Digests.of(*_buffer([t]), ranks) for t in (one, two))
                yield table({
                    "uid": pa.array([batch.column(0)[i].as_py()], pa.int64()),
                    **_results([one], [two], own, after, ranks),
                })

    return run


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text ends with the front of the next document in descending order of id (after
    the last: the first; a single document follows itself). Fingerprints are the filters' bytes;
    likeness is `likeness`. A null text is empty and has no filter; empty texts are alike. Null
    ids count as largest; rows of equal id are ordered by text. Other columns are not looked at.

    Texts are sorted by range once. Each partition needs one text of the following one; these few
    pairs (as many as partitions) are fetched afterwards by id.
    """
    base = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    base, numbered = unique_ids(base, "_id", "text")
    ranks = rarity_ranks(entropy_counts(base))
    ordered = base.select("uid", "text").repartitionByRange(F.desc("uid"))
    found = staged(
        ordered.sortWithinPartitions(F.desc("uid")).mapInArrow(
            _neighbours(ranks), f"uid long, part int, first boolean, open boolean, {RESULT}"
        ),
        "digests",
    )
    # A row for each partition: its last text, which is open, and the first of the next partition.
    ends = found.where("first or open").groupBy("part").agg(
        F.max(F.when(F.col("first"), F.col("uid"))).alias("head"),
        F.max(F.when(F.col("open"), F.col("uid"))).alias("tail"),
    )
    by_part = Window.orderBy("part")
    following = F.coalesce(
        F.lead("head").over(by_part), F.first("head").over(by_part.rowsBetween(Window.unboundedPreceding, 0))
    )
    asked = staged(
        ends.select(F.col("tail").alias("slot"), following.alias("next")).select(
            "slot", F.inline(F.array(
                F.struct(F.col("slot").alias("uid"), F.lit(0).alias("side")),
                F.struct(F.col("next").alias("uid"), F.lit(1).alias("side")),
            ))
        ),
        "digests-asked",
    )
    columns = [c.split()[0] for c in RESULT.split(", ")]
    texts = base.select("uid", "text").join(F.broadcast(asked), "uid")  # two rows a partition
    both = texts.groupBy("slot").agg(
        F.max(F.when(F.col("side") == 0, F.col("text"))).alias("one"),
        F.max(F.when(F.col("side") == 1, F.col("text"))).alias("two"),
    )
    done = found.where("not open").select("uid", *columns).union(staged(
        both.mapInArrow(_pairs(ranks), f"uid long, {RESULT}"), "digests-edges"
    ))
    if numbered:
        done = base.select("_id", "uid").join(done, "uid")
    else:
        done = done.withColumn("_id", F.col("uid").cast(docs.schema[id_col].dataType))
    return done.select(F.col("_id").alias(id_col), *columns)
