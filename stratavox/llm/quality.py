"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratavox.llm.common import SPACE, batch_of, buffer, configure, drop, materialise, mix64, pieces, table, text_of
from stratavox.llm.packing import word_hashes

#: The field is fitted on up to SAMPLE labelled documents of each class, of up to LONGEST lines each and LINES lines in all.
SAMPLE, LONGEST, LINES = 1000, 2000, 100_000
#: Steps and strength of the fit, and how sure it must be of a good line within a bad document to call it good.
STEPS, RATE, PENALTY, SURE = 80, 0.15, 1e-4, 0.7
SCORES = "doc_id long, score double, n_lines long"

# Classes of bytes whose shares describe a line: capitals, small letters, digits, marks, exclamation, stops, other bytes.
_CLASS = np.zeros(256, np.int64)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 7
for _x in b"#$%&*|{}=<>@^~\\/_+[]":
    _CLASS[_x] = 4
_CLASS[ord("!")] = 5
for _x in b".,;:?":
    _CLASS[_x] = 6
N_CLASSES = 8
N_OWN = N_CLASSES - 1 + 8


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the lines that aren't blank, in order, and how many each row has."""
    feeds = np.append(np.flatnonzero(data == 10), len(data))
    cuts = np.concatenate([feeds[:-1] + 1, offsets[:-1]])
    starts = np.unique(cuts[cuts < len(data)])
    ends = np.minimum(feeds[np.searchsorted(feeds, starts, "left")], offsets[np.searchsorted(offsets, starts, "right")]) if len(starts) else starts
    solid = np.concatenate([[0], np.cumsum(~SPACE[data])])
    keep = solid[ends] > solid[starts]
    starts, ends = starts[keep], ends[keep]
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def line_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A row per line: its own features, those of the lines before and after it, and whether it is first or last."""
    n = len(starts)
    if not n:
        return np.zeros((0, 3 * N_OWN + 3))
    size = (ends - starts).astype(float)
    bounds = np.stack([starts, ends], axis=1).ravel()
    padded = np.append(data, np.uint8(10))

    def total(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, bounds)[0::2].astype(float)

    kinds = _CLASS[padded].astype(np.uint8)
    shares = [total((kinds == k).astype(np.int32)) / size for k in range(1, N_CLASSES)]
    solid = ~SPACE[padded]
    begins = solid & np.append(True, ~solid[:-1])
    begins[starts] = solid[starts]
    first = np.flatnonzero(begins)
    stops = np.union1d(np.flatnonzero(~solid), ends)
    after = stops[np.searchsorted(stops, first, "right")]
    n_words = np.maximum(total(begins.astype(np.int32)), 1)
    short, again, seen = (np.zeros(len(padded), np.int32) for _ in range(3))
    short[first] = after - first <= 3
    word = word_hashes(padded, first, after)
    home = np.searchsorted(starts, first, "right")
    again[first[1:]] = (word[1:] == word[:-1]) & (home[1:] == home[:-1])
    seen[first] = 1
    seen[first[np.unique(word ^ mix64(home.astype(np.uint64)), return_index=True)[1]]] = 0  # all but a line's first use of a word
    power = np.cumprod(np.full(1024, 0x9E3779B97F4A7C15, np.uint64))
    at = np.arange(len(padded)) - np.repeat(np.append(0, starts), np.diff(np.concatenate([[0], starts, [len(padded)]])))
    hashes = mix64(np.add.reduceat((padded.astype(np.uint64) + np.uint64(1)) * power[at & 1023], bounds)[0::2])
    doc = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    _, inverse, often = np.unique(hashes ^ mix64(doc + np.uint64(1)), return_inverse=True, return_counts=True)
    points = shares[5] * size / n_words
    own = np.stack([*shares, np.log1p(size) / 8, size / n_words / 10, total(short) / n_words, points, often[inverse] > 1, shares[0] > shares[1], total(again) / n_words, total(seen) / n_words], axis=1)
    last = np.cumsum(counts)
    is_first, is_last = np.zeros(n), np.zeros(n)
    is_first[(last - counts)[counts > 0]] = is_last[last[counts > 0] - 1] = 1
    before = np.where(is_first[:, None] > 0, 0, np.roll(own, 1, axis=0))
    after = np.where(is_last[:, None] > 0, 0, np.roll(own, -1, axis=0))
    return np.concatenate([own, before, after, is_first[:, None], is_last[:, None], np.ones((n, 1))], axis=1)


def marginals(score: np.ndarray, turn: np.ndarray, counts: np.ndarray, pairs: bool = False):
    """Forward and backward over all documents in step: P(good) of each line, and summed pair marginals if asked for.

    score: log-odds of good by the line itself; turn: 2 x 2 log weights from a line's label to the next one's.
    """
    n = len(score)
    emit = np.stack([np.zeros(n), np.clip(score, -30, 30)], axis=1)
    emit = np.exp(emit - emit.max(axis=1, keepdims=True))
    move = np.exp(turn)
    first = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    first, length = first[order], counts[order]
    forth, back = np.empty((n, 2)), np.ones((n, 2))
    steps = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(steps), "left")  # documents with more than t lines
    for t in range(steps):
        at = first[: active[t]] + t
        a = emit[at] if t == 0 else forth[at - 1] @ move * emit[at]
        forth[at] = a / a.sum(axis=1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        at = first[: active[t + 1]] + t
        b = (back[at + 1] * emit[at + 1]) @ move.T
        back[at] = b / b.sum(axis=1, keepdims=True)
    both = forth * back
    good = both[:, 1] / both.sum(axis=1)
    if not pairs:
        return good
    inner = np.ones(n, bool)
    inner[(np.cumsum(counts) - 1)[counts > 0]] = False
    at = np.flatnonzero(inner)
    joint = forth[at][:, :, None] * move * (back[at + 1] * emit[at + 1])[:, None, :]
    return good, (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0), at


def line_odds(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return (x @ w.astype(x.dtype)).astype(float)


def fit_field(x: np.ndarray, y: np.ndarray, counts: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions that make the line labels y likeliest, by Adam on the exact gradient."""
    w, turn = np.zeros(x.shape[1]), np.zeros((2, 2))
    theta, m, v = np.zeros(x.shape[1] + 4), 0.0, 0.0
    for step in range(1, STEPS + 1):
        good, joint, at = marginals(line_odds(x, w), turn, counts, pairs=True)
        seen = np.bincount(2 * y[at] + y[at + 1], minlength=4).reshape(2, 2)
        gradient = np.concatenate([x.T @ ((y - good) * weight).astype(x.dtype), (seen - joint).ravel()]) / len(y) - PENALTY * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta = theta + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, turn = theta[:-4], theta[-4:].reshape(2, 2)
    return w, turn


def by_length(good: np.ndarray, size: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The length-weighted mean of the lines' marginals in each document; 0 for documents without lines."""
    row = np.repeat(np.arange(len(counts)), counts)
    return np.bincount(row, good * size, len(counts)) / np.maximum(np.bincount(row, size, len(counts)), 1)


class Model:
    """A fitted field: scale of the features, weights, transitions, and the map from mean marginal to probability."""

    def __init__(self, values: list[float]):
        """values: means, scales and weights of the features, four transitions, slope and base of the calibration."""
        n = (len(values) - 6) // 3
        self.mean, self.scale, self.w = np.array(values[: 3 * n]).reshape(3, n)
        self.turn = np.array(values[3 * n : 3 * n + 4]).reshape(2, 2)
        self.a, self.b = values[-2:]

    @classmethod
    def fitted(cls, x: np.ndarray, size: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> Model:
        """From the features and sizes of all lines of a sample, its documents' numbers of lines, and their labels.

        x is 4-byte floats, scaled in place: it is the one large array of the fit.
        """
        mean, scale = x.mean(axis=0, dtype=float), x.std(axis=0, dtype=float) + 1e-6
        mean[-1], scale[-1] = 0, 1
        x -= mean.astype(np.float32)
        x /= scale.astype(np.float32)
        doc = np.repeat(labels, counts)
        y, weight = doc.astype(np.int64), np.ones(len(doc), np.float32)
        for again in (True, False):
            w, turn = fit_field(x, y, counts, weight)
            good = marginals(line_odds(x, w), turn, counts)
            if again:  # good lines of bad documents; each keeps its likeliest bad line
                y = np.where((doc == 0) & (good < SURE), 0, 1)
                row = np.repeat(np.arange(len(counts)), counts)
                order = np.lexsort((good, row))
                lowest = order[np.unique(row[order], return_index=True)[1]]
                y[lowest] = np.minimum(y[lowest], doc[lowest])
        a, b = cls.calibrated(by_length(good, size, counts)[counts > 0], labels[counts > 0])
        return cls([*mean, *scale, *w, *turn.ravel(), a, b])

    def values(self) -> list[float]:
        return [float(v) for part in (self.mean, self.scale, self.w, self.turn.ravel(), [self.a, self.b]) for v in part]

    @classmethod
    def calibrated(cls, mean: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
        z = cls.odds(mean)
        design, theta = np.stack([z, np.ones(len(z))], axis=1), np.array([1.0, 0.0])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
            hess = design.T @ (design * (p * (1 - p))[:, None]) + 1e-2 * np.eye(2)
            theta = theta + np.linalg.solve(hess, design.T @ (labels - p) - 1e-2 * theta)
        return max(theta[0], 1e-3), theta[1]

    @staticmethod
    def odds(mean: np.ndarray) -> np.ndarray:
        p = np.clip(mean, 1e-4, 1 - 1e-4)
        return np.log(p / (1 - p))

    def score(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, counts = lines(data, offsets)
        x = (line_features(data, starts, ends, counts) - self.mean) / self.scale
        good = marginals(line_odds(x, self.w), self.turn, counts)
        mean = by_length(good, (ends - starts).astype(float), counts)
        score = 1 / (1 + np.exp(-np.clip(self.a * self.odds(mean) + self.b, -30, 30)))
        return np.where(counts > 0, score, 0.0), counts


SAMPLED = "doc_id long, quality int, n_lines long, sizes binary, features binary"


def sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (doc_id, quality, text): a SAMPLED row for each text, lines as 4-byte floats."""
    for batch in batches:
        data, offsets = buffer(batch.column(2))
        for a, b in pieces(offsets):
            own, cut = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            starts, ends, counts = lines(own, cut)
            x, size = line_features(own, starts, ends, counts).astype("<f4"), (ends - starts).astype("<f4")
            upto = np.concatenate([[0], np.cumsum(counts)])
            spans = list(zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True))
            yield batch_of(SAMPLED, batch.column(0)[a:b], batch.column(1)[a:b], counts, [size[i:j].tobytes() for i, j in spans], [x[i:j].tobytes() for i, j in spans])


def fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over the whole sample in one task, in the order of doc_id: the model's numbers, or no row."""
    x, size, counts, labels = [], [], [], []
    for batch in batches:
        cols = batch.to_pydict()
        x += [np.frombuffer(v, "<f4") for v in cols["features"]]
        size += [np.frombuffer(v, "<f4") for v in cols["sizes"]]
        counts += cols["n_lines"]
        labels += cols["quality"]
    if len(set(labels)) == 2:
        features = np.concatenate(x).reshape(-1, 3 * N_OWN + 3)
        del x
        model = Model.fitted(features, np.concatenate(size).astype(float), np.array(counts), np.array(labels))
        yield pa.RecordBatch.from_arrays([pa.array([model.values()], pa.list_(pa.float64()))], ["values"])


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, longest: int = LONGEST, most: int = LINES) -> Model | None:
    """A model from a bounded sample of labelled documents, chosen by a hash; None if it lacks a class.

    Of each class `sample` documents are chosen; of these, those of 1 to `longest` lines count, as long as they have no
    more than `most` lines together. Only rows whose crc32(doc_id) mod 3 is not 1 are seen. A document with both labels,
    or a null one, is left out; of rows with one doc_id the least text counts. Tasks compute the features of the chosen
    documents and one task fits the field to them, within about 200 bytes a line; the driver gets the weights alone.
    """
    one = labels.filter("quality in (0, 1) and doc_id is not null").filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_most"))
    one = one.filter("quality = _most").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    some = [one.filter(F.col("quality") == k).join(rows.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(sample) for k in (0, 1)]
    chosen = F.broadcast(some[0].unionByName(some[1]))  # at most 2 * sample rows
    texts = rows.join(chosen, "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    known = materialise(texts.select("doc_id", "quality", "text").mapInArrow(sample_rows, SAMPLED), "quality-sample")
    upto = F.sum("n_lines").over(Window.partitionBy("quality").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id"))
    taken = known.select("doc_id", "quality", "n_lines").filter(F.col("n_lines").between(1, longest)).withColumn("_upto", upto).filter(F.col("_upto") <= most // 2).select("doc_id")
    found = known.join(F.broadcast(taken), "doc_id", "left_semi").repartition(1).sortWithinPartitions("doc_id").mapInArrow(fit_rows, "values array<double>").collect()
    drop(known)
    return Model(found[0]["values"]) if found else None


def score_rows(model: Model | None):
    """For mapInArrow over (doc_id, text): SCORES rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffer(batch.column(1))
            for a, b in pieces(offsets):
                own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                if model:
                    score, counts = model.score(*own)
                else:
                    counts = lines(*own)[2]
                    score = np.where(counts > 0, 0.5, 0.0)
                yield batch_of(SCORES, batch.column(0)[a:b], score, counts)

    return run


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score and n_lines of every row of docs, from its text alone.

    Labels of documents teach a chain over lines: at first a line has its document's label, then lines of bad documents
    that the field finds good are called good and it is fitted anew. A document's score is the length-weighted mean of
    its lines' marginals, calibrated on the sample. Documents without a line that isn't blank, null texts among them,
    score 0. Without labels of both classes every other score is 0.5. Repeated rows score alike; other columns are ignored.
    """
    model = fit(docs, labels)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text")).mapInArrow(score_rows(model), SCORES)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that score at least 0.5, with all their columns."""
    model = fit(docs, labels)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffer(batch.column(batch.schema.get_field_index("text")))
            for a, b in pieces(offsets):
                own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                score = model.score(*own)[0] if model else np.full(b - a, 0.5)
                yield batch.slice(a, b - a).filter(pa.array(score >= 0.5))

    return docs.mapInArrow(run, schema)


def op1_quality(spark, sf_dir: str) -> DataFrame:
    configure(spark)
    scored = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_lines")
