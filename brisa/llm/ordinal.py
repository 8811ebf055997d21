"""Quality classifier: cumulative-link regression on graded ratings.

Grades are ordered (0 low quality, 1 good but toxic, 2 good and clean).  One
weight vector over hashed text features is shared by all grades; ordered
thresholds t_1 < t_2 < ... cut its score, so that P(grade >= j) =
sigmoid(score - t_j).  The expected grade is the sum of these tails, and
selection is by the tail of the lowest grade worth keeping.

Features of a text, each counted over its words, scaled by the root of its
share and hashed to ``DIM`` weights: the lower-cased word, the word's shape
(runs of character classes, punctuation kept as it is), and whether it repeats
the word before it.

Fitting reads a bounded sample of labelled rows (``SAMPLE``); their features
come from Spark tasks and the weights are fitted in numpy.  Scoring is a
function of the text alone, over every whole text, without a shuffle; tasks
hold the weights (``DIM`` numbers) and one chunk of texts.

Defined results: a null or empty text has no features and gets the score 0 cut
by the thresholds; equal texts get equal scores; with no labelled rows every
tail is 0.5 and nothing is rejected; repeated rows and other columns are kept
as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.llm.common import LOWER, SPACED, chunks, mix, prepare, word_hashes, words
from brisa.llm.sampling import labelled_documents

DIM = 1 << 16
#: Labelled rows to fit on (at most twice as many).
SAMPLE = 6000
EPOCHS = 200
#: Keep documents whose P(grade >= 1) is at least this.
KEEP = 0.5

# Character classes of a shape: digit, upper, lower, other alphabets, full stop or comma; other punctuation stands for itself.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x30:0x3A], _SHAPE[0x41:0x5B], _SHAPE[0x61:0x7B], _SHAPE[0x80:], _SHAPE[[0x2C, 0x2E]] = 1, 2, 3, 4, 5


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1, 2, ... by row."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None], -50, 50)))


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of a chunk of texts, by row."""
    n = len(offsets) - 1
    starts, ends, first = words(data, offsets, SPACED)
    h = word_hashes(LOWER[data], starts, ends)
    shape = _SHAPE[data]
    keep = np.ones(len(shape), bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[starts] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    shapes = word_hashes(shape[keep], at[starts], at[ends])
    repeat = np.zeros(len(h), np.uint64)
    repeat[1:] = h[1:] == h[:-1]
    repeat[first[:-1][first[:-1] < len(h)]] = 0
    row = np.repeat(np.arange(n), np.diff(first))
    keys = np.concatenate([row * DIM + (mix(f + np.uint64(salt)) % np.uint64(DIM)).astype(np.int64)
                           for salt, f in enumerate((h, shapes, repeat), 1)])
    keys, count = np.unique(keys, return_counts=True)
    row = keys // DIM
    return row, keys % DIM, 3 * np.sqrt(count / np.diff(first)[row])


def _train(row: np.ndarray, feature: np.ndarray, value: np.ndarray, grade: np.ndarray, grades: int) -> Model:
    """Adam on the mean negative log-likelihood of the grades."""
    n, theta = len(grade), np.linspace(-1, 1, grades - 1) if grades > 2 else np.zeros(1)
    x = np.zeros(DIM + len(theta))
    x[DIM:] = theta
    m, v = np.zeros_like(x), np.zeros_like(x)
    rows, levels = np.arange(n), np.arange(1, grades)
    for e in range(1, EPOCHS + 1):
        score = np.bincount(row, value * x[feature], minlength=n)
        tail = Model(x[:DIM], x[DIM:]).tails(score)
        full = np.concatenate([np.ones((n, 1)), tail, np.zeros((n, 1))], axis=1)
        p = np.maximum(full[rows, grade] - full[rows, grade + 1], 1e-9)
        slope = full * (1 - full)
        g_score = -(slope[rows, grade] - slope[rows, grade + 1]) / p
        at = (grade[:, None] == levels).astype(float) - (grade[:, None] == levels - 1)
        g_theta = (at * tail * (1 - tail) / p[:, None]).sum(axis=0)
        g = np.concatenate([np.bincount(feature, g_score[row] * value, minlength=DIM) / n + 1e-5 * x[:DIM], g_theta / n])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x -= 0.1 * (m / (1 - 0.9 ** e)) / (np.sqrt(v / (1 - 0.99 ** e)) + 1e-8)
        x[DIM:] = np.maximum.accumulate(x[DIM:])
    return Model(x[:DIM], x[DIM:])


def fit(docs: DataFrame, ratings: DataFrame, grades: int, sample: int = SAMPLE) -> Model:
    """Fit on documents whose doc_id has a ``grade`` (0 .. grades - 1) in ``ratings``."""
    rated = labelled_documents(docs, ratings.select("doc_id", F.col("grade").cast("int").alias("grade")), sample, "ordinal",
                               F.col("grade").between(0, grades - 1))

    def extract(batches):
        for batch in batches:
            grade, digests = batch.column("grade"), batch.column("digest")
            for lo, hi, data, offsets in chunks(batch.column("text")):
                row, feature, value = features(data, offsets)
                cut = np.searchsorted(row, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays([
                    grade.slice(lo, hi - lo), digests.slice(lo, hi - lo),
                    pa.array([feature[a:b].astype("<i4").tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                    pa.array([value[a:b].astype("<f4").tobytes() for a, b in zip(cut, cut[1:])], pa.binary())], ["grade", "digest", "feature", "value"])

    got = rated.select("grade", "digest", "text").mapInArrow(extract, "grade int, digest binary, feature binary, value binary").collect()
    got.sort(key=lambda r: (r.digest, r.grade))
    if not got:
        return Model(np.zeros(DIM), np.zeros(grades - 1))
    feature = [np.frombuffer(r.feature, "<i4") for r in got]
    row = np.repeat(np.arange(len(got)), [len(f) for f in feature])
    return _train(row, np.concatenate(feature), np.concatenate([np.frombuffer(r.value, "<f4") for r in got]).astype(float),
                  np.array([r.grade for r in got]), grades)


def score(model: Model, docs: DataFrame, text: str = "text") -> Column:
    """Column struct<expected, tails> of a text column: expected grade, and P(grade >= j) for j = 1, 2, ..."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(column: pa.Array) -> pa.Array:
        m, tails = shared.value, []
        for lo, hi, data, offsets in chunks(column):
            row, feature, value = features(data, offsets)
            tails.append(m.tails(np.bincount(row, value * m.weights[feature], minlength=hi - lo)))
        t = np.concatenate(tails) if tails else np.zeros((0, len(m.thresholds)))
        flat = pa.FixedSizeListArray.from_arrays(pa.array(t.ravel()), t.shape[1]).cast(pa.list_(pa.float64()))
        return pa.StructArray.from_arrays([pa.array(t.sum(axis=1)), flat], ["expected", "tails"])

    return F.arrow_udf(rate, "struct<expected:double,tails:array<double>>")(F.col(text))


def ratings(labels: DataFrame) -> DataFrame:
    """Grades from the label table: 0 low quality, 1 good but toxic, 2 good and clean."""
    grade = F.when(F.col("quality") == 0, 0).when((F.col("quality") == 1) & (F.col("toxic") == 1), 1).when(
        (F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select("doc_id", grade.alias("grade"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, expected_grade, p_good, p_clean, keep of every document."""
    rated = docs.select("doc_id", score(fit(docs, ratings(labels), 3), docs).alias("r"))
    return rated.select("doc_id", F.col("r.expected").alias("expected_grade"), F.col("r.tails")[0].alias("p_good"),
                        F.col("r.tails")[1].alias("p_clean"), (F.col("r.tails")[0] >= KEEP).alias("keep"))


def select(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs``, all columns, with P(grade >= 1) of at least ``keep``."""
    rated = docs.withColumn("__r", score(fit(docs, ratings(labels), 3), docs))
    return rated.where(F.col("__r.tails")[0] >= keep).select(docs.columns)
