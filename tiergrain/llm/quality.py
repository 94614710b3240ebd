"""Operator 12: quality classifier on random Fourier features.

A document is described by a fixed number of statistics of its whole text (how
long it is, how often words, lines and word pairs repeat, what kinds of characters
it has). Random cosines of the scaled statistics approximate a Gaussian kernel,
and ridge regression on them is fitted from its normal equations: every partition
adds up its own ``Z'Z`` and ``Z'y``, and the sums are added. Rows that the ridge
fit has not seen then calibrate it: isotonic regression (pool adjacent violators)
turns its values into the share of good documents.

**Training rows.** Labelled documents outside the held-out fold, at most
``TRAIN_ROWS`` (drawn by a hash of the id), a fifth of them for the calibration.
Inputs are statistics of the text only. The model has a fixed size; every row is
scored by one narrow pass.

Defined results: a null or empty text has statistics zero and is scored like
any other; a row without an id is scored and not held out; an id with
contradicting labels is not learned from; labels other than 0 and 1 do not
count; repeated rows get equal scores; if only one class or no label can be
learned from, every score is the smoothed share of good rows (one half without
labels); an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiergrain.llm.common import id_text, stored

TRAIN_ROWS = 20_000
FEATURES = 256          # random cosines
RIDGE = 1e-3            # times the number of rows
CALIBRATION_FOLDS = 5   # one of them calibrates
FIT_PARTS = 8           # partitions of the bounded training sample
THRESHOLD = 0.3
FOLDS = 5
CLIP = 4.0              # scaled statistics beyond this say no more

UPPER, DIGITS, SPACES = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"\t\n\x0b\x0c\r "
LETTERS, STOPS, MARKS = b"abcdefghijklmnopqrstuvwxyz", b".,;:", b"#$%&*|<>{}[]=_\\^~/@+"
STATISTICS = 19


def text_statistics(text: str) -> list[float]:
    """The ``STATISTICS`` numbers that describe a text."""
    raw = text.encode()
    if not raw:
        return [0.0] * STATISTICS
    words, lines = raw.split(), raw.split(b"\n")
    n, size = len(words), len(raw)

    def share(kind: bytes) -> float:
        return (size - len(raw.translate(None, kind))) / size

    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    top = sum(c for _, c in counts.most_common(5))
    ends = sum(w[-1] in STOPS or w[-1] in b"!?" for w in words)
    n = max(n, 1)
    return [np.log1p(n), sum(map(len, words)) / n, len(counts) / n, pairs / max(n - 1, 1), top / n,
            counts.most_common(1)[0][1] / n if words else 0.0, share(UPPER), share(DIGITS), share(LETTERS), share(STOPS),
            share(MARKS), share(b"!?"), share(SPACES), ends / n, np.log1p(len(lines)), len(set(lines)) / len(lines),
            sum(len(w) == 1 for w in words) / n, sum(map(eq, words, words[1:])) / n, max(map(len, words), default=0) ** 0.5]


def statistics_of(texts) -> np.ndarray:
    return np.array([text_statistics(t or "") for t in texts], dtype=np.float64).reshape(-1, STATISTICS)


class FourierRidge:
    """Scaling, random cosines, ridge weights and the calibration curve."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int = FEATURES, seed: int = 17):
        self.mean, self.scale = mean, scale
        rng = np.random.default_rng(seed)
        self.waves = rng.normal(size=(len(mean), features)) / np.sqrt(len(mean))
        self.phase = rng.uniform(0, 2 * np.pi, features)
        self.weights = np.zeros(features + 1)
        self.curve = (np.zeros(1), np.full(1, 0.5))

    def cosines(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -CLIP, CLIP)
        wave = np.sqrt(2 / len(self.phase)) * np.cos(z @ self.waves + self.phase)
        return np.column_stack([wave, np.ones(len(x))])

    def equations(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = self.cosines(x)
        return z.T @ z, z.T @ y

    def solve(self, left: np.ndarray, right: np.ndarray, rows: int) -> None:
        penalty = np.full(len(right), RIDGE * max(rows, 1) / len(self.phase))
        penalty[-1] = 1e-9
        self.weights = np.linalg.solve(left + np.diag(penalty), right)

    def values(self, x: np.ndarray) -> np.ndarray:
        return self.cosines(x) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.values(x), *self.curve) if len(x) else np.zeros(0)


def isotonic(value: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: rising block values, and the mean of every block's inputs.

    Between the blocks the curve is linear. Equal inputs are one block from the start.
    """
    weight = np.ones(len(y)) if weight is None else weight
    value, which = np.unique(value, return_inverse=True)
    n = np.bincount(which, weights=weight)
    mean = np.bincount(which, weights=weight * y) / n
    blocks: list[list[float]] = []       # rows, mean, sum of inputs
    for w, m, v in zip(n, mean, value * n):
        blocks.append([w, m, v])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w1, m1, v1 = blocks.pop()
            w0, m0, v0 = blocks[-1]
            blocks[-1] = [w0 + w1, (w0 * m0 + w1 * m1) / (w0 + w1), v0 + v1]
    return np.array([v / w for w, _, v in blocks]), np.array([m for _, m, _ in blocks])


def fold_of(id_col: Column, folds: int = FOLDS) -> Column:
    """``crc32`` of the id's text modulo ``folds``; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds


def _equations(model: FourierRidge):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right, rows = 0.0, 0.0, 0
        for b in batches:
            x = np.array(b.column(0).to_pylist(), dtype=np.float64).reshape(-1, STATISTICS)
            more = model.equations(x, b.column(1).to_numpy().astype(np.float64))
            left, right, rows = left + more[0], right + more[1], rows + len(x)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([left.tobytes()]), pa.array([right.tobytes()]),
                                              pa.array([rows], pa.int64())], names=["l", "r", "n"])
    return run


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = statistics_of(b.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float64())), b.column(1), b.column(2)],
                                         names=["x", "y", "calibrates"])


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                  train_rows: int) -> DataFrame:
    """``x`` (statistics), ``y`` and ``calibrates`` of at most ``train_rows`` labelled rows outside the held-out fold."""
    marks = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
             .where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & (fold_of(F.col("id")) != 0))
             .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("other")).where("y = other").drop("other"))
    text = id_text(docs, id_col, text_col)
    ids = text.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("id")).distinct()
    drawn = marks.join(ids, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(train_rows)
    drawn = stored(drawn.withColumn("calibrates", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(CALIBRATION_FOLDS)) == 0),
                   "quality-labels")
    # at most ``train_rows`` rows of an id and two flags; rows with the same id and text count once
    sample = text.join(F.broadcast(drawn), F.col("doc_id") == F.col("id"))
    sample = sample.groupBy("id", F.xxhash64("text").alias("key")).agg(
        F.first("text").alias("text"), F.first("y").alias("y"), F.first("calibrates").alias("calibrates"))
    described = sample.select("text", "y", "calibrates").mapInArrow(_describe, "x array<double>, y int, calibrates boolean")
    return stored(described, "quality-sample")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", train_rows: int = TRAIN_ROWS, features: int = FEATURES) -> FourierRidge:
    """Train on at most ``train_rows`` labelled documents."""
    rows = training_rows(docs, labels, id_col, text_col, label_col, train_rows)
    every = [f(F.col("x")[i]) for i in range(STATISTICS) for f in (F.avg, F.stddev_pop)]
    total = rows.agg(F.count("*"), F.sum("y"), *every).first()
    n, good = total[0], total[1] or 0
    if not n:
        return FourierRidge(np.zeros(STATISTICS), np.ones(STATISTICS), features)
    moments = np.array(total[2:], dtype=np.float64).reshape(STATISTICS, 2)
    model = FourierRidge(moments[:, 0], np.where(moments[:, 1] > 1e-9, moments[:, 1], 1.0), features)
    if good in (0, n):
        model.curve = (np.zeros(1), np.full(1, (good + 1) / (n + 2)))
        return model
    fitted = rows.where("NOT calibrates")
    # FIT_PARTS rows of a matrix each: the sample is bounded, so is their number
    parts = fitted.select("x", "y").repartition(FIT_PARTS).mapInArrow(
        _equations(model), "l binary, r binary, n long").collect()
    if parts:
        left, right = (sum(np.frombuffer(p[k]) for p in parts) for k in "lr")
        model.solve(left.reshape(len(right), len(right)), right, sum(p["n"] for p in parts))
    held = rows.where("calibrates").select("x", "y").toPandas()          # a fifth of ``train_rows``
    if not len(held):
        held = rows.select("x", "y").toPandas()
    x = np.array(held["x"].tolist(), dtype=np.float64).reshape(-1, STATISTICS)
    model.curve = isotonic(model.values(x), held["y"].to_numpy().astype(np.float64))
    return model


def score_column(model: FourierRidge, text: Column) -> Column:
    """Score of a text column, 0 to 1."""
    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(np.clip(model.scores(statistics_of(texts)), 0.0, 1.0))

    return score(text)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "quality", **training) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    model = fit(docs, labels, id_col, text_col, label_col, **training)
    scored = id_text(docs, id_col, text_col).select("doc_id", score_column(model, F.col("text")).alias("score"))
    return scored.select("doc_id", F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
