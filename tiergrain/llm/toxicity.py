"""Operator 10: toxicity grades by cumulative-link ordinal regression.

Grades are 0 (none), 1 (mild) and 2 (severe). One weight vector ``w`` serves all
thresholds: P(grade <= j) = sigmoid(theta_j - w.x), theta_0 < theta_1. The
output is the expected grade, P(grade >= 1) + P(grade >= 2); a text is rejected
if P(grade >= 1) is at least one half.

**Features.** Sparse indicators: the lower-cased words of a text and their first
4, 5 and 6 characters, so that new endings of a known stem count. Of those that
are clearly more frequent in toxic texts (``MIN_LIFT``), the ``FEATURES`` that
speak most for the toxic class are used. Copies among the training texts count
once.

**Training rows.** At most ``TRAIN_ROWS`` labelled documents of the input (of
each class those with the least id hashes) are used, so training costs the same
at every size; scoring covers every document. The classes have their shares of
the labels, but a class that has them gets at least ``LEAST_SHARE`` of the
places; rows then weigh as much as the labels they stand for. Labels only say toxic or not; a toxic training text is
severe if its margin, under a two-grade model fitted on the other half of the training rows, is above the
median of the toxic texts.

Defined results: a null or empty text has no features; labels with a null or an
unknown document are ignored; without both classes the model scores every text
0, with a warning if labels of a missing class exist; repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import warnings
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiergrain.llm.common import id_text, only_memos_of, stored

TRAIN_ROWS = 12_000
LEAST_SHARE = 0.1         # of the training rows, for each class that has as many
FEATURES = 2_000
MIN_ROWS = 3              # toxic training texts that must have a feature
MIN_LIFT = 1.5            # log ratio of a feature's share among toxic and clean training texts
STEPS = 600
RIDGE = 2e-5
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")


def word_features(word: str) -> list[str]:
    return [word] + [f"^{word[:k]}" for k in (4, 5, 6) if len(word) > k]


def text_features(text: str) -> set[str]:
    return {f for w in set(_WORD.findall(text.lower())) for f in word_features(w)}


@dataclass(frozen=True)
class OrdinalModel:
    """Weights by feature and the two thresholds."""

    weights: dict[str, float]
    theta: tuple[float, float]

    def probabilities(self, text: str) -> tuple[float, float]:
        """P(grade >= 1), P(grade >= 2)."""
        if not self.weights:
            return 0.0, 0.0
        found = {f for w in set(_WORD.findall(text.lower())) for f in word_features(w) if f in self.weights}
        margin = sum(self.weights[f] for f in sorted(found))
        return tuple(float(1 / (1 + np.exp(np.clip(t - margin, -500, 500)))) for t in self.theta)

    def column(self, text: Column) -> Column:
        """Struct ``severity`` (expected grade), ``grade``, ``toxic`` of a text column."""

        @F.pandas_udf("severity double, grade int, toxic boolean")
        def score(texts: pd.Series) -> pd.DataFrame:
            only_memos_of("toxicity")
            p = np.array([self.probabilities(t or "") for t in texts]).reshape(-1, 2)
            return pd.DataFrame({"severity": p.sum(axis=1), "grade": (p >= 0.5).sum(axis=1).astype("int32"),
                                 "toxic": p[:, 0] >= 0.5})

        return score(text)


def fit_ordinal(rows: list[np.ndarray], grade: np.ndarray, n_features: int, steps: int = STEPS,
                ridge: float = RIDGE, weight: np.ndarray | None = None) -> tuple[np.ndarray, tuple[float, float]]:
    """Cumulative-link regression by Adam on the (weighted) mean log loss; rows list feature numbers."""
    weight = np.ones(len(rows)) if weight is None else weight / weight.mean()
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feature = np.concatenate([*rows, np.zeros(0, dtype=np.int64)]).astype(np.int64)
    share = [np.clip(np.mean(weight * (grade <= j)), 1e-3, 1 - 1e-3) for j in (0, 1)]
    low = np.log(share[0] / (1 - share[0]))
    gap = np.log(max(1e-2, np.log(share[1] / (1 - share[1])) - low))
    x = np.concatenate([np.zeros(n_features), [low, gap]])
    m, v = np.zeros_like(x), np.zeros_like(x)

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))

    for step in range(1, steps + 1):
        margin = np.bincount(at, weights=x[feature], minlength=len(rows))
        theta = np.array([x[-2], x[-2] + np.exp(x[-1])])
        below = np.column_stack([np.zeros(len(rows)), *(sigmoid(t - margin) for t in theta), np.ones(len(rows))])
        slope = below * (1 - below)
        own = np.arange(len(rows))
        p = np.maximum(below[own, grade + 1] - below[own, grade], 1e-12)
        by_margin = weight * (slope[own, grade + 1] - slope[own, grade]) / p / len(rows)
        g = np.zeros_like(x)
        g[:n_features] = np.bincount(feature, weights=by_margin[at], minlength=n_features) + ridge * x[:n_features]
        by_theta = [np.sum(weight * (np.where(grade == j, -slope[:, j + 1], 0) / p
                                     + np.where(grade == j + 1, slope[:, j + 1], 0) / p)) / len(rows) for j in (0, 1)]
        g[-2] = by_theta[0] + by_theta[1]
        g[-1] = by_theta[1] * np.exp(x[-1])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x - 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return x[:n_features], (float(x[-2]), float(x[-2] + np.exp(x[-1])))


def held_out_margins(rows: list[np.ndarray], y: np.ndarray, n_features: int, weight: np.ndarray) -> np.ndarray:
    """Each row's margin under a two-grade model fitted on the other half of the rows."""
    half, margin = np.arange(len(rows)) % 2, np.zeros(len(rows))
    for own in (0, 1):
        others = np.flatnonzero(half != own)
        if len(others):
            weights, _ = fit_ordinal([rows[i] for i in others], y[others], n_features, weight=weight[others])
            for i in np.flatnonzero(half == own):
                margin[i] = weights[rows[i]].sum()
    return margin


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    only_memos_of("toxicity")
    for b in batches:
        counts = (Counter(), Counter())
        for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            counts[toxic].update(text_features(text))
        names = sorted(counts[1])      # a feature no toxic text of the batch has only adds to the clean count
        names += sorted(set(counts[0]) - set(names))
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([counts[1][f] for f in names], pa.int64()),
             pa.array([counts[0][f] for f in names], pa.int64())], names=["feature", "toxic", "clean"])


def class_places(n: dict[int, int], train_rows: int) -> dict[int, int]:
    """Training rows of each class, of ``n`` labelled documents."""
    total = n[0] + n[1]
    if total <= train_rows:
        return dict(n)
    least = max(1, int(train_rows * LEAST_SHARE))
    toxic = min(max(train_rows * n[1] // total, min(n[1], least)), train_rows - min(n[0], least))
    return {0: train_rows - toxic, 1: toxic}


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        toxic_col: str = "toxic", train_rows: int = TRAIN_ROWS, features: int = FEATURES) -> OrdinalModel:
    """Train on at most ``train_rows`` labelled documents."""
    marks = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(toxic_col).cast("int").alias("y"))
             .where(F.col("id").isNotNull() & F.col("y").isin(0, 1))
             .groupBy("id").agg(F.max("y").alias("y")))
    text = id_text(docs, id_col, text_col)
    ids = text.select(F.col("doc_id").alias("id")).distinct()
    known = stored(marks.join(ids, "id", "left_semi"), "toxicity-labels")
    labelled = {0: 0, 1: 0} | {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not labelled[0] or not labelled[1]:
        lost = sorted(r.y for r in marks.select("y").distinct().collect() if not labelled[r.y])
        if lost:
            warnings.warn(f"toxicity: labels {lost} exist, but of no document of the input; every text scores 0")
        return OrdinalModel({}, (0.0, 1.0))
    places = class_places(labelled, train_rows)

    def chosen_of(y: int) -> DataFrame:
        rows = known.where(F.col("y") == y)
        return rows if places[y] == labelled[y] else rows.orderBy(F.xxhash64("id"), "id").limit(places[y])

    # at most ``train_rows`` rows of two numbers
    train = chosen_of(0).unionByName(chosen_of(1))
    sample = stored(text.join(F.broadcast(train), F.col("doc_id") == F.col("id")).select("text", "y")
                    .distinct().repartition(8), "toxicity-sample")
    n = {r.y: r.n for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    counts = (sample.mapInArrow(_feature_counts, "feature string, toxic long, clean long")
              .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
              .where(F.col("toxic") >= MIN_ROWS))
    lift = F.log((F.col("toxic") + 0.5) / (n[1] + 1.0)) - F.log((F.col("clean") + 0.5) / (n[0] + 1.0))
    chosen = [r.feature for r in counts.where(lift >= MIN_LIFT)
              .select("feature", (F.col("toxic") * lift).alias("score")).orderBy(F.desc("score"), "feature").limit(features).collect()]
    number = {f: i for i, f in enumerate(chosen)}

    def design(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xs = [sorted(number[f] for f in text_features(t) if f in number) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(xs, pa.list_(pa.int32()))], names=["y", "x"])

    rows = sample.mapInArrow(design, "y int, x array<int>").toPandas()     # ``train_rows`` at most
    rows["x"] = [np.array(x, dtype=np.int64) for x in rows["x"]]
    rows = rows.iloc[sorted(range(len(rows)), key=lambda i: (rows["y"][i], rows["x"][i].tolist()))]
    y = rows["y"].to_numpy()
    stand_for = np.array([labelled[c] / places[c] for c in (0, 1)])
    margin = held_out_margins(list(rows["x"]), y, len(chosen), stand_for[y])
    severe = margin > np.median(margin[y == 1])
    weights, theta = fit_ordinal(list(rows["x"]), y + (y == 1) * severe, len(chosen), weight=stand_for[y])
    return OrdinalModel(dict(zip(chosen, weights.tolist())), theta)


def grade_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    **training) -> DataFrame:
    """``doc_id``, ``severity`` (expected grade 0 to 2), ``grade``, ``toxic`` of every row."""
    model = fit(docs, labels, id_col, text_col, **training)
    return id_text(docs, id_col, text_col).select("doc_id", model.column(F.col("text")).alias("t")) \
        .select("doc_id", "t.severity", "t.grade", "t.toxic")
