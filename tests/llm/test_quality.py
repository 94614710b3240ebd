import random
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from tiergrain.llm import quality as Q
from tiergrain.llm.registry import QUERIES

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("score", T.StringType()), T.StructField("id", T.LongType())])


def table(spark, rows):
    return spark.createDataFrame([(d, t, "clash", 7) for d, t in rows], DOCS)


def marks(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, y int")


def corpus(n, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("aeionrst") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(5, 80))]
        good = rng.random() < 0.7
        rows.append((i, " ".join(words) if good else " ".join(w + rng.choice("#$%&") for w in words)))
        if rng.random() < 0.6:
            labels.append((i, int(good), 0))
    return rows, labels


def test_isotonic_is_the_least_squares_rising_fit():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 40):
        x, y = rng.integers(0, 12, n).astype(float), rng.integers(0, 2, n).astype(float)
        at, value = Q.isotonic(x, y)
        assert (np.diff(value) > 0).all() and (np.diff(at) > 0).all()
        # min-max formula, block by block of equal inputs
        points = np.unique(x)
        want = [max(min(y[(x >= a) & (x <= b)].mean() for b in points if b >= p) for a in points if a <= p) for p in points]
        assert np.allclose(sorted(set(np.round(want, 9))), np.round(value, 9))
        for p, w in zip(points, want):
            assert min(value, key=lambda v: abs(v - w)) == pytest.approx(w)


def test_partition_sums_solve_the_whole_ridge():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(500, Q.STATISTICS)), rng.integers(0, 2, 500).astype(float)
    model = Q.FourierRidge(x.mean(0), x.std(0), features=40)
    parts = [model.equations(x[i::7], y[i::7]) for i in range(7)]
    model.solve(sum(p[0] for p in parts), sum(p[1] for p in parts), 500)
    z = model.cosines(x)
    root = np.sqrt(Q.RIDGE * 500 / 40) * np.eye(41)
    root[-1, -1] = np.sqrt(1e-9)
    want = np.linalg.lstsq(np.vstack([z, root]), np.concatenate([y, np.zeros(41)]), rcond=None)[0]
    assert np.allclose(model.values(x), z @ want, atol=1e-6)


def test_cosines_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(30, Q.STATISTICS))
    model = Q.FourierRidge(np.zeros(Q.STATISTICS), np.ones(Q.STATISTICS), features=20_000)
    z = model.cosines(x)[:, :-1]
    far = ((x[:, None] - x[None]) ** 2).sum(2)
    assert np.abs(z @ z.T - np.exp(-far / (2 * Q.STATISTICS))).max() < 0.05


def test_query_separates_held_out_rows(spark):
    rows = QUERIES["op12_quality"](spark, "/root/testdata/sf0.1").collect()
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    label = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [(label[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in label]
    assert sum(q == p for q, _, p in held) >= 0.98 * len(held)
    good, bad = ([s for q, s, _ in held if q == c] for c in (1, 0))
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) >= 0.99 * len(good) * len(bad)


def test_labels_of_the_held_out_fold_are_never_learned(spark):
    rows, labels = corpus(300)
    flipped = [(d, 1 - q if zlib.crc32(str(d).encode()) % 5 == 0 else q, 0) for d, q, _ in labels]
    first = Q.score_documents(table(spark, rows), marks(spark, labels)).collect()
    second = Q.score_documents(table(spark, rows), marks(spark, flipped)).collect()
    assert sorted(first) == sorted(second)
    label = {d: q for d, q, _ in labels}
    held = [r for r in first if r.held_out and r.doc_id in label]
    assert sum(r.predicted == label[r.doc_id] for r in held) >= 0.95 * len(held)


def test_nulls_repeats_and_contradictions(spark):
    rows, labels = corpus(120, seed=4)
    rows += rows[:20] + [(None, rows[0][1]), (None, None), (900, None), (901, ""), (902, " \n\t "), (903, "x " * 300_000)]
    labels += [(None, 1, 0), (1, None, 0), (2, 7, 0)] + [(d, 1 - q, 0) for d, q, _ in labels[:10]]
    found = Q.score_documents(table(spark, rows), marks(spark, labels)).collect()
    assert len(found) == len(rows)
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, set()).add((r.score, r.held_out))
    assert all(len(v) == 1 for d, v in by_id.items() if d is not None)
    assert by_id[900] == {(next(iter(by_id[901]))[0], zlib.crc32(b"900") % 5 == 0)}
    assert all(not held for _, held in by_id[None])


def test_one_class_no_labels_and_empty_tables(spark):
    rows, labels = corpus(40, seed=5)
    only = [(d, 1, 0) for d, _, _ in labels]
    scores = {r.score for r in Q.score_documents(table(spark, rows), marks(spark, only)).collect()}
    assert len(scores) == 1 and 0.9 < scores.pop() < 1
    assert {r.score for r in Q.score_documents(table(spark, rows), marks(spark, [])).collect()} == {0.5}
    assert Q.score_documents(table(spark, []), marks(spark, labels)).collect() == []


def test_sample_is_bounded(spark):
    rows, labels = corpus(300, seed=6)
    assert Q.training_rows(table(spark, rows), marks(spark, labels), "doc_id", "text", "quality", 50).count() == 50
