import numpy as np
import pytest
from pyspark.sql import functions as F

from tiergrain.llm import toxicity as T


def test_ordinal_regression_recovers_a_shared_weight():
    rng = np.random.default_rng(1)
    w = np.array([3.0, -2.0, 0.0, 1.5])
    rows = [np.flatnonzero(rng.random(4) < 0.5) for _ in range(6000)]
    noise = rng.logistic(size=6000)
    score = np.array([w[r].sum() for r in rows]) + noise
    grade = (score > 1.0).astype(int) + (score > 3.0)
    got, theta = T.fit_ordinal(rows, grade, 4, steps=1500, ridge=1e-6)
    assert np.abs(got - w).max() < 0.35 and abs(theta[0] - 1) < 0.3 and abs(theta[1] - 3) < 0.35


def _log_loss(rows, grade, weight, ridge, w, low, gap):
    theta = [-np.inf, low, low + np.exp(gap), np.inf]
    sigmoid = lambda z: 1 / (1 + np.exp(-z))
    m = np.array([w[r].sum() for r in rows])
    p = [sigmoid(theta[g + 1] - x) - sigmoid(theta[g] - x) for g, x in zip(grade, m)]
    return -np.average(np.log(np.maximum(p, 1e-300)), weights=weight) + ridge / 2 * (w @ w)


def test_fit_is_the_optimum_that_a_pattern_search_finds():
    rng = np.random.default_rng(3)
    rows = [np.flatnonzero(rng.random(2) < 0.5) for _ in range(200)]
    score = np.array([np.array([1.5, -1.0])[r].sum() for r in rows]) + rng.logistic(size=200)
    grade, weight = (score > 0.5).astype(int) + (score > 2.0), rng.integers(1, 4, 200).astype(float)
    x, step = np.zeros(4), 1.0
    value = lambda x: _log_loss(rows, grade, weight, 0.01, x[:2], x[2], x[3])
    best = value(x)
    while step > 1e-4:
        near = [x + step * d for d in np.vstack([np.eye(4), -np.eye(4)])]
        values = [value(n) for n in near]
        if min(values) < best - 1e-12:
            best, x = min(values), near[int(np.argmin(values))]
        else:
            step /= 2
    w, theta = T.fit_ordinal(rows, grade, 2, steps=3000, ridge=0.01, weight=weight)
    assert np.allclose([*w, *theta], [x[0], x[1], x[2], x[2] + np.exp(x[3])], atol=0.01)


def test_margins_grade_by_strength_and_not_by_number():
    """Feature 0 is found in toxic texts only, 1 to 3 in clean ones as well: one strong word outweighs three weak ones."""
    rows = [[0]] * 60 + [[1, 2, 3]] * 60 + [[1], [2], [3], []] * 60
    y = np.array([1] * 120 + [0] * 240)
    rows, order = [np.array(r, dtype=np.int64) for r in rows], np.random.default_rng(1).permutation(360)
    margin = T.held_out_margins([rows[i] for i in order], y[order], 4, np.ones(360))
    by = dict(zip(order.tolist(), margin))
    assert min(by[i] for i in range(60)) > max(max(by[i] for i in range(120, 360)), 0)
    assert T.held_out_margins(rows[:1], y[:1], 4, np.ones(1)).tolist() == [0.0]


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{n}.parquet") for n in ("documents", "labels"))
    model = T.fit(docs, labels.where("doc_id % 4 != 0"))
    held = labels.where("doc_id % 4 = 0").join(docs.select("doc_id", "text"), "doc_id")
    rows = held.select("toxic", model.column(F.col("text")).alias("t")).collect()
    bad, clean = [r.t for r in rows if r.toxic], [r.t for r in rows if not r.toxic]
    assert np.mean([t.toxic for t in bad]) > 0.85 and np.mean([t.toxic for t in clean]) < 0.02
    assert np.mean([t.severity for t in bad]) > 1.0 > 0.1 > np.mean([t.severity for t in clean])
    assert all(t.toxic == (t.grade >= 1) for t in bad + clean)


def test_grades_are_ordered_and_rows_kept(spark):
    texts = [(i, "nice calm day " + ("awful " if i % 4 == 0 else "") + ("vile rotten " if i % 8 == 0 else "") + f"n{i}", 7)
             for i in range(80)]
    docs = spark.createDataFrame(texts + [(None, None, 7), (200, "", 7), (1, texts[1][1], 7), (300, "awful " * 50_000, 7)],
                                 "doc_id long, text string, grade int")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(80)] + [(None, 1), (5, None), (999, 1)],
                                   "doc_id long, toxic int")
    got = T.grade_documents(docs, labels).collect()
    assert len(got) == 84
    by = {r.doc_id: r for r in got}
    assert by[0].severity > by[4].severity > 0.5 > by[1].severity and by[300].toxic and not by[200].toxic
    assert T.grade_documents(docs.limit(0), labels).count() == 0
    assert not any(r.toxic for r in T.grade_documents(docs, labels.limit(0)).collect())


def _some(n, every):
    return [(i, ("awful vile " if i % every == 0 else "nice calm ") + f"day n{i}") for i in range(n)]


def test_labels_of_other_documents_take_no_places(spark):
    docs = spark.createDataFrame(_some(80, 4), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(80)] + [(i, 0) for i in range(1000, 9000)],
                                   "doc_id long, toxic int")
    got = {r.doc_id: r.toxic for r in T.grade_documents(docs, labels, train_rows=100).collect()}
    assert got == {i: i % 4 == 0 for i in range(80)}


def test_a_rare_class_has_training_rows(spark):
    docs = spark.createDataFrame(_some(6000, 300), "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 300 = 0) as toxic")
    got = {r.doc_id: r.toxic for r in T.grade_documents(docs, labels, train_rows=100).collect()}
    assert got == {i: i % 300 == 0 for i in range(6000)}
    for n in ({0: 5, 1: 3}, {0: 1, 1: 9999}, {0: 10**9, 1: 2}, {0: 70, 1: 70}, {0: 10**9, 1: 10**7}):
        places = T.class_places(n, 100)
        assert sum(places.values()) == min(100, sum(n.values())) and all(1 <= places[c] <= n[c] for c in n)
        assert all(places[c] >= min(n[c], 10) for c in n)


def test_a_class_without_documents_is_reported(spark):
    docs = spark.createDataFrame([(i, "nice calm day") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 20)) for i in range(40)], "doc_id long, toxic int")
    with pytest.warns(UserWarning, match=r"labels \[1\] exist"):
        assert not any(r.toxic for r in T.grade_documents(docs, labels).collect())
