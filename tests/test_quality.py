import math

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tiergrain.operators.quality import (DROP, WARN, RuleSet, expect, expect_or_drop, observed_counts,
                                         quarantine, split, tag_violations, violation_counts)

RULES = RuleSet.of("t", DROP, {"has_id": "id IS NOT NULL", "positive": "amount > 0"})


def frame(spark):
    rows = [(1, 10.0), (2, -1.0), (None, 5.0), (4, None), (5, float("nan")), (6, 0.0)]
    return spark.createDataFrame(rows, "id int, amount double")


def test_null_is_a_violation_and_nan_passes(spark):
    kept = expect_or_drop(frame(spark), RULES).collect()
    ids = sorted(r.id for r in kept)
    assert ids == [1, 5]  # NaN > 0 is true in Spark, null amount fails
    assert math.isnan([r.amount for r in kept if r.id == 5][0])


def test_warn_keeps_every_row(spark):
    df = frame(spark)
    obs = Observation("warn")
    out = expect(df, RuleSet("t", WARN, RULES.rules), obs)
    assert out.count() == 6
    counts = {c["rule"]: c["failed"] for c in observed_counts(obs, RULES)}
    assert counts == {"has_id": 1, "positive": 3}


def test_violation_counts_frame(spark):
    rows = {r.rule: (r.evaluated, r.failed, r.mode) for r in violation_counts(frame(spark), RULES).collect()}
    assert rows == {"has_id": (6, 1, DROP), "positive": (6, 3, DROP)}


def test_violation_counts_empty_input(spark):
    empty = frame(spark).filter(F.lit(False))
    rows = violation_counts(empty, RULES).collect()
    assert [(r.evaluated, r.failed) for r in rows] == [(0, 0), (0, 0)]


def test_drop_observation_counts_before_filter(spark):
    obs = Observation("drop")
    out = expect_or_drop(frame(spark), RULES, obs)
    assert out.count() == 2
    got = observed_counts(obs, RULES)
    assert got[0]["evaluated"] == 6


def test_quarantine_reasons_in_order(spark):
    reasons = [("no_id", F.col("id").isNull()), ("bad_amount", (F.col("amount") <= 0) | F.col("amount").isNull())]
    q = quarantine(frame(spark), reasons, F.lit("2001-06-30").cast("date"))
    got = {r.id: r.failure_reasons for r in q.collect()}
    assert got == {2: "bad_amount", None: "no_id", 4: "bad_amount", 6: "bad_amount"}


def test_split_is_lossless(spark):
    df = frame(spark)
    clean, bad = split(df, RULES)
    assert clean.count() + bad.count() == df.count()
    assert clean.count() == expect_or_drop(df, RULES).count()
    tags = {r.id: list(r._violations) for r in tag_violations(df, RULES).collect()}
    assert tags[None] == ["has_id"] and tags[4] == ["positive"] and tags[1] == []
