"""Refreshes of views and of the whole graph: what runs once, what runs together."""

import threading

import pytest
from pyspark.sql import functions as F

from tiergrain.plans import registry
from tiergrain.plans.refresh import _together


def test_a_view_published_twice_runs_its_graph_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def count(x: int) -> int:
        seen.add(1)
        return x
    rows = spark.range(0, 10, 1, 2).select(F.udf(count, "long")("id").alias("id"))
    monkeypatch.setattr(registry, "investment", lambda spark, sf_dir: {"gold_settlement_status": rows})
    got = registry._view_builder("gold_settlement_status", None)(spark, "")
    assert sorted(r.id for r in got.collect()) == list(range(10))
    assert seen.value == 10 and not rows.is_cached


def test_steps_of_a_refresh_run_together_and_failures_are_raised(spark):
    meet = threading.Barrier(2)
    one = lambda: (meet.wait(60), spark.range(3).count())[1]
    assert _together(spark, {"a": one, "b": one}) == {"a": 3, "b": 3}
    with pytest.raises(ZeroDivisionError):
        _together(spark, {"a": lambda: 1 // 0, "b": lambda: spark.range(2).count()})
