"""The large-data paths give the same rows as the small-data paths.

* broadcast disabled everywhere (static and AQE thresholds off):
  every join is a sort-merge join;
* the plans contain no cartesian / nested-loop join.
"""

import pytest

from tiergrain.functions.exprs import stabilize_doubles
from tiergrain.params import TEST_PARAMS
from tiergrain.plans.insurance import InsuranceDatasets
from tiergrain.plans.investment import InvestmentDatasets
from tiergrain.sources.bindings import raw_tables

from conftest import SF01

CONFS = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def _rows(df):
    return stabilize_doubles(df)


@pytest.mark.parametrize("cls,name", [
    (InvestmentDatasets, "gold_portfolio_summary"),
    (InvestmentDatasets, "gold_market_performance"),
    (InsuranceDatasets, "gold_exposure_summary"),
    (InsuranceDatasets, "gold_underwriting_summary"),
])
def test_shuffle_join_path_equals_broadcast_path(spark, cls, name):
    small = _rows(cls(raw_tables(spark, SF01), TEST_PARAMS)[name])
    expected = small.collect()
    old = {k: spark.conf.get(k, None) for k in CONFS}
    try:
        for k, v in CONFS.items():
            spark.conf.set(k, v)
        big = _rows(cls(raw_tables(spark, SF01), TEST_PARAMS)[name])
        got = big.collect()
        plan = big._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "SortMergeJoin" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert sorted(map(str, got)) == sorted(map(str, expected))


def test_bucketed_dimension_is_not_shuffled(spark):
    import tempfile
    from pyspark.sql import functions as F
    from tiergrain.operators.relational import left_lookup
    from tiergrain.sources.sinks import write_bucketed
    old = {k: spark.conf.get(k, None) for k in CONFS}
    try:
        for k, v in CONFS.items():
            spark.conf.set(k, v)
        dim = spark.range(1000).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("k"),
                                       (F.col("id") * 2).alias("v"))
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        table = write_bucketed(dim, "tg_test_bucketed_dim", "k", n, tempfile.mkdtemp(prefix="tg-dim-") + "/d")
        fact = spark.range(5000).select(F.concat(F.lit("K"), (F.col("id") % 1200).cast("string")).alias("k"))
        out = left_lookup(fact, table, "k", "k", ["v"])
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert len(rows) == 5000 and sum(r.v is None for r in rows) == 800   # keys K1000..K1199 have no match
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1, plan   # the fact side only


def test_streaming_star_join_with_bucketed_dimensions(spark):
    from tiergrain.plans.streams import InvestmentStreams
    old = {k: spark.conf.get(k, None) for k in CONFS}
    try:
        for k, v in CONFS.items():
            spark.conf.set(k, v)
        st = InvestmentStreams(spark, SF01, TEST_PARAMS.replace(stream_dimension_bytes=0))
        got = _rows(st.table("silver_enriched_trades")).collect()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    exp = _rows(InvestmentDatasets(raw_tables(spark, SF01), TEST_PARAMS)["silver_enriched_trades"]).collect()
    assert sorted(map(str, got)) == sorted(map(str, exp))
