"""Conservation properties at sf0.01, and a property
test of rule semantics against a plain-Python model."""

import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tiergrain.operators.quality import DROP, RuleSet, expect_or_drop, split, violation_counts
from tiergrain.plans.registry import insurance, investment

from conftest import SF01


@pytest.fixture(scope="module")
def inv(spark):
    return investment(spark, SF01)


@pytest.fixture(scope="module")
def ins(spark):
    return insurance(spark, SF01)


def test_trades_in_equals_kept_plus_dropped(inv):
    from tiergrain.plans.investment import enriched_trades_unfiltered
    un = enriched_trades_unfiltered(inv["bronze_trade_executions"], inv["silver_securities_master"],
                                    inv["silver_counterparties"], inv["silver_fund_structures"], inv.params)
    assert un.count() == inv["bronze_trade_executions"].count() == 60000
    kept = inv["silver_enriched_trades"].count()
    assert kept == 54640


def test_gold_sums_equal_silver_sums(inv):
    silver = inv["silver_enriched_trades"].agg(F.sum("notional_value").alias("n"), F.count("*").alias("c")).first()
    port = inv["gold_portfolio_summary"].agg(F.sum("total_notional").alias("n")).first()
    settle = inv["gold_settlement_status"].agg(F.sum("total_notional").alias("n"),
                                               F.sum("trade_count").alias("c")).first()
    daily = inv["gold_daily_trading_activity"].agg(F.sum("trade_count").alias("c")).first()
    assert math.isclose(port.n, silver.n, rel_tol=1e-12) and math.isclose(settle.n, silver.n, rel_tol=1e-12)
    assert settle.c == silver.c == daily.c


def test_buy_plus_sell_is_total(inv):
    g = inv["gold_counterparty_exposure"]
    bad = g.filter(F.abs(F.col("buy_exposure") + F.col("sell_exposure") - F.col("total_exposure"))
                   > F.abs(F.col("total_exposure")) * 1e-12)
    assert bad.count() == 0


def test_policy_counts_conserved(ins):
    bound = ins["silver_enriched_policies"].filter(F.col("status") == "BOUND")
    n_bound = bound.count()
    assert ins["gold_exposure_summary"].agg(F.sum("policy_count")).first()[0] == n_bound
    rows = ins["gold_compliance_checks"].count()
    distinct = sum(bound.select(c).distinct().count() for c in ("insured_name", "peril", "territory"))
    assert rows == distinct


def test_clean_and_quarantine_partition_all(ins):
    df = ins.unfiltered("silver_enriched_policies")
    clean, bad = split(df, ins.rules("silver_enriched_policies"))
    assert clean.count() + bad.count() == df.count() == 15000
    assert clean.count() == ins["silver_enriched_policies"].count() == 12800


values = st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=False, width=32), st.integers(-3, 3))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), values), min_size=0, max_size=25))
def test_rules_match_python_model(spark, rows):
    rows = [(k, None if v is None else float(v)) for k, v in rows]
    rules = RuleSet.of("p", DROP, {"has_k": "k IS NOT NULL", "pos": "v > 0"})
    df = spark.createDataFrame(rows, "k int, v double")

    def passes_pos(v):
        return v is not None and (math.isnan(v) or v > 0)   # NaN is the largest double in Spark

    kept = [(r.k, r.v) for r in expect_or_drop(df, rules).collect()]
    exp = [(k, v) for k, v in rows if k is not None and passes_pos(v)]
    assert len(kept) == len(exp)
    counts = {r.rule: (r.evaluated, r.failed) for r in violation_counts(df, rules).collect()}
    assert counts["has_k"] == (len(rows), sum(k is None for k, _ in rows))
    assert counts["pos"] == (len(rows), sum(not passes_pos(v) for _, v in rows))
