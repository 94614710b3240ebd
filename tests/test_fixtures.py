"""Expected counts at sf0.01 (FIXTURES.md §3-§4)."""

from pyspark.sql import functions as F

from tiergrain.plans.registry import REGISTRY, INS_DOUBLES, INV_DOUBLES, insurance, investment
from tiergrain.functions.exprs import double_columns

from conftest import SF01


def test_quarantine_histogram(spark):
    q = insurance(spark, SF01)["quarantine_policies"]
    got = {r.failure_reasons: r["count"] for r in q.groupBy("failure_reasons").count().collect()}
    assert got == {
        "invalid_limit": 281, "invalid_limit, orphan_lob": 16, "invalid_premium": 542,
        "invalid_premium, invalid_limit": 13, "invalid_premium, orphan_lob": 29, "null_policy_id": 404,
        "null_policy_id, invalid_limit": 10, "null_policy_id, invalid_premium": 17,
        "null_policy_id, invalid_premium, orphan_lob": 1, "null_policy_id, orphan_lob": 23, "orphan_lob": 693}


def test_violation_counts(spark):
    got = {(r.dataset, r.rule): r.failed for r in REGISTRY["dq_silver_enriched_trades"].build(spark, SF01).collect()}
    assert got[("silver_enriched_trades", "valid_trade_type")] == 2881
    assert got[("silver_enriched_trades", "valid_notional")] == 1843
    got = {r.rule: r.failed for r in REGISTRY["dq_silver_exposure"].build(spark, SF01).collect()}
    assert got == {"positive_tiv": 44, "positive_pml": 56, "pml_lte_tiv": 113}


def test_claims_ranks(spark):
    c = insurance(spark, SF01)["silver_claims_enriched"]
    r = c.agg(F.count("*").alias("n"), F.max("cumulative_paid_rank").alias("mx"),
              F.count_if(F.col("cumulative_paid_rank") > 1).alias("gt1")).first()
    assert (r.n, r.mx, r.gt1) == (53862, 6, 12735)


def test_compliance_severities(spark):
    g = insurance(spark, SF01)["gold_compliance_checks"]
    got = {(r.rule_name, r.severity): r["count"] for r in g.groupBy("rule_name", "severity").count().collect()}
    assert got[("Single Risk Limit", "CRITICAL")] == 131 and got[("Single Risk Limit", "WARNING")] == 174
    assert got[("Peril Concentration Limit", "CRITICAL")] == 3 and got[("Aggregate Limit", "WARNING")] == 1


def test_double_lists_match_schemas(spark):
    inv = investment(spark, SF01)
    for name, cols in INV_DOUBLES.items():
        assert double_columns(inv[name]) == cols, name
    ins = insurance(spark, SF01)
    for name, cols in INS_DOUBLES.items():
        assert double_columns(ins[name]) == cols, name


def test_claim_ranks_with_hot_key_path(spark):
    """Day slices give the ranks of the plain window."""
    from tiergrain.params import TEST_PARAMS
    from tiergrain.plans.insurance import InsuranceDatasets
    from tiergrain.sources.bindings import raw_tables
    p = InsuranceDatasets(raw_tables(spark, SF01), TEST_PARAMS.replace(claim_slice_days=30))
    plain = InsuranceDatasets(raw_tables(spark, SF01), TEST_PARAMS.replace(claim_slice_days=None))
    cols = ["claim_id", "loss_date", "incurred_amount", "paid_amount", "reserve_amount", "policy_id",
            "cumulative_paid_rank"]
    a = p["silver_claims_enriched"].select(*cols)
    b = plain["silver_claims_enriched"].select(*cols)
    assert a.count() == 53862
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
