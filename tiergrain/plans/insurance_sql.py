"""DuckDB oracle CTEs for the insurance datasets (test parameters)."""

from __future__ import annotations

from tiergrain.params import TEST_PARAMS
from tiergrain.plans.insurance import BRONZE_SOURCES
from tiergrain.plans.oracle import cte
from tiergrain.plans.oracle_rules import FAILS, kept

P = TEST_PARAMS
ASOF_TS = f"TIMESTAMP '{P.as_of:%Y-%m-%d %H:%M:%S}'"
ASOF_DATE = f"DATE '{P.as_of_date:%Y-%m-%d}'"

for _ds, _raw in BRONZE_SOURCES.items():
    cte(_ds, f"SELECT * FROM {_raw}", [_raw])

cte("enriched_policies_unfiltered", f"""
SELECT p.broker_id, p.lob_id, p.policy_id, p.insured_name, p.territory, p.inception_date, p.currency,
       p.gross_premium, p.limit_amount, p.deductible, p.peril, p.status, p.expiry_date,
       l.lob_name, l.segment AS lob_segment, b.broker_name, b.rating AS broker_rating,
       c.rate AS cession_rate,
       p.gross_premium * c.rate AS ceded_premium,
       p.gross_premium - p.gross_premium * c.rate AS net_premium,
       p.gross_premium / NULLIF(p.limit_amount, 0) * 100 AS rate_on_line,
       CAST(year(p.inception_date) AS INTEGER) AS policy_year,
       CAST(date_trunc('month', p.inception_date) AS DATE) AS inception_month
FROM bronze_policies p
LEFT JOIN bronze_lines_of_business l ON p.lob_id = l.lob_id
LEFT JOIN raw_brokers b ON p.broker_id = b.broker_id
CROSS JOIN (SELECT coalesce(nullif(avg(cession_rate), 0), {P.default_cession_rate!r}e0) AS rate
            FROM raw_reinsurers) c""",
    ["bronze_policies", "bronze_lines_of_business", "raw_brokers", "raw_reinsurers"])

cte("silver_enriched_policies", f"""
SELECT * FROM enriched_policies_unfiltered WHERE {kept('silver_enriched_policies')}""",
    ["enriched_policies_unfiltered"])

cte("quarantine_policies", f"""
SELECT p.lob_id, p.policy_id, p.broker_id, p.insured_name, p.territory, p.inception_date, p.currency,
       p.gross_premium, p.limit_amount, p.deductible, p.peril, p.status, p.expiry_date, l.lob_name,
       concat_ws(', ',
         CASE WHEN p.policy_id IS NULL THEN 'null_policy_id' END,
         CASE WHEN p.gross_premium <= 0 OR p.gross_premium IS NULL THEN 'invalid_premium' END,
         CASE WHEN p.limit_amount <= 0 OR p.limit_amount IS NULL THEN 'invalid_limit' END,
         CASE WHEN l.lob_name IS NULL THEN 'orphan_lob' END) AS failure_reasons,
       {ASOF_TS} AS quarantined_at
FROM bronze_policies p
LEFT JOIN bronze_lines_of_business l ON p.lob_id = l.lob_id
WHERE p.policy_id IS NULL OR p.gross_premium <= 0 OR p.gross_premium IS NULL
   OR p.limit_amount <= 0 OR p.limit_amount IS NULL OR l.lob_name IS NULL""",
    ["bronze_policies", "bronze_lines_of_business"])

cte("claims_derived", f"""
SELECT *,
       CAST(loss_date AS DATE) AS loss_date_only,
       CAST(date_diff('day', CAST(loss_date AS DATE), CAST(notification_date AS DATE)) AS INTEGER)
         AS notification_lag_days,
       CASE WHEN reserve_amount >= incurred_amount - paid_amount THEN 'ADEQUATE' ELSE 'DEFICIENT' END
         AS reserve_adequacy,
       CAST(date_diff('day', CAST(loss_date AS DATE), {ASOF_DATE}) AS INTEGER) AS claim_age_days
FROM bronze_claims""", ["bronze_claims"])

cte("claims_ranked", """
SELECT *,
       CASE WHEN claim_age_days < 90 THEN '0-90 days' WHEN claim_age_days < 180 THEN '90-180 days'
            WHEN claim_age_days < 365 THEN '180-365 days' WHEN claim_age_days < 730 THEN '1-2 years'
            ELSE '2+ years' END AS claim_age_bucket,
       CASE WHEN incurred_amount < 50000 THEN 'Attritional' WHEN incurred_amount < 500000 THEN 'Medium'
            WHEN incurred_amount < 2000000 THEN 'Large' ELSE 'Catastrophe' END AS severity_band,
       CAST(floor(claim_age_days / 30.0e0) AS INTEGER) AS development_month,
       CAST(row_number() OVER (PARTITION BY claim_id ORDER BY
            loss_date ASC NULLS FIRST, incurred_amount ASC NULLS FIRST, paid_amount ASC NULLS FIRST,
            reserve_amount ASC NULLS FIRST, notification_date ASC NULLS FIRST, policy_id ASC NULLS FIRST,
            peril ASC NULLS FIRST, territory ASC NULLS FIRST, status ASC NULLS FIRST,
            adjuster ASC NULLS FIRST, cause_code ASC NULLS FIRST) AS INTEGER) AS cumulative_paid_rank
FROM claims_derived""", ["claims_derived"])

cte("silver_claims_enriched", f"""
SELECT * FROM claims_ranked WHERE {kept('silver_claims_enriched')}""", ["claims_ranked"])

cte("exposure_unfiltered", """
SELECT *,
       probable_max_loss / NULLIF(total_insured_value, 0) AS pml_ratio,
       CAST(date_trunc('quarter', as_of_date) AS DATE) AS exposure_quarter
FROM bronze_exposure""", ["bronze_exposure"])

cte("silver_exposure", f"""
SELECT * FROM exposure_unfiltered WHERE {kept('silver_exposure')}""", ["exposure_unfiltered"])

cte("bound_policies", """
SELECT * FROM silver_enriched_policies WHERE status = 'BOUND'""", ["silver_enriched_policies"])

cte("gold_underwriting_summary", f"""
SELECT pr.policy_year, pr.lob_id, pr.lob_name, pr.lob_segment, pr.gwp, pr.nwp, pr.ceded_premium,
       pr.policy_count, pr.avg_rate_on_line, pr.total_limit,
       lo.peril, lo.incurred_losses, lo.paid_losses, lo.outstanding_reserves, lo.claim_count,
       lo.avg_notification_lag,
       lo.incurred_losses / NULLIF(pr.nwp, 0) AS loss_ratio,
       {P.expense_ratio!r}e0 AS expense_ratio,
       lo.incurred_losses / NULLIF(pr.nwp, 0) + {P.expense_ratio!r}e0 AS combined_ratio,
       pr.nwp - lo.incurred_losses - pr.nwp * {P.expense_ratio!r}e0 AS underwriting_profit
FROM (SELECT lob_id, lob_name, lob_segment, policy_year,
             sum(gross_premium) AS gwp, sum(net_premium) AS nwp, sum(ceded_premium) AS ceded_premium,
             count(*) AS policy_count, avg(rate_on_line) AS avg_rate_on_line, sum(limit_amount) AS total_limit
      FROM bound_policies GROUP BY lob_id, lob_name, lob_segment, policy_year) pr
LEFT JOIN (SELECT peril, CAST(year(loss_date) AS INTEGER) AS loss_year,
                  sum(incurred_amount) AS incurred_losses, sum(paid_amount) AS paid_losses,
                  sum(reserve_amount) AS outstanding_reserves, count(*) AS claim_count,
                  avg(notification_lag_days) AS avg_notification_lag
           FROM silver_claims_enriched GROUP BY peril, CAST(year(loss_date) AS INTEGER)) lo
  ON pr.policy_year = lo.loss_year""", ["bound_policies", "silver_claims_enriched"])


def _rule_sql(name: str, key: str, value: str, agg: str, threshold: float) -> str:
    near = threshold * P.near_breach_factor
    return f"""
SELECT '{name}' AS rule_name, {threshold!r}e0 AS threshold, {value} AS actual_value,
       {value} > {threshold!r}e0 AS is_breached,
       ({value} > {near!r}e0) AND NOT ({value} > {threshold!r}e0) AS is_near_breach,
       {key} AS entity
FROM (SELECT {key}, {agg} FROM bound_policies GROUP BY {key}) g, total_gwp"""


def _e(x: float) -> float:
    return float(x)


cte("total_gwp", """
SELECT coalesce(nullif(sum(gross_premium), 0), 1.0e0) AS total FROM bound_policies""", ["bound_policies"])

cte("gold_compliance_checks", f"""
SELECT *, {ASOF_DATE} AS check_date,
       CASE WHEN is_breached THEN 'CRITICAL' WHEN is_near_breach THEN 'WARNING' ELSE 'CLEAR' END AS severity
FROM ({_rule_sql('Single Risk Limit', 'insured_name', 'total_premium / total * 100',
                 'sum(limit_amount) AS total_limit, sum(gross_premium) AS total_premium',
                 _e(P.max_single_risk_pct))}
      UNION ALL {_rule_sql('Peril Concentration Limit', 'peril', 'peril_premium / total * 100',
                           'sum(gross_premium) AS peril_premium', _e(P.max_peril_concentration_pct))}
      UNION ALL {_rule_sql('Aggregate Limit', 'territory', 'aggregate_limit',
                           'sum(limit_amount) AS aggregate_limit', _e(P.max_aggregate_limit_usd))}) r""",
    ["bound_policies", "total_gwp"])

cte("latest_exposure", """
SELECT territory, peril, total_insured_value AS cat_tiv, probable_max_loss AS cat_pml, model_source AS cat_model
FROM (SELECT *, row_number() OVER (PARTITION BY territory, peril
                                   ORDER BY as_of_date DESC NULLS LAST, exposure_id DESC NULLS LAST) AS rn
      FROM silver_exposure) x
WHERE rn = 1""", ["silver_exposure"])

cte("gold_exposure_summary", f"""
SELECT pe.territory, pe.peril, pe.lob_name, pe.total_limit, pe.total_gwp, pe.total_nwp, pe.policy_count,
       le.cat_tiv, le.cat_pml, le.cat_model, {ASOF_DATE} AS as_of_date
FROM (SELECT territory, peril, lob_name, sum(limit_amount) AS total_limit, sum(gross_premium) AS total_gwp,
             sum(net_premium) AS total_nwp, count(*) AS policy_count
      FROM bound_policies GROUP BY territory, peril, lob_name) pe
LEFT JOIN latest_exposure le ON pe.territory = le.territory AND pe.peril = le.peril""",
    ["bound_policies", "latest_exposure"])

# frames the rules of each dataset are evaluated on (rows before dropping)
RULE_FRAMES = {d: d for d in BRONZE_SOURCES if d in FAILS} | {
    "silver_enriched_policies": "enriched_policies_unfiltered",
    "silver_claims_enriched": "claims_ranked",
    "silver_exposure": "exposure_unfiltered",
}


def overridden(sql: str, single_risk_pct: float = 0.2, aggregate_limit: float = 7e9) -> str:
    """The compliance oracle under other thresholds than the test parameters."""
    for old, new in ((P.max_single_risk_pct, single_risk_pct), (P.max_aggregate_limit_usd, aggregate_limit)):
        for factor in (1.0, P.near_breach_factor):
            sql = sql.replace(f"{float(old) * factor!r}e0", f"{float(new) * factor!r}e0")
    return sql
