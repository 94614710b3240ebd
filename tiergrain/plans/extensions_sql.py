"""DuckDB oracle CTEs for the extensions and the operator keys."""

from __future__ import annotations

from tiergrain.plans import insurance_sql  # noqa: F401  (insurance CTEs)
from tiergrain.plans import investment_sql  # noqa: F401  (investment CTEs)
from tiergrain.plans.insurance_sql import ASOF_DATE, P
from tiergrain.plans.oracle import cte
from tiergrain.plans.oracle_rules import FAILS

BASE = P.base_currency

cte("ext_sector_allocation", """
SELECT fund_id, fund_name, sector, sum(notional_value) AS sector_notional, count(*) AS trade_count,
       sum(sum(notional_value)) OVER (PARTITION BY fund_id) AS fund_notional,
       sum(notional_value) / NULLIF(sum(sum(notional_value)) OVER (PARTITION BY fund_id), 0) * 100 AS share_pct
FROM silver_enriched_trades GROUP BY fund_id, fund_name, sector""", ["silver_enriched_trades"])

cte("ext_loss_ratio_rule", f"""
SELECT 'Loss Ratio Limit' AS rule_name, {P.min_loss_ratio_threshold!r}e0 AS threshold, v AS actual_value,
       v > {P.min_loss_ratio_threshold!r}e0 AS is_breached,
       (v > {P.min_loss_ratio_threshold * P.near_breach_factor!r}e0) AND NOT (v > {P.min_loss_ratio_threshold!r}e0)
         AS is_near_breach,
       CAST(policy_year AS VARCHAR) AS entity, {ASOF_DATE} AS check_date,
       CASE WHEN v > {P.min_loss_ratio_threshold!r}e0 THEN 'CRITICAL'
            WHEN (v > {P.min_loss_ratio_threshold * P.near_breach_factor!r}e0) THEN 'WARNING' ELSE 'CLEAR' END
         AS severity
FROM (SELECT pr.policy_year, lo.incurred / NULLIF(pr.nwp, 0) AS v
      FROM (SELECT policy_year, sum(net_premium) AS nwp FROM bound_policies GROUP BY 1) pr
      LEFT JOIN (SELECT CAST(year(loss_date) AS INTEGER) AS policy_year, sum(incurred_amount) AS incurred
                 FROM silver_claims_enriched GROUP BY 1) lo ON pr.policy_year = lo.policy_year) x""",
    ["bound_policies", "silver_claims_enriched"])

cte("ext_fx_daily", f"""
SELECT ccy, rate_date, avg(direct) AS direct, avg(recip) AS recip
FROM (SELECT from_currency AS ccy, rate_date, rate AS direct, CAST(NULL AS DOUBLE) AS recip
      FROM silver_fx_rates WHERE to_currency = '{BASE}'
      UNION ALL
      SELECT to_currency AS ccy, rate_date, CAST(NULL AS DOUBLE) AS direct, rate AS recip
      FROM silver_fx_rates WHERE from_currency = '{BASE}') u
GROUP BY ccy, rate_date""", ["silver_fx_rates"])

cte("ext_base_currency_notional", f"""
SELECT t.trade_id, t.trade_date, t.currency, t.notional_value,
       CASE WHEN t.currency = '{BASE}' THEN 1.0e0 ELSE coalesce(d.direct, 1.0e0 / NULLIF(r.recip, 0)) END AS fx_rate,
       t.notional_value * (CASE WHEN t.currency = '{BASE}' THEN 1.0e0
                                ELSE coalesce(d.direct, 1.0e0 / NULLIF(r.recip, 0)) END) AS notional_base
FROM (SELECT trade_id, trade_date, currency, notional_value, CAST(trade_date AS DATE) AS day
      FROM silver_enriched_trades) t
ASOF LEFT JOIN (SELECT ccy, rate_date, direct FROM ext_fx_daily WHERE direct IS NOT NULL) d
  ON t.currency = d.ccy AND t.day >= d.rate_date
ASOF LEFT JOIN (SELECT ccy, rate_date, recip FROM ext_fx_daily WHERE recip IS NOT NULL) r
  ON t.currency = r.ccy AND t.day >= r.rate_date""", ["silver_enriched_trades", "ext_fx_daily"])

cte("ext_loss_ratio_by_policy", """
SELECT pr.lob_id, pr.policy_year, pr.lob_name, pr.gwp, pr.nwp, pr.policy_count,
       lo.incurred_losses, lo.paid_losses, lo.claim_count,
       lo.incurred_losses / NULLIF(pr.nwp, 0) AS loss_ratio
FROM (SELECT lob_id, lob_name, lob_segment, policy_year, sum(gross_premium) AS gwp, sum(net_premium) AS nwp,
             count(*) AS policy_count
      FROM bound_policies GROUP BY lob_id, lob_name, lob_segment, policy_year) pr
LEFT JOIN (SELECT p.lob_id, p.policy_year, sum(c.incurred_amount) AS incurred_losses,
                  sum(c.paid_amount) AS paid_losses, count(*) AS claim_count
           FROM silver_claims_enriched c JOIN silver_enriched_policies p ON c.policy_id = p.policy_id
           GROUP BY p.lob_id, p.policy_year) lo
  ON pr.lob_id = lo.lob_id AND pr.policy_year = lo.policy_year""",
    ["bound_policies", "silver_claims_enriched", "silver_enriched_policies"])

cte("ext_orphan_claims", """
SELECT claim_id, policy_id, loss_date, peril, incurred_amount FROM silver_claims_enriched c
WHERE NOT EXISTS (SELECT 1 FROM silver_enriched_policies p WHERE p.policy_id = c.policy_id)""",
    ["silver_claims_enriched", "silver_enriched_policies"])

cte("ext_paid_triangle", """
SELECT accident_year, development_month, paid, claim_count,
       sum(paid) OVER (PARTITION BY accident_year ORDER BY development_month
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_paid
FROM (SELECT CAST(year(loss_date) AS INTEGER) AS accident_year, development_month,
             sum(paid_amount) AS paid, count(*) AS claim_count
      FROM silver_claims_enriched GROUP BY 1, 2) t""", ["silver_claims_enriched"])

cte("ext_running_incurred", """
SELECT claim_id, cumulative_paid_rank, loss_date, incurred_amount,
       sum(incurred_amount) OVER (PARTITION BY claim_id ORDER BY cumulative_paid_rank
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_incurred
FROM silver_claims_enriched""", ["silver_claims_enriched"])

cte("ext_earned_premium", f"""
SELECT lob_id, policy_year, sum(gross_premium) AS gwp,
       sum(gross_premium * least(greatest(
           CAST(date_diff('day', CAST(inception_date AS DATE), least(expiry_date, {ASOF_DATE})) AS DOUBLE)
           / NULLIF(CAST(date_diff('day', CAST(inception_date AS DATE), expiry_date) AS DOUBLE), 0), 0.0e0), 1.0e0))
         AS earned_premium,
       count(*) AS policy_count
FROM bound_policies GROUP BY lob_id, policy_year""", ["bound_policies"])

cte("ext_claim_versions", """
SELECT claim_id, cumulative_paid_rank, loss_date AS valid_from,
       lead(loss_date) OVER (PARTITION BY claim_id ORDER BY cumulative_paid_rank) AS valid_to,
       lead(loss_date) OVER (PARTITION BY claim_id ORDER BY cumulative_paid_rank) IS NULL AS is_current,
       incurred_amount, status
FROM silver_claims_enriched""", ["silver_claims_enriched"])

cte("ext_reinsurance_split", """
SELECT reinsurer_id, reinsurer_name, cession_rate,
       cession_rate / NULLIF((SELECT sum(cession_rate) FROM raw_reinsurers), 0) AS share,
       cession_rate / NULLIF((SELECT sum(cession_rate) FROM raw_reinsurers), 0)
         * (SELECT sum(ceded_premium) FROM bound_policies) AS ceded_premium
FROM raw_reinsurers""", ["raw_reinsurers", "bound_policies"])

cte("ext_exposure_by_rating", """
SELECT credit_rating, counterparty_id, sum(notional_value) AS total_exposure, count(*) AS trade_count,
       CAST(grouping(credit_rating, counterparty_id) AS BIGINT) AS grouping_level
FROM silver_enriched_trades GROUP BY ROLLUP (credit_rating, counterparty_id)""", ["silver_enriched_trades"])

cte("ext_cat_pml_by_territory", """
SELECT territory, sum(cat_tiv) AS cat_tiv, sum(cat_pml) AS cat_pml, count(*) AS perils
FROM latest_exposure GROUP BY territory""", ["latest_exposure"])

_viol = "concat_ws(', ', " + ", ".join(
    f"CASE WHEN {fails} THEN '{rule}' END" for rule, fails in FAILS["silver_enriched_policies"][1].items()) + ")"
cte("split_policies", f"""
SELECT CASE WHEN violations = '' THEN 'clean' ELSE 'quarantine' END AS side, violations, count(*) AS row_count
FROM (SELECT {_viol} AS violations FROM enriched_policies_unfiltered) t
GROUP BY 1, 2""", ["enriched_policies_unfiltered"])

AUDIT_CHECKS = {
    "raw_trade_executions": {"null_trade_id": "trade_id IS NULL", "negative_quantity": "quantity < 0",
                             "negative_price": "price < 0"},
    "raw_market_data": {"null_security_id": "security_id IS NULL", "negative_close_price": "close_price < 0",
                        "negative_volume": "volume < 0"},
    "raw_fx_rates": {"null_rate_date": "rate_date IS NULL", "null_currency": "from_currency IS NULL",
                     "non_positive_rate": "rate <= 0"},
}
AUDIT_TABLES = ("raw_trade_executions", "raw_securities_master", "raw_market_data", "raw_fx_rates",
                "raw_counterparties", "raw_fund_structures", "raw_lines_of_business", "raw_brokers",
                "raw_reinsurers", "raw_policies", "raw_claims", "raw_exposure_accumulations")


def _audit_sql() -> str:
    parts = []
    for t in AUDIT_TABLES:
        checks = AUDIT_CHECKS.get(t)
        if not checks:
            parts.append(f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST(NULL AS VARCHAR) AS \"check\", "
                         f"CAST(NULL AS BIGINT) AS matching FROM {t}")
            continue
        for c, e in checks.items():
            parts.append(f"SELECT '{t}' AS table_name, count(*) AS row_count, '{c}' AS \"check\", "
                         f"CAST(count(*) FILTER (WHERE coalesce(({e}), false)) AS BIGINT) AS matching FROM {t}")
    return "\nUNION ALL\n".join(parts)


cte("audit_raw_tables", _audit_sql(), AUDIT_TABLES)

cte("bars_daily_quotes", """
SELECT user_id AS security_key, day,
       max(CASE WHEN rn_first = 1 THEN value END) AS open_price, max(value) AS high_price,
       min(value) AS low_price, max(CASE WHEN rn_last = 1 THEN value END) AS close_price,
       CAST(sum(CASE WHEN event_id % 127 = 0 THEN 0 ELSE 100 + event_id * 10 END) AS BIGINT) AS volume, count(*) AS quotes
FROM (SELECT user_id, event_id, value, CAST(ts AS DATE) AS day,
             row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn_first,
             row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn_last
      FROM events) e
GROUP BY user_id, day""", [])


cte("synth_fx_date_spine", """
SELECT from_currency, to_currency, CAST(d AS DATE) AS rate_date
FROM (SELECT p.from_currency, p.to_currency, unnest(generate_series(s.d0, s.d1, INTERVAL 1 DAY)) AS d
      FROM (SELECT DISTINCT from_currency, to_currency FROM raw_fx_rates
            WHERE from_currency IS NOT NULL AND to_currency IS NOT NULL) p,
           (SELECT min(rate_date) AS d0, max(rate_date) AS d1 FROM raw_fx_rates) s) x
WHERE dayofweek(d) BETWEEN 1 AND 5""", ["raw_fx_rates"])
