"""The rules as the oracle states them: when a row FAILS, nulls spelled out.

Written apart from the Spark rule sets, in the opposite form, so that a slip in
either shows as a difference. Dataset and rule names are fixed values.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2001-06-30 00:00:00'"


def missing(*columns: str) -> str:
    return " OR ".join(f"({c} IS NULL)" for c in columns)


def not_above(column: str, bound: str = "0") -> str:
    return f"({column} IS NULL) OR ({column} <= {bound})"


def below(column: str, bound: str = "0") -> str:
    return f"({column} IS NULL) OR ({column} < {bound})"


def exceeds(column: str, other: str) -> str:
    return f"({column} IS NULL) OR ({other} IS NULL) OR ({column} > {other})"


_TRADE = {"valid_trade_id": missing("trade_id"), "valid_trade_date": missing("trade_date"),
          "positive_quantity": not_above("quantity"), "positive_price": not_above("price")}
_SECURITY = {"valid_security_id": missing("security_id"), "valid_isin": missing("isin"),
             "valid_security_name": missing("security_name")}
_MARKET = {"valid_security_id": missing("security_id"), "valid_price_date": missing("price_date"),
           "positive_close_price": not_above("close_price")}
_RANGE = {"valid_price_range": exceeds("low_price", "high_price")}
_FX = {"valid_rate_date": missing("rate_date"), "valid_from_currency": missing("from_currency"),
       "valid_to_currency": missing("to_currency"), "positive_rate": not_above("rate")}
_PARTY = {"valid_counterparty_id": missing("counterparty_id"), "valid_counterparty_name": missing("counterparty_name"),
          "valid_lei": missing("lei")}
_FUND = {"valid_fund_id": missing("fund_id"), "valid_fund_name": missing("fund_name")}
_POLICY = {"valid_policy_id": missing("policy_id"), "valid_premium": not_above("gross_premium"),
           "valid_limit": not_above("limit_amount")}

# dataset -> (mode, rule -> failing condition)
FAILS: dict[str, tuple[str, dict[str, str]]] = {
    "bronze_trade_executions": ("warn", _TRADE | {"valid_currency": missing("currency")}),
    "bronze_securities_master": ("warn", _SECURITY | {"valid_asset_class": missing("asset_class")}),
    "bronze_market_data": ("warn", _MARKET | {"positive_volume": below("volume")} | _RANGE),
    "bronze_fx_rates": ("warn", _FX),
    "bronze_counterparties": ("warn", _PARTY | {"valid_credit_rating": missing("credit_rating")}),
    "bronze_fund_structures": ("warn", _FUND | {"valid_inception_date": missing("inception_date"),
                                                "positive_target_return": below("target_return")}),
    "silver_securities_master": ("drop", _SECURITY),
    "silver_counterparties": ("drop", _PARTY),
    "silver_fund_structures": ("drop", _FUND | {"valid_strategy": missing("strategy")}),
    "silver_enriched_trades": ("drop", _TRADE | {
        "valid_trade_type": "(trade_type IS NULL) OR (trade_type <> 'BUY' AND trade_type <> 'SELL')",
        "valid_notional": not_above("notional_value")}),
    "silver_market_data": ("drop", _MARKET | {"positive_open_price": not_above("open_price")} | _RANGE),
    "silver_fx_rates": ("drop", _FX),
    "bronze_policies": ("warn", _POLICY | {"valid_lob": missing("lob_id")}),
    "bronze_claims": ("warn", {"valid_claim_id": missing("claim_id"), "valid_incurred": missing("incurred_amount"),
                               "valid_policy_ref": missing("policy_id")}),
    "bronze_exposure": ("warn", {"valid_exposure": missing("total_insured_value"),
                                 "valid_territory": missing("territory")}),
    "bronze_lines_of_business": ("warn", {"valid_lob_id": missing("lob_id")}),
    "silver_enriched_policies": ("drop", _POLICY | {
        "resolved_lob": missing("lob_name"), "not_future_inception": exceeds("inception_date", AS_OF)}),
    "silver_claims_enriched": ("drop", {
        "valid_claim_id": missing("claim_id"), "positive_incurred": not_above("incurred_amount"),
        "paid_not_exceeds_incurred": exceeds("paid_amount", "(incurred_amount * 1.1)")}),
    "silver_exposure": ("drop", {
        "positive_tiv": not_above("total_insured_value"), "positive_pml": not_above("probable_max_loss"),
        "pml_lte_tiv": exceeds("probable_max_loss", "total_insured_value")}),
}


def kept(dataset: str) -> str:
    """Condition of the rows that fail no rule."""
    return "NOT (" + " OR ".join(f"({f})" for f in FAILS[dataset][1].values()) + ")"


def metrics(dataset: str, frame: str) -> str:
    """Q4: rows evaluated and failing, one row per rule."""
    mode, rules = FAILS[dataset]
    sums = ", ".join(f"count(*) FILTER (WHERE {f}) AS \"{r}\"" for r, f in rules.items())
    columns = ", ".join(f'"{r}"' for r in rules)
    return (f"SELECT '{dataset}' AS dataset, rule, '{mode}' AS mode, CAST(evaluated AS BIGINT) AS evaluated, "
            f"CAST(failed AS BIGINT) AS failed FROM (SELECT count(*) AS evaluated, {sums} FROM {frame}) "
            f"UNPIVOT INCLUDE NULLS (failed FOR rule IN ({columns}))")
