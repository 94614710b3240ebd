"""What every dataset is: its layer and a comment, for catalogues and docs."""

from __future__ import annotations

from typing import NamedTuple

from tiergrain.plans import insurance, investment


class DatasetInfo(NamedTuple):
    domain: str
    layer: str       # bronze, silver, quarantine or gold
    comment: str


_COMMENTS = {
    "bronze_trade_executions": "Trade executions as received; five rules only counted",
    "bronze_securities_master": "Securities as received",
    "bronze_market_data": "Daily quotes as received",
    "bronze_fx_rates": "Exchange rates as received",
    "bronze_counterparties": "Counterparties as received",
    "bronze_fund_structures": "Funds as received",
    "silver_securities_master": "Securities with id, ISIN and name",
    "silver_counterparties": "Counterparties with id, name and LEI",
    "silver_fund_structures": "Funds with id, name and strategy",
    "silver_enriched_trades": "Valid trades with security, counterparty and fund attributes",
    "silver_market_data": "Valid quotes with the daily return",
    "silver_fx_rates": "Valid exchange rates",
    "gold_portfolio_summary": "Trades and notional by fund",
    "gold_daily_trading_activity": "Volume and notional by day, asset class and side",
    "gold_counterparty_exposure": "Exposure by counterparty, bought and sold",
    "gold_market_performance": "Returns, prices and volume by security",
    "gold_settlement_status": "Trades by fund, venue and settlement status",
    "bronze_policies": "Policies as received",
    "bronze_claims": "Claim versions as received",
    "bronze_exposure": "Exposure accumulations as received",
    "bronze_lines_of_business": "Lines of business as received",
    "silver_enriched_policies": "Valid policies with line, broker, cession and net premium",
    "quarantine_policies": "Failing policies with their reasons",
    "silver_claims_enriched": "Valid claim versions with age, band and rank",
    "silver_exposure": "Valid exposures with the loss ratio of the model",
    "gold_underwriting_summary": "Premium by line and year beside losses by peril and year",
    "gold_compliance_checks": "Concentration and limit rules with severity",
    "gold_exposure_summary": "Bound book by territory, peril and line with the latest catastrophe model",
}

DATASETS: dict[str, DatasetInfo] = {
    name: DatasetInfo(domain, name.split("_")[0], _COMMENTS[name])
    for domain, names in (("investment", investment.DATASETS), ("insurance", insurance.DATASETS)) for name in names}
