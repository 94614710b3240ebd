"""Investment-operations medallion: 6 bronze, 6 silver, 5 gold datasets.

Bronze tables pass raw rows through under warn rules; silver dimensions and
facts drop rows failing any rule, evaluated on the finished output row; gold
views aggregate the enriched trades. Every function returns a lazy frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiergrain.operators.quality import DROP, WARN, RuleSet, apply_rules
from tiergrain.operators.relational import enrich_star
from tiergrain.params import Params

# --- rule sets (data, not code) -------------------------------------------------

BRONZE_RULES = {rs.dataset: rs for rs in (
    RuleSet.of("bronze_trade_executions", WARN, {
        "valid_trade_id": "trade_id IS NOT NULL",
        "valid_trade_date": "trade_date IS NOT NULL",
        "positive_quantity": "quantity > 0",
        "positive_price": "price > 0",
        "valid_currency": "currency IS NOT NULL",
    }),
    RuleSet.of("bronze_securities_master", WARN, {
        "valid_security_id": "security_id IS NOT NULL",
        "valid_isin": "isin IS NOT NULL",
        "valid_security_name": "security_name IS NOT NULL",
        "valid_asset_class": "asset_class IS NOT NULL",
    }),
    RuleSet.of("bronze_market_data", WARN, {
        "valid_security_id": "security_id IS NOT NULL",
        "valid_price_date": "price_date IS NOT NULL",
        "positive_close_price": "close_price > 0",
        "positive_volume": "volume >= 0",
        "valid_price_range": "low_price <= high_price",
    }),
    RuleSet.of("bronze_fx_rates", WARN, {
        "valid_rate_date": "rate_date IS NOT NULL",
        "valid_from_currency": "from_currency IS NOT NULL",
        "valid_to_currency": "to_currency IS NOT NULL",
        "positive_rate": "rate > 0",
    }),
    RuleSet.of("bronze_counterparties", WARN, {
        "valid_counterparty_id": "counterparty_id IS NOT NULL",
        "valid_counterparty_name": "counterparty_name IS NOT NULL",
        "valid_lei": "lei IS NOT NULL",
        "valid_credit_rating": "credit_rating IS NOT NULL",
    }),
    RuleSet.of("bronze_fund_structures", WARN, {
        "valid_fund_id": "fund_id IS NOT NULL",
        "valid_fund_name": "fund_name IS NOT NULL",
        "valid_inception_date": "inception_date IS NOT NULL",
        "positive_target_return": "target_return >= 0",
    }),
)}

SILVER_RULES = {rs.dataset: rs for rs in (
    RuleSet.of("silver_securities_master", DROP, {
        "valid_security_id": "security_id IS NOT NULL",
        "valid_isin": "isin IS NOT NULL",
        "valid_security_name": "security_name IS NOT NULL",
    }),
    RuleSet.of("silver_counterparties", DROP, {
        "valid_counterparty_id": "counterparty_id IS NOT NULL",
        "valid_counterparty_name": "counterparty_name IS NOT NULL",
        "valid_lei": "lei IS NOT NULL",
    }),
    RuleSet.of("silver_fund_structures", DROP, {
        "valid_fund_id": "fund_id IS NOT NULL",
        "valid_fund_name": "fund_name IS NOT NULL",
        "valid_strategy": "strategy IS NOT NULL",
    }),
    RuleSet.of("silver_enriched_trades", DROP, {
        "valid_trade_id": "trade_id IS NOT NULL",
        "valid_trade_date": "trade_date IS NOT NULL",
        "positive_quantity": "quantity > 0",
        "positive_price": "price > 0",
        "valid_trade_type": "trade_type IN ('BUY', 'SELL')",
        "valid_notional": "notional_value > 0",
    }),
    RuleSet.of("silver_market_data", DROP, {
        "valid_security_id": "security_id IS NOT NULL",
        "valid_price_date": "price_date IS NOT NULL",
        "positive_close_price": "close_price > 0",
        "positive_open_price": "open_price > 0",
        "valid_price_range": "low_price <= high_price",
    }),
    RuleSet.of("silver_fx_rates", DROP, {
        "valid_rate_date": "rate_date IS NOT NULL",
        "valid_from_currency": "from_currency IS NOT NULL",
        "valid_to_currency": "to_currency IS NOT NULL",
        "positive_rate": "rate > 0",
    }),
)}

BRONZE_SOURCES = {
    "bronze_trade_executions": "raw_trade_executions",
    "bronze_securities_master": "raw_securities_master",
    "bronze_market_data": "raw_market_data",
    "bronze_fx_rates": "raw_fx_rates",
    "bronze_counterparties": "raw_counterparties",
    "bronze_fund_structures": "raw_fund_structures",
}

SECURITY_COLUMNS = ("security_id", "isin", "ticker", "security_name", "asset_class", "sector", "country",
                    "currency", "exchange", "issuer_name", "maturity_date", "coupon_rate", "esg_score")
COUNTERPARTY_COLUMNS = ("counterparty_id", "counterparty_name", "counterparty_type", "lei", "country",
                        "credit_rating")
FUND_COLUMNS = ("fund_id", "fund_name", "strategy", "benchmark_id", "inception_date", "target_return",
                "base_currency")
MARKET_COLUMNS = ("security_id", "price_date", "open_price", "high_price", "low_price", "close_price",
                  "volume", "currency", "source")
FX_COLUMNS = ("rate_date", "from_currency", "to_currency", "rate", "source")


# --- bronze -------------------------------------------------------------------

def bronze(raw: DataFrame, dataset: str, observation=None) -> DataFrame:
    """P1 + Q1: raw rows unchanged under the dataset's warn rules."""
    return apply_rules(raw, BRONZE_RULES[dataset], observation)


# --- silver ---------------------------------------------------------------------

def _silver_projection(df: DataFrame, dataset: str, columns, observation=None) -> DataFrame:
    return apply_rules(df.select(*columns), SILVER_RULES[dataset], observation)


def silver_securities_master(bronze_sec: DataFrame, observation=None) -> DataFrame:
    return _silver_projection(bronze_sec, "silver_securities_master", SECURITY_COLUMNS, observation)


def silver_counterparties(bronze_cp: DataFrame, observation=None) -> DataFrame:
    return _silver_projection(bronze_cp, "silver_counterparties", COUNTERPARTY_COLUMNS, observation)


def silver_fund_structures(bronze_funds: DataFrame, observation=None) -> DataFrame:
    return _silver_projection(bronze_funds, "silver_fund_structures", FUND_COLUMNS, observation)


def enriched_trades_unfiltered(trades: DataFrame, securities: DataFrame, counterparties: DataFrame,
                               funds: DataFrame, params: Params) -> DataFrame:
    """J1 + P3-P5: trades with security, counterparty and fund attributes.

    The trade's own ``asset_class`` is replaced by the security's (P4).
    """
    t = trades.select(
        "trade_id", "order_id", "security_id", "counterparty_id", "fund_id", "trade_date", "trade_type",
        "quantity", "price", "currency", (F.col("quantity") * F.col("price")).alias("notional_value"),
        "broker_id", "execution_venue", "settlement_status")
    return enrich_star(t, [
        (securities, "security_id", "security_id",
         ["security_name", "asset_class", "sector", "isin"]),
        (counterparties, "counterparty_id", "counterparty_id",
         ["counterparty_name", "counterparty_type", "credit_rating"]),
        (funds, "fund_id", "fund_id",
         ["fund_name", F.col("strategy").alias("fund_strategy"), F.col("base_currency").alias("fund_currency")]),
    ])


def silver_enriched_trades(trades: DataFrame, securities: DataFrame, counterparties: DataFrame,
                           funds: DataFrame, params: Params, observation=None) -> DataFrame:
    """Q2 + Q5: drop rules run on the finished row (incl. ``notional_value``)."""
    out = enriched_trades_unfiltered(trades, securities, counterparties, funds, params)
    return apply_rules(out, SILVER_RULES["silver_enriched_trades"], observation)


def market_data_unfiltered(bronze_md: DataFrame) -> DataFrame:
    ret = F.round(F.try_divide(F.col("close_price") - F.col("open_price"), F.col("open_price")) * 100, 4)
    return bronze_md.select(*MARKET_COLUMNS, ret.alias("daily_return_pct"))


def silver_market_data(bronze_md: DataFrame, observation=None) -> DataFrame:
    return apply_rules(market_data_unfiltered(bronze_md), SILVER_RULES["silver_market_data"], observation)


def silver_fx_rates(bronze_fx: DataFrame, observation=None) -> DataFrame:
    return _silver_projection(bronze_fx, "silver_fx_rates", FX_COLUMNS, observation)


# --- gold ---------------------------------------------------------------------------

def gold_portfolio_summary(enriched: DataFrame) -> DataFrame:
    return (enriched.groupBy("fund_id", "fund_name", "fund_strategy", "fund_currency")
            .agg(F.count_distinct("trade_id").alias("total_trades"),
                 F.count_distinct("security_id").alias("distinct_securities"),
                 F.sum("notional_value").alias("total_notional"),
                 F.avg("notional_value").alias("avg_trade_size"),
                 F.min("trade_date").alias("first_trade_date"),
                 F.max("trade_date").alias("last_trade_date")))


def gold_daily_trading_activity(enriched: DataFrame) -> DataFrame:
    return (enriched.groupBy(F.to_date("trade_date").alias("trade_day"), "asset_class", "trade_type")
            .agg(F.count(F.lit(1)).alias("trade_count"),
                 F.sum("quantity").alias("total_quantity"),
                 F.sum("notional_value").alias("total_notional"),
                 F.avg("price").alias("avg_price")))


def gold_counterparty_exposure(enriched: DataFrame) -> DataFrame:
    n = F.col("notional_value")
    return (enriched.groupBy("counterparty_id", "counterparty_name", "counterparty_type", "credit_rating")
            .agg(F.count_distinct("trade_id").alias("trade_count"),
                 F.count_distinct("fund_id").alias("funds_exposed"),
                 F.sum(n).alias("total_exposure"),
                 F.sum(F.when(F.col("trade_type") == "BUY", n).otherwise(F.lit(0.0))).alias("buy_exposure"),
                 F.sum(F.when(F.col("trade_type") == "SELL", n).otherwise(F.lit(0.0))).alias("sell_exposure"),
                 F.max("trade_date").alias("last_trade_date")))


def gold_market_performance(market: DataFrame, securities: DataFrame, params: Params) -> DataFrame:
    m = enrich_star(market, [
        (securities, "security_id", "security_id", ["security_name", "asset_class", "sector"]),
    ])
    return (m.groupBy("security_id", "security_name", "asset_class", "sector")
            .agg(F.count(F.lit(1)).alias("trading_days"),
                 F.avg("daily_return_pct").alias("avg_daily_return_pct"),
                 F.min("daily_return_pct").alias("worst_daily_return_pct"),
                 F.max("daily_return_pct").alias("best_daily_return_pct"),
                 F.avg("close_price").alias("avg_close_price"),
                 F.avg("volume").alias("avg_daily_volume"),
                 F.min("price_date").alias("first_date"),
                 F.max("price_date").alias("last_date")))


def gold_settlement_status(enriched: DataFrame) -> DataFrame:
    return (enriched.groupBy("fund_name", "execution_venue", "settlement_status")
            .agg(F.count(F.lit(1)).alias("trade_count"),
                 F.sum("notional_value").alias("total_notional"),
                 F.avg("notional_value").alias("avg_notional")))


# Clustering keys of the gold views (S10); settlement has none in the reference.
GOLD_CLUSTER_BY = {
    "gold_portfolio_summary": ("fund_name",),
    "gold_daily_trading_activity": ("trade_day", "asset_class"),
    "gold_counterparty_exposure": ("counterparty_name",),
    "gold_market_performance": ("security_id",),
}


# --- whole graph ------------------------------------------------------------------

class InvestmentDatasets:
    """All 17 datasets over one set of raw frames, built lazily on demand."""

    def __init__(self, raw: dict[str, DataFrame], params: Params):
        self.raw = raw
        self.params = params
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._build(name)
        return self._cache[name]

    def _build(self, name: str) -> DataFrame:
        p = self.params
        if name in BRONZE_SOURCES:
            return bronze(self.raw[BRONZE_SOURCES[name]], name)
        if name == "silver_securities_master":
            return silver_securities_master(self["bronze_securities_master"])
        if name == "silver_counterparties":
            return silver_counterparties(self["bronze_counterparties"])
        if name == "silver_fund_structures":
            return silver_fund_structures(self["bronze_fund_structures"])
        if name == "silver_enriched_trades":
            return silver_enriched_trades(self["bronze_trade_executions"], self["silver_securities_master"],
                                          self["silver_counterparties"], self["silver_fund_structures"], p)
        if name == "silver_market_data":
            return silver_market_data(self["bronze_market_data"])
        if name == "silver_fx_rates":
            return silver_fx_rates(self["bronze_fx_rates"])
        if name == "gold_portfolio_summary":
            return gold_portfolio_summary(self["silver_enriched_trades"])
        if name == "gold_daily_trading_activity":
            return gold_daily_trading_activity(self["silver_enriched_trades"])
        if name == "gold_counterparty_exposure":
            return gold_counterparty_exposure(self["silver_enriched_trades"])
        if name == "gold_market_performance":
            return gold_market_performance(self["silver_market_data"], self["silver_securities_master"], p)
        if name == "gold_settlement_status":
            return gold_settlement_status(self["silver_enriched_trades"])
        raise KeyError(name)


DATASETS = tuple(BRONZE_SOURCES) + (
    "silver_securities_master", "silver_counterparties", "silver_fund_structures",
    "silver_enriched_trades", "silver_market_data", "silver_fx_rates",
    "gold_portfolio_summary", "gold_daily_trading_activity", "gold_counterparty_exposure",
    "gold_market_performance", "gold_settlement_status")

__all__ = ["InvestmentDatasets", "DATASETS", "BRONZE_RULES", "SILVER_RULES"]
