"""DuckDB oracle of the investment datasets.

Each result is put together in steps of its own: look-ups as scalar maps per
dimension, distinct counts as counts over de-duplicated pairs, conditional sums
with FILTER. Column lists and names are fixed by the datasets.
"""

from __future__ import annotations

from tiergrain.plans.investment import BRONZE_SOURCES
from tiergrain.plans.oracle import cte
from tiergrain.plans.oracle_rules import FAILS, kept

for _dataset, _raw in BRONZE_SOURCES.items():
    cte(_dataset, f"SELECT * FROM {_raw}", [_raw])

# silver table -> (source, columns); the rows that fail no rule stay
_KEPT = {
    "silver_securities_master": ("bronze_securities_master", "security_id isin ticker security_name asset_class sector "
                                 "country currency exchange issuer_name maturity_date coupon_rate esg_score"),
    "silver_counterparties": ("bronze_counterparties", "counterparty_id counterparty_name counterparty_type lei country "
                              "credit_rating"),
    "silver_fund_structures": ("bronze_fund_structures", "fund_id fund_name strategy benchmark_id inception_date "
                               "target_return base_currency"),
    "silver_fx_rates": ("bronze_fx_rates", "rate_date from_currency to_currency rate source"),
    "silver_enriched_trades": ("enriched_trades_unfiltered", "*"),
    "silver_market_data": ("market_data_unfiltered", "*"),
}
for _dataset, (_source, _columns) in _KEPT.items():
    cte(_dataset, f"SELECT {', '.join(_columns.split())} FROM {_source} WHERE {kept(_dataset)}", [_source])

# one row per fact and matching dimension row, attributes packed while joining
_LOOKUPS = (
    ("silver_securities_master", "security_id", ("security_name", "asset_class", "sector", "isin")),
    ("silver_counterparties", "counterparty_id", ("counterparty_name", "counterparty_type", "credit_rating")),
    ("silver_fund_structures", "fund_id", ("fund_name", "strategy AS fund_strategy", "base_currency AS fund_currency")),
)


def _looked_up(facts: str, lookups) -> str:
    out = facts
    for dimension, key, attributes in lookups:
        names = [a.split(" AS ")[-1] for a in attributes]
        packed = ", ".join(f"'{n}': {a.split(' AS ')[0]}" for a, n in zip(attributes, names))
        out = (f"(SELECT f.* EXCLUDE (hit), {', '.join(f'f.hit.{n} AS {n}' for n in names)} FROM "
               f"(SELECT x.*, d.packed AS hit FROM {out} x LEFT JOIN "
               f"(SELECT {key} AS k, {{{packed}}} AS packed FROM {dimension}) d ON d.k = x.{key}) f)")
    return out


cte("enriched_trades_unfiltered", "SELECT * FROM " + _looked_up(
    "(SELECT * EXCLUDE (asset_class) REPLACE (CAST(quantity AS DOUBLE) AS quantity), "
    "price * quantity AS notional_value FROM bronze_trade_executions)", _LOOKUPS),
    ["bronze_trade_executions", "silver_securities_master", "silver_counterparties", "silver_fund_structures"])

cte("market_data_unfiltered", """
SELECT * EXCLUDE (moved), round(CASE WHEN open_price <> 0 THEN moved / open_price * 100 END, 4) AS daily_return_pct
FROM (SELECT security_id, price_date, open_price, high_price, low_price, close_price, volume, currency, source,
             close_price - open_price AS moved FROM bronze_market_data)""", ["bronze_market_data"])


def _distinct_counts(source: str, keys: tuple[str, ...], counted: dict[str, str], measures: dict[str, str]) -> str:
    """Measures by key, joined to counts over de-duplicated (key, value) pairs."""
    by = ", ".join(keys)
    out = f"(SELECT {by}, {', '.join(f'{m} AS {n}' for n, m in measures.items())} FROM {source} GROUP BY {by}) g"
    same = " AND ".join(f"g.{k} IS NOT DISTINCT FROM {{t}}.{k}" for k in keys)
    for i, (name, column) in enumerate(counted.items()):
        out += (f" JOIN (SELECT {by}, count({column}) AS {name} FROM "
                f"(SELECT DISTINCT {by}, {column} AS {column}_ FROM {source}) p({', '.join((*keys, column))}) "
                f"GROUP BY {by}) d{i} ON {same.format(t=f'd{i}')}")
    columns = ", ".join([f"g.{c}" for c in (*keys, *measures)] + [f"d{i}.{n}" for i, n in enumerate(counted)])
    return f"SELECT {columns} FROM {out}"


def _plain(source: str, keys: str, measures: dict[str, str]) -> str:
    return f"SELECT {keys}, {', '.join(f'{m} AS {n}' for n, m in measures.items())} FROM {source} GROUP BY {keys}"


_T = "silver_enriched_trades"
_MEAN = "sum({0}) / nullif(count({0}), 0)"
cte("gold_portfolio_summary", _distinct_counts(
    _T, ("fund_id", "fund_name", "fund_strategy", "fund_currency"),
    {"total_trades": "trade_id", "distinct_securities": "security_id"},
    {"total_notional": "sum(notional_value)", "avg_trade_size": _MEAN.format("notional_value"),
     "first_trade_date": "min(trade_date)", "last_trade_date": "max(trade_date)"}), [_T])
cte("gold_counterparty_exposure", _distinct_counts(
    _T, ("counterparty_id", "counterparty_name", "counterparty_type", "credit_rating"),
    {"trade_count": "trade_id", "funds_exposed": "fund_id"},
    {"total_exposure": "sum(notional_value)",
     "buy_exposure": "coalesce(sum(notional_value) FILTER (WHERE trade_type = 'BUY'), 0)",
     "sell_exposure": "coalesce(sum(notional_value) FILTER (WHERE trade_type = 'SELL'), 0)",
     "last_trade_date": "max(trade_date)"}), [_T])
cte("gold_daily_trading_activity", _plain(
    f"(SELECT *, CAST(trade_date AS DATE) AS trade_day FROM {_T})", "trade_day, asset_class, trade_type",
    {"trade_count": "count(*)", "total_quantity": "sum(quantity)", "total_notional": "sum(notional_value)",
     "avg_price": _MEAN.format("price")}), [_T])
cte("gold_settlement_status", _plain(
    _T, "fund_name, execution_venue, settlement_status",
    {"trade_count": "count(*)", "total_notional": "sum(notional_value)",
     "avg_notional": _MEAN.format("notional_value")}), [_T])
cte("gold_market_performance", _plain(
    _looked_up("silver_market_data", [("silver_securities_master", "security_id",
                                       ("security_name", "asset_class", "sector"))]),
    "security_id, security_name, asset_class, sector",
    {"trading_days": "count(*)", "avg_daily_return_pct": _MEAN.format("daily_return_pct"),
     "worst_daily_return_pct": "min(daily_return_pct)", "best_daily_return_pct": "max(daily_return_pct)",
     "avg_close_price": _MEAN.format("close_price"), "avg_daily_volume": _MEAN.format("CAST(volume AS DOUBLE)"),
     "first_date": "min(price_date)", "last_date": "max(price_date)"}),
    ["silver_market_data", "silver_securities_master"])

# frames the rules of each dataset are evaluated on (rows before dropping)
RULE_FRAMES = {d: _KEPT[d][0] if d in _KEPT else d for d in FAILS if d in _KEPT or d in BRONZE_SOURCES}
