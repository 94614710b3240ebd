"""Registered queries: key -> (Spark builder, DuckDB oracle SQL).

Every builder reads the input tables of ``sf_dir`` through the bindings, runs
the whole dataset graph up to its dataset, and returns the result in
comparison form (computed doubles rounded to single precision, see
``stabilize_doubles``; copied columns are compared as they are). The library functions themselves never round.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiergrain.functions.exprs import stabilize_doubles
from tiergrain.params import TEST_PARAMS, Params
from tiergrain.plans import investment as inv
from tiergrain.plans import insurance as ins
from tiergrain.plans import insurance_sql
from tiergrain.plans import investment_sql  # noqa: F401  (registers oracle CTEs)
from tiergrain.plans.oracle import build, stab
from tiergrain.plans.oracle_rules import metrics as metrics_sql
from tiergrain.operators.quality import violation_counts
from tiergrain.sources.bindings import raw_tables


@dataclasses.dataclass(frozen=True)
class QueryDef:
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    doc: str = ""


REGISTRY: dict[str, QueryDef] = {}


def register(key: str, builder, oracle: str | None, doc: str = "") -> None:
    if key in REGISTRY:
        raise ValueError(f"duplicate key {key}")
    REGISTRY[key] = QueryDef(builder, oracle, doc)


def _params(spark: SparkSession) -> Params:
    """The test thresholds, overridden by what the session configures (``ins.*``)."""
    return Params.from_conf(spark, TEST_PARAMS)


def investment(spark: SparkSession, sf_dir: str, params: Params | None = None) -> inv.InvestmentDatasets:
    return inv.InvestmentDatasets(raw_tables(spark, sf_dir), params or _params(spark))


# Double columns of each dataset's output (the oracle rounds these; a test
# checks the list against the Spark schema).
INV_DOUBLES = {
    "bronze_trade_executions": ["quantity", "price"],
    "bronze_securities_master": ["coupon_rate", "esg_score"],
    "bronze_market_data": ["close_price", "open_price", "high_price", "low_price"],
    "bronze_fx_rates": ["rate"],
    "bronze_counterparties": [],
    "bronze_fund_structures": ["target_return"],
    "silver_securities_master": ["coupon_rate", "esg_score"],
    "silver_counterparties": [],
    "silver_fund_structures": ["target_return"],
    "silver_enriched_trades": ["quantity", "price", "notional_value"],
    "silver_market_data": ["open_price", "high_price", "low_price", "close_price", "daily_return_pct"],
    "silver_fx_rates": ["rate"],
    "gold_portfolio_summary": ["total_notional", "avg_trade_size"],
    "gold_daily_trading_activity": ["total_quantity", "total_notional", "avg_price"],
    "gold_counterparty_exposure": ["total_exposure", "buy_exposure", "sell_exposure"],
    "gold_market_performance": ["avg_daily_return_pct", "worst_daily_return_pct", "best_daily_return_pct",
                                "avg_close_price", "avg_daily_volume"],
    "gold_settlement_status": ["total_notional", "avg_notional"],
}


# Datasets whose doubles are copies of raw columns: compared exactly, never rounded.
COPIES = {"silver_securities_master", "silver_counterparties", "silver_fund_structures", "silver_fx_rates",
          "quarantine_policies", "silver_claims_enriched"}


def _copied(name: str) -> bool:
    return name.startswith("bronze_") or name in COPIES


def _comparable(name: str, df: DataFrame) -> DataFrame:
    return df if _copied(name) else stabilize_doubles(df)


def _oracle(name: str, doubles: list[str]) -> str:
    return build(stab(name, [] if _copied(name) else doubles), [name])


def _inv_dataset(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _comparable(name, investment(spark, sf_dir)[name])
    run.__name__ = f"inv_{name}"
    return run


def _inv_unfiltered(p: inv.InvestmentDatasets, dataset: str) -> DataFrame:
    """The frame a dataset's rules are evaluated on (rows before dropping)."""
    if dataset in inv.BRONZE_RULES:
        return p[dataset]
    if dataset == "silver_securities_master":
        return p["bronze_securities_master"]
    if dataset == "silver_counterparties":
        return p["bronze_counterparties"]
    if dataset == "silver_fund_structures":
        return p["bronze_fund_structures"]
    if dataset == "silver_enriched_trades":
        return inv.enriched_trades_unfiltered(p["bronze_trade_executions"], p["silver_securities_master"],
                                              p["silver_counterparties"], p["silver_fund_structures"], p.params)
    if dataset == "silver_market_data":
        return inv.market_data_unfiltered(p["bronze_market_data"])
    if dataset == "silver_fx_rates":
        return p["bronze_fx_rates"]
    raise KeyError(dataset)


def _inv_metrics(dataset: str):
    ruleset = {**inv.BRONZE_RULES, **inv.SILVER_RULES}[dataset]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        p = investment(spark, sf_dir)
        return violation_counts(_inv_unfiltered(p, dataset), ruleset)
    run.__name__ = f"dq_{dataset}"
    return run


def _register_investment() -> None:
    for name in inv.DATASETS:
        register(f"inv_{name}", _inv_dataset(name), _oracle(name, INV_DOUBLES[name]),
                 doc=f"investment dataset {name}")
    for dataset, frame in investment_sql.RULE_FRAMES.items():
        register(f"dq_{dataset}", _inv_metrics(dataset), build(metrics_sql(dataset, frame), [frame]),
                 doc=f"rule metrics of {dataset}")


INS_DOUBLES = {
    "bronze_policies": ["gross_premium", "limit_amount", "deductible"],
    "bronze_claims": ["incurred_amount", "paid_amount", "reserve_amount"],
    "bronze_exposure": ["total_insured_value", "probable_max_loss"],
    "bronze_lines_of_business": [],
    "silver_enriched_policies": ["gross_premium", "limit_amount", "deductible", "cession_rate", "ceded_premium",
                                 "net_premium", "rate_on_line"],
    "quarantine_policies": ["gross_premium", "limit_amount", "deductible"],
    "silver_claims_enriched": ["incurred_amount", "paid_amount", "reserve_amount"],
    "silver_exposure": ["total_insured_value", "probable_max_loss", "pml_ratio"],
    "gold_underwriting_summary": ["gwp", "nwp", "ceded_premium", "avg_rate_on_line", "total_limit",
                                  "incurred_losses", "paid_losses", "outstanding_reserves", "avg_notification_lag",
                                  "loss_ratio", "expense_ratio", "combined_ratio", "underwriting_profit"],
    "gold_compliance_checks": ["threshold", "actual_value"],
    "gold_exposure_summary": ["total_limit", "total_gwp", "total_nwp", "cat_tiv", "cat_pml"],
}


def insurance(spark: SparkSession, sf_dir: str, params: Params | None = None) -> ins.InsuranceDatasets:
    return ins.InsuranceDatasets(raw_tables(spark, sf_dir), params or _params(spark))


def _ins_dataset(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _comparable(name, insurance(spark, sf_dir)[name])
    run.__name__ = f"ins_{name}"
    return run


def _ins_metrics(dataset: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        p = insurance(spark, sf_dir)
        return violation_counts(p.unfiltered(dataset), p.rules(dataset))
    run.__name__ = f"dq_{dataset}"
    return run


def _register_insurance() -> None:
    for name in ins.DATASETS:
        register(f"ins_{name}", _ins_dataset(name), _oracle(name, INS_DOUBLES[name]),
                 doc=f"insurance dataset {name}")
    for dataset, frame in insurance_sql.RULE_FRAMES.items():
        register(f"dq_{dataset}", _ins_metrics(dataset), build(metrics_sql(dataset, frame), [frame]),
                 doc=f"rule metrics of {dataset}")


# thresholds of the key that shows run-time parameters
OVERRIDES = {"ins.max_single_risk_pct": "0.2", "ins.max_aggregate_limit_usd": "7e9"}
METRICS_SCHEMA = "dataset string, rule string, mode string, evaluated bigint, failed bigint"


def _stream_table(table: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from tiergrain.plans.streams import InvestmentStreams
        st = InvestmentStreams(spark, sf_dir, _params(spark))
        out = st.table(table)
        if table in ("bronze_trade_executions", "silver_enriched_trades") and not st.rerun_is_noop(table):
            raise AssertionError(f"rerun of {table} added rows")
        return _comparable(table, out)
    run.__name__ = f"stream_{table}"
    return run


def _stream_metrics(table: str):
    ruleset = {**inv.BRONZE_RULES, **inv.SILVER_RULES}[table]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from tiergrain.plans.streams import InvestmentStreams
        st = InvestmentStreams(spark, sf_dir, _params(spark))
        st.table(table)
        got = st.metrics(table)
        rows = [(ruleset.dataset, r.name, ruleset.mode, got.get("_evaluated", 0), got.get(r.name, 0))
                for r in ruleset.rules]
        return spark.createDataFrame(rows, METRICS_SCHEMA)
    run.__name__ = f"stream_dq_{table}"
    return run


def _register_streams() -> None:
    from tiergrain.plans.streams import STREAM_TABLES
    for table in STREAM_TABLES:
        register(f"stream_{table}", _stream_table(table), REGISTRY[f"inv_{table}"].oracle,
                 doc=f"incremental streaming refresh of {table}")
    for table in STREAM_TABLES:
        register(f"stream_dq_{table}", _stream_metrics(table), REGISTRY[f"dq_{table}"].oracle,
                 doc=f"rule metrics observed during the streaming refresh of {table}")


EXT_DOUBLES = {
    "ext_sector_allocation": ["sector_notional", "fund_notional", "share_pct"],
    "ext_loss_ratio_rule": ["threshold", "actual_value"],
    "ext_base_currency_notional": ["notional_value", "fx_rate", "notional_base"],
    "ext_loss_ratio_by_policy": ["gwp", "nwp", "incurred_losses", "paid_losses", "loss_ratio"],
    "ext_orphan_claims": ["incurred_amount"],
    "ext_paid_triangle": ["paid", "cumulative_paid"],
    "ext_running_incurred": ["incurred_amount", "running_incurred"],
    "ext_earned_premium": ["gwp", "earned_premium"],
    "ext_claim_versions": ["incurred_amount"],
    "ext_reinsurance_split": ["cession_rate", "share", "ceded_premium"],
    "ext_exposure_by_rating": ["total_exposure"],
    "ext_cat_pml_by_territory": ["cat_tiv", "cat_pml"],
    "split_policies": [],
    "audit_raw_tables": [],
    "bars_daily_quotes": ["open_price", "high_price", "low_price", "close_price"],
}


def _ext(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    from tiergrain.operators.bars import daily_bars
    from tiergrain.operators.quality import split_summary
    from tiergrain.plans import extensions as ext
    from tiergrain.plans.extensions_sql import AUDIT_CHECKS, AUDIT_TABLES
    from tiergrain.sources.sinks import row_count_audit
    from tiergrain.sources.tables import Tables
    params = _params(spark)
    if name == "bars_daily_quotes":
        size = F.when(F.col("event_id") % 127 == 0, F.lit(0)).otherwise(100 + F.col("event_id") * 10)
        return daily_bars(Tables(spark, sf_dir).events, "user_id", "ts", "value", "event_id", size)
    if name == "audit_raw_tables":
        raw = raw_tables(spark, sf_dir)
        return row_count_audit({t: raw[t] for t in AUDIT_TABLES}, AUDIT_CHECKS)
    i = investment(spark, sf_dir)
    s = insurance(spark, sf_dir)
    if name == "ext_sector_allocation":
        return ext.sector_allocation(i["silver_enriched_trades"])
    if name == "ext_loss_ratio_rule":
        return ext.loss_ratio_rule(s["silver_enriched_policies"], s["kept_claims"], params)
    if name == "ext_base_currency_notional":
        return ext.base_currency_notional(i["silver_enriched_trades"], i["silver_fx_rates"], params)
    if name == "ext_loss_ratio_by_policy":
        return ext.loss_ratio_by_policy(s["silver_enriched_policies"], s["kept_claims"], params)
    if name == "ext_orphan_claims":
        return ext.orphan_claims(s["kept_claims"], s["silver_enriched_policies"])
    if name == "ext_paid_triangle":
        return ext.paid_triangle(s["kept_claims"])
    if name == "ext_running_incurred":
        return ext.running_incurred(s["placed_claims"], params, s["kept_claims"])
    if name == "ext_earned_premium":
        return ext.earned_premium(s["silver_enriched_policies"], params)
    if name == "ext_claim_versions":
        return ext.claim_versions(s["placed_claims"], params, s["kept_claims"])
    if name == "ext_reinsurance_split":
        return ext.reinsurance_split(s["silver_enriched_policies"], s.raw["raw_reinsurers"])
    if name == "ext_exposure_by_rating":
        return ext.exposure_by_rating(i["silver_enriched_trades"])
    if name == "ext_cat_pml_by_territory":
        return ext.cat_pml_by_territory(s["silver_exposure"])
    if name == "split_policies":
        return split_summary(s.unfiltered("silver_enriched_policies"), s.rules("silver_enriched_policies"))
    raise KeyError(name)


def _ext_builder(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return stabilize_doubles(_ext(name, spark, sf_dir))
    run.__name__ = name
    return run


def _view_builder(dataset: str, cluster_by):
    """Publish a view twice, first from half of its rows, and read the newest version back."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from tiergrain.session import shared_dir
        from tiergrain.sources.sinks import publish_view, read_view
        base = shared_dir(spark, "views", dataset)
        df = (investment if dataset in inv.DATASETS else insurance)(spark, sf_dir)[dataset]
        half = F.pmod(F.xxhash64(*df.columns), F.lit(2)) == 0
        df.persist()                                                    # one run of the graph for both refreshes
        try:
            publish_view(df.where(half), base, cluster_by=cluster_by)   # an older refresh
            publish_view(df, base, cluster_by=cluster_by)               # all rows replace it
        finally:
            df.unpersist()
        return stabilize_doubles(read_view(spark, base))
    run.__name__ = f"view_{dataset}"
    return run


def _full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades refreshed in two arrivals, then refreshed in full into a new sink: the new sink's rows."""
    from tiergrain.plans.streams import InvestmentStreams
    st = InvestmentStreams(spark, sf_dir, _params(spark))
    incremental = st.table("bronze_trade_executions")
    full = st.full_refresh("bronze_trade_executions")
    if full.count() != incremental.count():
        raise AssertionError("a full refresh and the incremental refreshes differ")
    return full


def _overridden_compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compliance report under thresholds that the session configures."""
    old = {k: spark.conf.get(k, None) for k in OVERRIDES}
    for k, v in OVERRIDES.items():
        spark.conf.set(k, v)
    try:
        return stabilize_doubles(insurance(spark, sf_dir)["gold_compliance_checks"])
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tiergrain.plans.synthetic import fx_date_spine
    return stabilize_doubles(fx_date_spine(raw_tables(spark, sf_dir)["raw_fx_rates"]))


def _refresh_metrics(domain: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from tiergrain.plans.refresh import refresh_insurance, refresh_investment
        fn = refresh_investment if domain == "investment" else refresh_insurance
        r = fn(spark, sf_dir, _params(spark))
        rows = [(m["dataset"], m["rule"], m["mode"], m["evaluated"], m["failed"]) for m in r.metrics]
        return spark.createDataFrame(rows, METRICS_SCHEMA)
    run.__name__ = f"refresh_dq_{domain}"
    return run


def _register_refresh() -> None:
    parts = [metrics_sql(ds, frame) for ds, frame in investment_sql.RULE_FRAMES.items()]
    frames = list(investment_sql.RULE_FRAMES.values())
    register("refresh_dq_investment", _refresh_metrics("investment"), build("\nUNION ALL\n".join(f"({p})" for p in parts), frames),
             doc="rule metrics observed while a full investment refresh writes its tables")
    parts = [metrics_sql(ds, frame) for ds, frame in insurance_sql.RULE_FRAMES.items()]
    frames = list(insurance_sql.RULE_FRAMES.values())
    register("refresh_dq_insurance", _refresh_metrics("insurance"), build("\nUNION ALL\n".join(f"({p})" for p in parts), frames),
             doc="rule metrics observed while a full insurance refresh writes its tables")


def _register_extensions() -> None:
    from tiergrain.plans import extensions_sql  # noqa: F401  (registers CTEs)
    for name, doubles in EXT_DOUBLES.items():
        register(name, _ext_builder(name), build(stab(name, doubles), [name]), doc=f"extension {name}")
    register("synth_fx_date_spine", _date_spine, build(stab("synth_fx_date_spine", []), ["synth_fx_date_spine"]),
             doc="calendar of the quoted currencies")
    for dataset, keys in inv.GOLD_CLUSTER_BY.items():
        register(f"view_{dataset}", _view_builder(dataset, keys), REGISTRY[f"inv_{dataset}"].oracle,
                 doc=f"clustered, versioned refresh of {dataset}")
    for dataset in [d for d in inv.DATASETS if d.startswith("gold_") and d not in inv.GOLD_CLUSTER_BY] + [
            d for d in ins.DATASETS if d.startswith("gold_")]:
        family = "inv" if dataset in inv.DATASETS else "ins"
        register(f"view_{dataset}", _view_builder(dataset, None), REGISTRY[f"{family}_{dataset}"].oracle,
                 doc=f"versioned refresh of {dataset}")
    register("stream_full_refresh_trades", _full_refresh, REGISTRY["inv_bronze_trade_executions"].oracle,
             doc="full refresh of a streaming table into a new sink and checkpoint")
    register("ins_compliance_overridden", _overridden_compliance,
             insurance_sql.overridden(build(stab("gold_compliance_checks", INS_DOUBLES["gold_compliance_checks"]),
                                            ["gold_compliance_checks"])),
             doc="compliance report under configured thresholds (R1)")


def _register_operations() -> None:
    from tiergrain.plans.operations import QUERIES
    for name, (builder, oracle) in QUERIES.items():
        register(name, builder, oracle, doc=(builder.__doc__ or name).strip())


_register_investment()
_register_insurance()
_register_streams()
_register_extensions()
_register_refresh()
_register_operations()
