"""Triggered refresh of a whole dataset graph (the reference's update run).

Every bronze and silver dataset is written as a table under one folder and
read back by its downstream datasets (S2/S5/S8); gold datasets are published
as clustered, versioned views (S7/S10). Rule counts of every dataset are
collected with ``Observation`` while its table is written: no extra pass.
Datasets that do not read each other are written at the same time, so that the last tasks
of one do not leave the executors idle.
The returned metrics are one row per (dataset, rule).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession

from tiergrain.operators.quality import RuleSet, observed_counts
from tiergrain.params import Params
from tiergrain.plans import insurance as ins
from tiergrain.plans import investment as inv
from tiergrain.session import shared_dir
from tiergrain.sources.bindings import raw_tables
from tiergrain.sources.sinks import publish_view, write_table


AT_ONCE = 4     # writes of one refresh that run together


def _together(spark: SparkSession, steps: dict[str, Callable]) -> dict:
    """The steps' results by name; a step that fails is raised when all have ended."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        begun = {name: pool.submit(inheritable_thread_target(spark)(step)) for name, step in steps.items()}
    return {name: b.result() for name, b in begun.items()}


class _Run:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base
        self.metrics: list[dict] = []
        self.paths: dict[str, str] = {}

    def table(self, name: str, build, ruleset: RuleSet | None = None) -> DataFrame:
        """Write ``build(observation)`` as table ``name``; return a reader of it."""
        obs = Observation(f"rules_{name}") if ruleset is not None else None
        path = write_table(build(obs), f"{self.base}/{name}")
        if ruleset is not None:
            self.metrics.extend(observed_counts(obs, ruleset))
        self.paths[name] = path
        return self.spark.read.parquet(path)

    def view(self, name: str, df: DataFrame, cluster_by=None) -> None:
        self.paths[name] = publish_view(df, f"{self.base}/{name}", cluster_by=cluster_by)


def refresh_investment(spark: SparkSession, sf_dir: str, params: Params, base: str | None = None) -> _Run:
    run = _Run(spark, base or shared_dir(spark, "refresh", "investment"))
    raw = raw_tables(spark, sf_dir)
    b = _together(spark, {
        ds: lambda ds=ds, df=raw[r]: run.table(ds, lambda o: inv.bronze(df, ds, o), inv.BRONZE_RULES[ds])
        for ds, r in inv.BRONZE_SOURCES.items()})
    silver = {
        "silver_securities_master": lambda o: inv.silver_securities_master(b["bronze_securities_master"], o),
        "silver_counterparties": lambda o: inv.silver_counterparties(b["bronze_counterparties"], o),
        "silver_fund_structures": lambda o: inv.silver_fund_structures(b["bronze_fund_structures"], o),
        "silver_market_data": lambda o: inv.silver_market_data(b["bronze_market_data"], o),
        "silver_fx_rates": lambda o: inv.silver_fx_rates(b["bronze_fx_rates"], o),
    }
    s = _together(spark, {ds: lambda ds=ds, build=build: run.table(ds, build, inv.SILVER_RULES[ds])
                          for ds, build in silver.items()})
    sec, cp, fund = s["silver_securities_master"], s["silver_counterparties"], s["silver_fund_structures"]
    trades = run.table("silver_enriched_trades",
                       lambda o: inv.silver_enriched_trades(b["bronze_trade_executions"], sec, cp, fund, params, o),
                       inv.SILVER_RULES["silver_enriched_trades"])
    gold = {
        "gold_portfolio_summary": inv.gold_portfolio_summary(trades),
        "gold_daily_trading_activity": inv.gold_daily_trading_activity(trades),
        "gold_counterparty_exposure": inv.gold_counterparty_exposure(trades),
        "gold_market_performance": inv.gold_market_performance(s["silver_market_data"], sec, params),
        "gold_settlement_status": inv.gold_settlement_status(trades),
    }
    _together(spark, {name: lambda name=name, df=df: run.view(name, df, inv.GOLD_CLUSTER_BY.get(name))
                      for name, df in gold.items()})
    return run


def refresh_insurance(spark: SparkSession, sf_dir: str, params: Params, base: str | None = None) -> _Run:
    run = _Run(spark, base or shared_dir(spark, "refresh", "insurance"))
    raw = raw_tables(spark, sf_dir)
    b = _together(spark, {
        ds: lambda ds=ds, df=raw[r]: run.table(ds, lambda o: ins.bronze(df, ds, o), ins.BRONZE_RULES[ds])
        for ds, r in ins.BRONZE_SOURCES.items()})
    lobs, brokers, reinsurers = b["bronze_lines_of_business"], raw["raw_brokers"], raw["raw_reinsurers"]
    s = _together(spark, {
        "policies": lambda: run.table(
            "silver_enriched_policies",
            lambda o: ins.silver_enriched_policies(b["bronze_policies"], lobs, brokers, reinsurers, params, o),
            ins.policy_rules(params)),
        "quarantine": lambda: run.table(
            "quarantine_policies", lambda o: ins.quarantine_policies(b["bronze_policies"], lobs, params)),
        "claims": lambda: run.table(
            "silver_claims_enriched", lambda o: ins.silver_claims_enriched(b["bronze_claims"], params, o), ins.CLAIM_RULES),
        "exposure": lambda: run.table(
            "silver_exposure", lambda o: ins.silver_exposure(b["bronze_exposure"], o), ins.EXPOSURE_RULES),
    })
    gold = {
        "gold_underwriting_summary": ins.gold_underwriting_summary(s["policies"], s["claims"], params),
        "gold_compliance_checks": ins.gold_compliance_checks(s["policies"], params),
        "gold_exposure_summary": ins.gold_exposure_summary(s["policies"], s["exposure"], params),
    }
    _together(spark, {name: lambda name=name, df=df: run.view(name, df) for name, df in gold.items()})
    return run
