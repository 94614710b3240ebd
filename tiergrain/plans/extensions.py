"""Extensions (X1-X10): what the reference declares but does not compute.

Each is a user-level Spark job over the silver/gold datasets with the
definition fixed in the survey.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiergrain.functions.exprs import date_literal
from tiergrain.operators.compliance import rule_report, threshold_rule
from tiergrain.operators.relational import pct_of
from tiergrain.operators.sliced import micros
from tiergrain.operators.windows import SLICES, ordered_within
from tiergrain.params import Params
from tiergrain.plans.insurance import latest_exposure, premium_by_lob_year


# X1 -----------------------------------------------------------------------------
def sector_allocation(enriched: DataFrame) -> DataFrame:
    """Notional by fund x sector and its share of the fund's total.

    The fund total is a window over the already aggregated rows (one row per
    fund and sector), so it never sees the trade-level data.
    """
    agg = (enriched.groupBy("fund_id", "fund_name", "sector")
           .agg(F.sum("notional_value").alias("sector_notional"), F.count(F.lit(1)).alias("trade_count")))
    total = F.sum("sector_notional").over(Window.partitionBy("fund_id"))
    return agg.withColumn("fund_notional", total).withColumn(
        "share_pct", pct_of(F.col("sector_notional"), F.col("fund_notional")))


# X2 -----------------------------------------------------------------------------
def loss_ratio_rule(policies: DataFrame, claims: DataFrame, params: Params) -> DataFrame:
    """Fourth compliance rule: losses of a year / net premium of that year."""
    prem = (policies.filter(F.col("status") == "BOUND").groupBy("policy_year")
            .agg(F.sum("net_premium").alias("nwp")))
    loss = (claims.groupBy(F.year("loss_date").alias("policy_year"))
            .agg(F.sum("incurred_amount").alias("incurred")))
    joined = prem.join(loss, "policy_year", "left")
    rule = threshold_rule(joined, "Loss Ratio Limit", F.try_divide(F.col("incurred"), F.col("nwp")),
                          F.col("policy_year"), params.min_loss_ratio_threshold, params.near_breach_factor)
    return rule_report([rule], date_literal(params.as_of_date))


# X3 -----------------------------------------------------------------------------
def daily_rates(fx: DataFrame, base: str) -> DataFrame:
    """Per (currency, day): average direct rate (ccy -> base) and average
    reciprocal rate (base -> ccy) quoted that day."""
    direct = (fx.filter(F.col("to_currency") == base)
              .select(F.col("from_currency").alias("ccy"), "rate_date", F.col("rate").alias("direct")))
    recip = (fx.filter(F.col("from_currency") == base)
             .select(F.col("to_currency").alias("ccy"), "rate_date", F.col("rate").alias("recip")))
    both = direct.unionByName(recip, allowMissingColumns=True)
    return both.groupBy("ccy", "rate_date").agg(F.avg("direct").alias("direct"), F.avg("recip").alias("recip"))


def asof_rate_table(fx: DataFrame, base: str) -> DataFrame:
    """Dense (ccy, day) table: the latest rate on or before each calendar day.

    The grid spans each currency's first to last quote, so its size is
    (#currencies x #days), independent of the fact table; the carry-forward
    window runs over this small table only. ``last_quote`` is the grid's end.
    """
    daily = daily_rates(fx, base)
    span = daily.groupBy("ccy").agg(F.min("rate_date").alias("d0"), F.max("rate_date").alias("last_quote"))
    grid = span.select("ccy", F.explode(F.sequence("d0", "last_quote")).alias("day"))
    g = grid.join(daily.withColumnRenamed("rate_date", "day"), ["ccy", "day"], "left")
    w = Window.partitionBy("ccy").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return g.select("ccy", "day",
                    F.coalesce(F.last("direct", ignorenulls=True).over(w),
                               F.try_divide(F.lit(1.0), F.last("recip", ignorenulls=True).over(w))).alias("fx_rate"))


def base_currency_notional(enriched: DataFrame, fx: DataFrame, params: Params) -> DataFrame:
    """Notional in the base currency at the latest rate on or before the trade day.

    An as-of join expressed as equi-joins: a trade's lookup day is its day
    capped at its currency's last quote (a one-row-per-currency lookup), and
    the rate comes from the dense table on (currency, lookup day). No pass
    over the trades beyond the join itself; base-currency trades convert at 1.
    """
    base = params.base_currency
    daily = daily_rates(fx, base)
    last = daily.groupBy(F.col("ccy").alias("_ccy")).agg(F.max("rate_date").alias("_last"))
    rates = asof_rate_table(fx, base)
    t = enriched.select("trade_id", "trade_date", "currency", "notional_value", F.to_date("trade_date").alias("_day"))
    t = (t.join(last, t["currency"] == last["_ccy"], "left")
          .withColumn("_lookup", F.least(F.col("_day"), F.col("_last"))))
    j = t.join(rates, (t["currency"] == rates["ccy"]) & (t["_lookup"] == rates["day"]), "left")
    rate = F.when(F.col("currency") == base, F.lit(1.0)).otherwise(F.col("fx_rate"))
    return j.select("trade_id", "trade_date", "currency", "notional_value", rate.alias("fx_rate"),
                    (F.col("notional_value") * rate).alias("notional_base"))


# X4 -----------------------------------------------------------------------------
def claim_policy_link(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Claims joined to their policy (inner); a shuffle join on policy_id
    (AQE splits a skewed policy_id partition)."""
    p = policies.select("policy_id", "lob_id", "lob_name", "policy_year")
    return claims.join(p, "policy_id", "inner")


def loss_ratio_by_policy(policies: DataFrame, claims: DataFrame, params: Params) -> DataFrame:
    """Loss ratio by LOB x policy year with losses linked through policy_id:
    no fan-out (each claim counted once, under its own policy's LOB and year)."""
    losses = (claim_policy_link(claims, policies).groupBy("lob_id", "policy_year")
              .agg(F.sum("incurred_amount").alias("incurred_losses"),
                   F.sum("paid_amount").alias("paid_losses"),
                   F.count(F.lit(1)).alias("claim_count")))
    prem = premium_by_lob_year(policies).select("lob_id", "lob_name", "policy_year", "gwp", "nwp", "policy_count")
    return (prem.join(losses, ["lob_id", "policy_year"], "left")
            .withColumn("loss_ratio", F.try_divide(F.col("incurred_losses"), F.col("nwp"))))


def orphan_claims(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Claims whose policy_id matches no silver policy.

    Claims without a policy_id are orphans by definition; they skip the anti
    join, where they would all meet in one partition.
    """
    columns = ["claim_id", "policy_id", "loss_date", "peril", "incurred_amount"]
    named = claims.where(F.col("policy_id").isNotNull())
    unlinked = named.join(policies.select("policy_id"), "policy_id", "left_anti").select(*columns)
    return unlinked.unionByName(claims.where(F.col("policy_id").isNull()).select(*columns))


# X5 -----------------------------------------------------------------------------
def paid_triangle(claims: DataFrame) -> DataFrame:
    """Accident year x development month: paid and cumulative paid.

    The running sum is a window over the aggregated triangle (years x
    months), never over claim rows.
    """
    tri = (claims.groupBy(F.year("loss_date").alias("accident_year"), "development_month")
           .agg(F.sum("paid_amount").alias("paid"), F.count(F.lit(1)).alias("claim_count")))
    w = (Window.partitionBy("accident_year").orderBy("development_month")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return tri.withColumn("cumulative_paid", F.sum("paid").over(w))


def _in_versions(claims: DataFrame, columns: list[str], params: Params, kept: DataFrame | None, **asked) -> DataFrame:
    """A window over each claim's rows in version order (``cumulative_paid_rank``, which follows ``loss_date``).

    ``kept`` are the rows of ``claims`` without their rank, which the slices are counted from. If ``claims``
    brings the slices of its rank, the rows are not shuffled again.
    """
    base = claims.select("claim_id", "cumulative_paid_rank", *columns, *[c for c in SLICES if c in claims.columns])
    return ordered_within(base, ["claim_id"], ["cumulative_paid_rank"], micros("loss_date"), params.claim_slice,
                          counts_from=kept, counts_order=["loss_date"], **asked)


def running_incurred(claims: DataFrame, params: Params, kept: DataFrame | None = None) -> DataFrame:
    """Running incurred per claim in version order."""
    return _in_versions(claims, ["loss_date", "incurred_amount"], params, kept,
                        sums={"running_incurred": "incurred_amount"})


# X6 -----------------------------------------------------------------------------
def earned_premium(policies: DataFrame, params: Params) -> DataFrame:
    """Pro-rata earned premium at ``as_of``, summed by LOB x policy year."""
    start = F.to_date("inception_date")
    term = F.datediff(F.col("expiry_date"), start)
    elapsed = F.datediff(F.least(F.col("expiry_date"), date_literal(params.as_of_date)), start)
    frac = F.least(F.greatest(F.try_divide(elapsed.cast("double"), term.cast("double")), F.lit(0.0)), F.lit(1.0))
    return (policies.filter(F.col("status") == "BOUND")
            .groupBy("lob_id", "policy_year")
            .agg(F.sum("gross_premium").alias("gwp"),
                 F.sum(F.col("gross_premium") * frac).alias("earned_premium"),
                 F.count(F.lit(1)).alias("policy_count")))


# X7 -----------------------------------------------------------------------------
def claim_versions(claims: DataFrame, params: Params, kept: DataFrame | None = None) -> DataFrame:
    """SCD2-style validity interval of each claim row among its versions.

    ``valid_to`` is the ``loss_date`` of the next version that was not dropped.
    """
    j = _in_versions(claims, ["loss_date", "incurred_amount", "status"], params, kept, leads={"valid_to": "loss_date"})
    return j.select("claim_id", "cumulative_paid_rank", F.col("loss_date").alias("valid_from"), "valid_to",
                    F.col("valid_to").isNull().alias("is_current"), "incurred_amount", "status")


# X8 -----------------------------------------------------------------------------
def reinsurance_split(policies: DataFrame, reinsurers: DataFrame) -> DataFrame:
    """Ceded premium of the bound book split per reinsurer by cession rate.

    Both totals are scalar subqueries; the output has one row per reinsurer.
    """
    ceded = policies.filter(F.col("status") == "BOUND").agg(F.sum("ceded_premium")).scalar()
    rate_sum = reinsurers.agg(F.sum("cession_rate")).scalar()
    share = F.try_divide(F.col("cession_rate"), rate_sum)
    return reinsurers.select("reinsurer_id", "reinsurer_name", "cession_rate", share.alias("share"),
                             (share * ceded).alias("ceded_premium"))


# X9 -----------------------------------------------------------------------------
def exposure_by_rating(enriched: DataFrame) -> DataFrame:
    """Exposure rolled up by credit rating, then counterparty within it."""
    return (enriched.rollup("credit_rating", "counterparty_id")
            .agg(F.sum("notional_value").alias("total_exposure"), F.count(F.lit(1)).alias("trade_count"),
                 F.grouping_id().alias("grouping_level")))


# X10 -----------------------------------------------------------------------------
def cat_pml_by_territory(exposure: DataFrame) -> DataFrame:
    """Latest TIV / PML per (territory, peril), summed once per territory."""
    latest = latest_exposure(exposure)
    return (latest.groupBy("territory")
            .agg(F.sum("cat_tiv").alias("cat_tiv"), F.sum("cat_pml").alias("cat_pml"),
                 F.count(F.lit(1)).alias("perils")))
