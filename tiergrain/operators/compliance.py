"""Threshold compliance rules over aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiergrain.operators.relational import union_all

REPORT_COLUMNS = ("rule_name", "threshold", "actual_value", "is_breached", "is_near_breach", "entity")


def breach_flags(value: Column, threshold: float, near_factor: float = 0.8) -> tuple[Column, Column]:
    """C4: breached = v > t; near = v > f*t and not v > t (both strict)."""
    t = F.lit(float(threshold))
    breached = value > t
    near = (value > F.lit(float(threshold) * near_factor)) & ~(value > t)
    return breached, near


def threshold_rule(agg: DataFrame, rule_name: str, value: Column, entity: Column,
                   threshold: float, near_factor: float = 0.8) -> DataFrame:
    """One rule's report rows from an aggregate frame (6 common columns)."""
    breached, near = breach_flags(value, threshold, near_factor)
    return agg.select(
        F.lit(rule_name).alias("rule_name"),
        F.lit(float(threshold)).alias("threshold"),
        value.cast("double").alias("actual_value"),
        breached.alias("is_breached"),
        near.alias("is_near_breach"),
        entity.cast("string").alias("entity"),
    )


def threshold_rules(agg: DataFrame, specs: Sequence[tuple]) -> DataFrame:
    """Several rules over one aggregate in a single projection (no union).

    ``specs`` items are ``(selector, rule_name, value, entity, threshold,
    near_factor)``; each row of ``agg`` takes the first spec whose selector is
    TRUE (e.g. one spec per grouping set of a ``groupingSets`` aggregate).
    Rows matched by no selector are dropped. One pass over ``agg`` replaces
    a union of per-rule branches that the optimizer would prune, and so
    compute, separately.
    """
    def pick(get):
        out = None
        for spec in specs:
            sel, val = spec[0], get(spec)
            out = F.when(sel, val) if out is None else out.when(sel, val)
        return out

    any_sel = None
    for spec in specs:
        any_sel = spec[0] if any_sel is None else (any_sel | spec[0])
    value = pick(lambda sp: sp[2].cast("double"))
    t = pick(lambda sp: F.lit(float(sp[4])))
    near_t = pick(lambda sp: F.lit(float(sp[4]) * sp[5]))
    return agg.filter(any_sel).select(
        pick(lambda sp: F.lit(sp[1])).alias("rule_name"),
        t.alias("threshold"),
        value.alias("actual_value"),
        (value > t).alias("is_breached"),
        ((value > near_t) & ~(value > t)).alias("is_near_breach"),
        pick(lambda sp: sp[3].cast("string")).alias("entity"),
    )


def with_severity(report: DataFrame, check_date) -> DataFrame:
    """C5 columns on a rule report: check date and severity."""
    return (report.withColumn("check_date", F.lit(check_date))
            .withColumn("severity", severity(F.col("is_breached"), F.col("is_near_breach"))))


def severity(breached: Column, near: Column) -> Column:
    """CRITICAL / WARNING / CLEAR (null flags give CLEAR)."""
    return (F.when(breached, F.lit("CRITICAL"))
             .when(near, F.lit("WARNING"))
             .otherwise(F.lit("CLEAR")))


def rule_report(rules: Sequence[DataFrame], check_date) -> DataFrame:
    """Union of rule rows + check date + severity."""
    return with_severity(union_all(list(rules)), check_date)
