"""Declarative data-quality rules (Q1-Q7).

A rule is a named SQL boolean expression. A row satisfies it only when the
expression is TRUE: NULL counts as a violation (``coalesce(expr, false)``).

* ``expect``           warn: keep every row, count violations
* ``expect_or_drop``   drop: keep rows passing every rule of the set
* ``violation_counts`` one aggregation pass -> (dataset, rule, mode, evaluated, failed)
* ``observation=``     the same counts collected as a side effect of the
                       action that writes the dataset (``DataFrame.observe``),
                       read with ``observed_counts``
* ``quarantine``       failing rows only, with a joined reason list
* ``tag_violations`` / ``split`` / ``split_summary``   lossless clean /
  quarantine split of one frame

All of it is expression-level, so it runs inside whole-stage codegen on the
executors and Catalyst can still push the resulting filter into the scan.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WARN, DROP = "warn", "drop"


@dataclasses.dataclass(frozen=True)
class Rule:
    name: str
    expr: str

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.expr), F.lit(False))

    def fails(self) -> Column:
        return ~self.passes()


@dataclasses.dataclass(frozen=True)
class RuleSet:
    dataset: str
    mode: str
    rules: tuple[Rule, ...]

    @classmethod
    def of(cls, dataset: str, mode: str, rules: dict[str, str] | Sequence[tuple[str, str]]) -> "RuleSet":
        items = rules.items() if isinstance(rules, dict) else rules
        return cls(dataset, mode, tuple(Rule(n, e) for n, e in items))

    @property
    def names(self) -> list[str]:
        return [r.name for r in self.rules]

    def all_pass(self) -> Column:
        return conjunction(r.passes() for r in self.rules)


def conjunction(cols: Iterable[Column]) -> Column:
    out = None
    for c in cols:
        out = c if out is None else (out & c)
    return F.lit(True) if out is None else out


def _count_if(cond: Column) -> Column:
    return F.count_if(cond).cast("bigint")


def metric_columns(ruleset: RuleSet) -> list[Column]:
    """Aggregates giving rows evaluated and failures per rule."""
    return [F.count(F.lit(1)).alias("_evaluated")] + [
        _count_if(r.fails()).alias(r.name) for r in ruleset.rules]


# --- warn / drop --------------------------------------------------------------

def expect(df: DataFrame, ruleset: RuleSet, observation: Observation | None = None) -> DataFrame:
    """Warn mode (Q1): all rows pass through; violations are only counted.

    With ``observation`` the counts are gathered while the action that uses
    the frame runs (no extra pass). Without it the frame is untouched, so
    readers that need no metrics keep full filter pushdown.
    """
    if observation is None:
        return df
    return df.observe(observation, *metric_columns(ruleset))


def expect_or_drop(df: DataFrame, ruleset: RuleSet, observation: Observation | None = None) -> DataFrame:
    """Drop mode (Q2/Q3): keep rows for which every rule is TRUE."""
    if observation is not None:
        df = df.observe(observation, *metric_columns(ruleset))
    return df.filter(ruleset.all_pass())


def apply_rules(df: DataFrame, ruleset: RuleSet, observation: Observation | None = None) -> DataFrame:
    if ruleset.mode == WARN:
        return expect(df, ruleset, observation)
    return expect_or_drop(df, ruleset, observation)


# --- metrics ------------------------------------------------------------------

def violation_counts(df: DataFrame, ruleset: RuleSet) -> DataFrame:
    """Q4 as a DataFrame: one row per rule, from one partial+final aggregate.

    The aggregate is a single row however large ``df`` is (map-side partial
    sums, one tiny exchange); ``unpivot`` turns it into rule rows.
    """
    one = df.agg(*metric_columns(ruleset))
    long = one.unpivot(ids=["_evaluated"], values=ruleset.names,
                       variableColumnName="rule", valueColumnName="failed")
    return long.select(
        F.lit(ruleset.dataset).alias("dataset"),
        F.col("rule"),
        F.lit(ruleset.mode).alias("mode"),
        F.col("_evaluated").alias("evaluated"),
        F.col("failed").cast("bigint").alias("failed"),
    )


def observed_counts(observation: Observation, ruleset: RuleSet) -> list[dict]:
    """Rows of (dataset, rule, mode, evaluated, failed) from an observation.

    Call only after an action on the observed frame has finished.
    """
    got = observation.get
    return [dict(dataset=ruleset.dataset, rule=r.name, mode=ruleset.mode,
                 evaluated=int(got.get("_evaluated", 0) or 0), failed=int(got.get(r.name, 0) or 0))
            for r in ruleset.rules]


# --- quarantine -----------------------------------------------------------------

def reason_list(reasons: Sequence[tuple[str, Column]]) -> Column:
    """Comma-joined names of the reasons whose condition is TRUE (nulls skipped)."""
    return F.concat_ws(", ", *[F.when(cond, F.lit(name)) for name, cond in reasons])


def quarantine(df: DataFrame, reasons: Sequence[tuple[str, Column]], at, column: str = "failure_reasons",
               at_column: str = "quarantined_at") -> DataFrame:
    """Q6: rows failing any reason, with the reason list and a timestamp."""
    any_failed = None
    for _, cond in reasons:
        c = F.coalesce(cond, F.lit(False))
        any_failed = c if any_failed is None else (any_failed | c)
    return (df.filter(any_failed)
              .withColumn(column, reason_list(reasons))
              .withColumn(at_column, F.lit(at)))


def tag_violations(df: DataFrame, ruleset: RuleSet, column: str = "_violations") -> DataFrame:
    """Q7: one array column naming every rule the row fails (empty = clean)."""
    names = F.array(*[F.when(r.fails(), F.lit(r.name)) for r in ruleset.rules])
    return df.withColumn(column, F.filter(names, lambda x: x.isNotNull()))


def split(df: DataFrame, ruleset: RuleSet, column: str = "_violations") -> tuple[DataFrame, DataFrame]:
    """Lossless clean / quarantine split of one tagged frame."""
    tagged = tag_violations(df, ruleset, column)
    clean = tagged.filter(F.size(column) == 0).drop(column)
    bad = tagged.filter(F.size(column) > 0)
    return clean, bad


def split_summary(df: DataFrame, ruleset: RuleSet) -> DataFrame:
    """Q7 summary: rows per side (clean / quarantine) and violation list."""
    tagged = tag_violations(df, ruleset)
    side = F.when(F.size("_violations") == 0, F.lit("clean")).otherwise(F.lit("quarantine"))
    return (tagged.groupBy(side.alias("side"), F.array_join("_violations", ", ").alias("violations"))
            .agg(F.count(F.lit(1)).alias("row_count")))
