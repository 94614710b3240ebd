"""Scalar column helpers shared by the pipelines (F7-F9, §2.2 functions)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ts_literal(value: dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal: the testdata timestamps are NTZ, so the
    pinned clock must be too (no session-zone shift on either side)."""
    return F.expr(f"TIMESTAMP_NTZ '{value:%Y-%m-%d %H:%M:%S}'")


def ts_sql(value: dt.datetime) -> str:
    return f"TIMESTAMP_NTZ '{value:%Y-%m-%d %H:%M:%S}'"


def date_literal(value: dt.date) -> Column:
    return F.lit(value).cast("date")


def bucket(value: Column, edges: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Half-open buckets: first label whose ``value < edge``; else ``otherwise``.

    A null value matches no edge and falls to ``otherwise``.
    """
    out = None
    for edge, label in edges:
        cond = value < F.lit(edge)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(otherwise))


def trunc_date(unit: str, c: str | Column) -> Column:
    """``date_trunc`` returned as DATE (Spark's returns TIMESTAMP)."""
    return F.date_trunc(unit, c).cast("date")


# |x| below 2**22 rounds to single precision; at and above it the float grid
# (0.5 and coarser) has midpoints on whole cents, so a 1/8 grid is used
# instead, whose midpoints (odd sixteenths) are never a whole cent.
STABLE_SPLIT = 4194304.0


def stabilize_doubles(df: DataFrame) -> DataFrame:
    """Comparison form of a result: every DOUBLE rounded to a coarse grid.

    Sums and averages of doubles depend on the order rows are added, which
    differs between engines and runs; rounding to ~7 significant digits (or
    1/8 for large magnitudes) makes the value identical in both engines
    while money values that are whole cents never sit on a rounding
    midpoint. ``+ 0.0`` folds -0.0 into 0.0. Used only by the query
    wrappers, never inside an operator.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            c = F.col(f.name)
            st = (F.when(F.abs(c) < F.lit(STABLE_SPLIT), c.cast("float").cast("double"))
                   .otherwise(F.round(c * F.lit(8.0)) / F.lit(8.0)))
            cols.append((st + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def double_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
