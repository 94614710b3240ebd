"""Interval joins as equi-joins: points in periods, overlapping periods.

Time is cut into bins of ``width``. A period belongs to every bin it touches, a
point to one bin, so a point and a period meet at most once. Two periods meet in
several bins; the pair is kept only in the first bin they share. The exact
condition is tested after the equi-join, so there is no nested-loop join and
results do not depend on ``width``; choose it near the usual length of a period.

A bin with more than ``hot_rows`` points is *hot*: its points are dealt over
sub-bins by their hash, and the periods of that bin are copied to each.
Positions are longs; periods are half open. Rows with a null position, or a
period without length, match nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000


def _bin(position: Column, width: int) -> Column:
    return ((position - F.pmod(position, F.lit(width))) / width).cast("long")


def _bins(periods: DataFrame, start: str, end: str, width: int) -> DataFrame:
    return periods.where(F.col(start) < F.col(end)).withColumn(
        "_bin", F.explode(F.sequence(_bin(F.col(start), width), _bin(F.col(end) - 1, width))))


def _dealt(rows: DataFrame, periods: DataFrame, on: list[str], hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_sub``: hot bins' rows dealt out, their periods copied."""
    hot = rows.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows) \
        .select(*on, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_parts"))
    parts = F.coalesce("_parts", F.lit(1))
    dealt = rows.join(hot, on, "left").withColumn("_sub", F.pmod(F.xxhash64(*rows.columns), parts).cast("int")).drop("_parts")
    copied = periods.join(hot, on, "left").withColumn("_sub", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return dealt, copied


def points_in_periods(points: DataFrame, periods: DataFrame, at: str, start: str, end: str, width: int,
                      keys: Sequence[str] = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    """Pairs with ``start <= at < end`` and equal keys; all columns of both sides (names must differ but for the keys)."""
    on = [*keys, "_bin"]
    rows = points.where(F.col(at).isNotNull()).withColumn("_bin", _bin(F.col(at), width))
    rows, spans = _dealt(rows, _bins(periods, start, end, width), on, hot_rows)
    return rows.join(spans, [*on, "_sub"]).where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("_bin", "_sub")


def overlapping_periods(left: DataFrame, right: DataFrame, start: tuple[str, str], end: tuple[str, str], width: int,
                        keys: Sequence[str] = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    """Pairs of a left and a right period that share a position, each pair once."""
    on = [*keys, "_bin"]
    rows, spans = _dealt(_bins(left, start[0], end[0], width), _bins(right, start[1], end[1], width), on, hot_rows)
    first = _bin(F.greatest(F.col(start[0]), F.col(start[1])), width)
    shared = (F.col(start[0]) < F.col(end[1])) & (F.col(start[1]) < F.col(end[0]))
    return rows.join(spans, [*on, "_sub"]).where(shared & (F.col("_bin") == first)).drop("_bin", "_sub")
