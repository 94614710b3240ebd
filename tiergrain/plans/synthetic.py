"""The calendar of the quoted currencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiergrain.operators.synth import weekday_spine


def fx_date_spine(fx: DataFrame) -> DataFrame:
    """Every weekday between the first and last quote, for every pair."""
    pairs = (fx.filter(F.col("from_currency").isNotNull() & F.col("to_currency").isNotNull())
             .select("from_currency", "to_currency").distinct())
    d0 = fx.agg(F.min("rate_date")).scalar()
    d1 = fx.agg(F.max("rate_date")).scalar()
    return weekday_spine(pairs, d0, d1, "rate_date")
