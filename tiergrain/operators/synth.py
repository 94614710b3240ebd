"""Date spines made on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def weekday_spine(df: DataFrame, start: Column, end: Column, name: str) -> DataFrame:
    """One row per weekday (Mon-Fri) between two dates, for every row of ``df``.

    A generator per driving row (``explode(sequence)``), not a join; the
    bounds may be scalar subqueries.
    """
    out = df.withColumn(name, F.explode(F.sequence(start, end)))
    return out.filter(F.dayofweek(F.col(name)).between(2, 6))
