"""Daily price bars from quotes (D8, re-aimed from random generation).

One aggregate per (security, day): first / last quote by (ts, tie-breaker)
via ``min_by`` / ``max_by`` on an ordering struct, plus max, min, count
and the traded volume.
It combines map-side, so a hot security-day costs one partial aggregate per
task, not one sorted group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily_bars(quotes: DataFrame, key: str, ts: str, value: str, tiebreak: str, size: Column,
               key_alias: str = "security_key") -> DataFrame:
    order = F.struct(F.col(ts), F.col(tiebreak))
    return (quotes.groupBy(F.col(key).alias(key_alias), F.to_date(ts).alias("day"))
            .agg(F.min_by(value, order).alias("open_price"),
                 F.max(value).alias("high_price"),
                 F.min(value).alias("low_price"),
                 F.max_by(value, order).alias("close_price"),
                 F.sum(size).alias("volume"),
                 F.count(F.lit(1)).alias("quotes")))
