"""Ordered operators over slices of a position: as-of join, lag, dense rank,
rolling frames, sessions. No key's rows have to meet in one task.

A window ``partition by k order by p`` sends all rows of a key to one task.
Here every row belongs to the slice ``floor(p / width)`` of its position (a long:
microseconds, a sequence number), windows run on (key, slice), and what a
slice needs of the earlier ones is carried over:

* *carried value or count*: one row per (key, slice) holds the slice's last row or
  its count; a window over these few rows gives each slice what lies before it,
  and an equi-join on (key, slice) brings it back;
* *halo*: a frame that reaches ``span`` back gets copies of the rows that lie within
  ``span`` before its slice. A row is copied to ``1 + span / width`` slices.

Slices depend on the rows alone, so nothing is sampled or written while a
frame is built, and a lost task recomputes the same rows. Choose ``width`` so that
one key's rows in one slice (and halo) fit a task.

Null keys form a group, as in SQL windows (they match nothing in the as-of
join). Rows with a null position get null results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "_slice"


def micros(at: str) -> Column:
    """Position of a timestamp column."""
    return F.unix_micros(F.col(at).cast("timestamp"))


def _slice(position: Column, width: int) -> Column:
    """``floor(position / width)`` in whole numbers."""
    return ((position - F.pmod(position, F.lit(width))) / width).cast("long")


def _with_earlier(rows: DataFrame, per_slice: DataFrame, keys: Sequence[str], carried: dict[str, Column]) -> DataFrame:
    """``rows`` with what the earlier slices of their key hold.

    ``per_slice`` has one row per (key, slice); ``carried`` are window aggregates over its earlier slices.
    """
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    on = [*keys, SLICE]
    placed = per_slice.where(F.col(SLICE).isNotNull())      # rows without a position come before no others
    earlier = placed.select(*[F.col(k).alias(f"_on_{k}") for k in on], *[c.over(before).alias(n) for n, c in carried.items()])
    same = F.lit(True)
    for k in on:
        same = same & F.col(k).eqNullSafe(F.col(f"_on_{k}"))
    return rows.join(earlier, same, "left").drop(*[f"_on_{k}" for k in on])


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: Column, right_at: Column,
              columns: Sequence[str], tie: str, width: int) -> DataFrame:
    """Every left row with ``columns`` of the right row of its key that is last at or before it.

    Of right rows at one position the one with the largest ``tie`` counts.
    Left rows without an earlier right row get nulls.
    """
    value = F.struct(*[F.col(c) for c in columns])
    known = right.withColumn("_at", right_at).where(" AND ".join(f"{k} IS NOT NULL" for k in (*keys, "_at")))
    own = known.select(*keys, "_at", F.lit(0).alias("_side"), F.col(tie).alias("_tie"), value.alias("_value"))
    rows = left.select(*keys, left_at.alias("_at"), F.lit(1).alias("_side"),
                       F.struct(*[F.col(c) for c in left.columns]).alias("_row"))
    both = own.unionByName(rows, allowMissingColumns=True).withColumn(SLICE, _slice(F.col("_at"), width))
    w = Window.partitionBy(*keys, SLICE).orderBy("_at", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    local = both.withColumn("_last", F.last("_value", ignorenulls=True).over(w)).where("_side = 1") \
        .select(*keys, SLICE, "_at", "_row", "_last")
    per = both.groupBy(*keys, SLICE).agg(F.max_by("_value", F.when(F.col("_side") == 0, F.struct("_at", "_tie"))).alias("_end"))
    found = _with_earlier(local, per, keys, {"_earlier": F.last("_end", ignorenulls=True)})
    taken = F.when(F.col("_at").isNotNull(), F.coalesce("_last", "_earlier"))
    return found.select("_row.*", *[taken[c].alias(c) for c in columns])


def previous_in_order(df: DataFrame, keys: Sequence[str], at: Column, order: Sequence[str], columns: Sequence[str],
                      width: int, prefix: str = "previous_") -> DataFrame:
    """``lag(c) over (partition by keys order by at, order)``; ``order`` makes the order total."""
    value = F.struct(*[F.col(c) for c in columns])
    rows = df.withColumn("_at", at).withColumn(SLICE, _slice(F.col("_at"), width)).withColumn("_value", value)
    w = Window.partitionBy(*keys, SLICE).orderBy("_at", *order)
    local = rows.withColumn("_last", F.lag("_value").over(w))
    per = rows.groupBy(*keys, SLICE).agg(F.max_by("_value", F.struct("_at", *order)).alias("_end"))
    found = _with_earlier(local, per, keys, {"_earlier": F.last("_end", ignorenulls=True)})
    taken = F.when(F.col("_at").isNotNull(), F.coalesce("_last", "_earlier"))
    return found.select(*df.columns, *[taken[c].alias(f"{prefix}{c}") for c in columns])


def dense_rank_in_order(df: DataFrame, keys: Sequence[str], at: Column, name: str, width: int) -> DataFrame:
    """``dense_rank() over (partition by keys order by at)``: equal positions share a slice."""
    rows = df.withColumn("_at", at).withColumn(SLICE, _slice(F.col("_at"), width))
    local = rows.withColumn("_rank", F.dense_rank().over(Window.partitionBy(*keys, SLICE).orderBy("_at")))
    per = rows.groupBy(*keys, SLICE).agg(F.count_distinct("_at").alias("_n"))
    found = _with_earlier(local, per, keys, {"_earlier": F.sum("_n")})
    rank = F.when(F.col("_at").isNotNull(), F.col("_rank") + F.coalesce("_earlier", F.lit(0)))
    return found.select(*df.columns, rank.cast("long").alias(name))


def rolling(df: DataFrame, keys: Sequence[str], at: Column, span: int, frames: dict[str, Column], width: int) -> DataFrame:
    """Aggregates over the key's rows from ``span`` before each row's position to it, both included.

    ``frames`` are aggregates without a window, such as ``F.sum("x")``.
    """
    rows = df.withColumn("_at", at)
    first, last = _slice(F.col("_at"), width), _slice(F.col("_at") + span, width)
    # a row without a position is in no frame, but stays
    slices = F.when(F.col("_at").isNotNull(), F.sequence(first, last)).otherwise(F.array(F.lit(None).cast("long")))
    copies = rows.select("*", F.posexplode(slices).alias("_copy", SLICE))
    w = Window.partitionBy(*keys, SLICE).orderBy("_at").rangeBetween(-span, 0)
    framed = copies.select("*", *[F.when(F.col("_at").isNotNull(), c.over(w)).alias(n) for n, c in frames.items()])
    return framed.where("_copy = 0").select(*df.columns, *frames)


def sessions(df: DataFrame, keys: Sequence[str], at: str, order: Sequence[str], gap: int, width: int) -> DataFrame:
    """Sessions per key: rows with at most ``gap`` microseconds between neighbours.

    ``keys``, ``session_start``, ``session_end``, ``n``. Gaps are found in slices, sessions that
    cross a border are stitched by the carried last row and number of starts.
    Rows without a time are in no session.
    """
    timed = df.where(F.col(at).isNotNull()).select(*keys, at, *order)
    rows = previous_in_order(timed, keys, micros(at), order, [at], width)
    starts = F.coalesce(micros(at) - micros(f"previous_{at}") > gap, F.lit(True)).cast("long")
    rows = rows.withColumn("_starts", starts).withColumn(SLICE, _slice(micros(at), width))
    w = Window.partitionBy(*keys, SLICE).orderBy(at, *order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("_number", F.sum("_starts").over(w))
    per = rows.groupBy(*keys, SLICE).agg(F.sum("_starts").alias("_n"))
    found = _with_earlier(local, per, keys, {"_earlier": F.sum("_n")})
    return found.groupBy(*keys, (F.col("_number") + F.coalesce("_earlier", F.lit(0))).alias("_session")) \
        .agg(F.min(at).alias("session_start"), F.max(at).alias("session_end"), F.count("*").alias("n")).drop("_session")
