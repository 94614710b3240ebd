"""Per-group ordered numbering, running sums and leads that survive hot keys.

``row_number() over (partition by k order by o)`` sends every row of one key
to one task. When one key holds a large share of the data that task holds it
all. ``ordered_within`` keeps the exact result over slices of the order:

1. Every row belongs to the slice ``floor(position / width)`` of its key, where
   ``position`` is a whole number that never falls along the order (a day, a rank).
2. The window runs on (key, slice): one shuffle of the rows.
3. What the other slices of the key hold (rows, sums, first values) comes from an
   aggregate per (key, slice), combined map-side; a window over these few rows gives
   each slice what lies before or after it, and an equi-join on the same (key, slice)
   brings it back without another shuffle of the rows. Slices with nothing around send no row.

Slices depend on the rows alone: nothing is sampled, written or decided while the
frame is built, and a lost task recomputes the same rows. A task holds at most
the rows of one key in one slice; choose ``width`` so that they fit.

With ``keep_slices`` the result keeps its key and slice columns. A further window over the
same slices takes them from there and shuffles no row again, whatever was dropped between.

Null keys form one group and null positions come first, as in SQL windows. The key
travels as a struct, in which nulls are equal, so plain equality joins it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = ("_key", "_slice")
_FIRST_SLICE = -(1 << 63)   # of rows without a position


def _order_cols(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in order]


def _plain(df: DataFrame, keys, order, rank: str | None, sums: dict[str, str], leads: dict[str, str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbers = [F.row_number().over(w).alias(rank)] if rank else []
    return df.select("*", *numbers, *[F.sum(src).over(run).alias(n) for n, src in sums.items()],
                     *[F.lead(src).over(w).alias(n) for n, src in leads.items()])


def _placed(df: DataFrame, keys, position: Column, width: int) -> DataFrame:
    """``df`` with its rows' key and slice."""
    if set(SLICES) <= set(df.columns):
        return df
    number = F.call_function("div", position - F.pmod(position, F.lit(width)), F.lit(width))
    return df.select("*", F.struct(*[F.col(k) for k in keys]).alias("_key"),
                     F.coalesce(number, F.lit(_FIRST_SLICE)).alias("_slice"))


def _sliced(df: DataFrame, counts_from: DataFrame, keys, order, counts_order, position: Column, width: int,
            rank: str | None, sums: dict[str, str], leads: dict[str, str], keep_slices: bool) -> DataFrame:
    # per (key, slice): rows, sums and first values, then those of the slices around it
    aggs = [F.count(F.lit(1)).alias("_n")] if rank else []
    aggs += [F.sum(src).alias(f"_s_{n}") for n, src in sums.items()]
    if leads:
        firsts = F.struct(*[F.col(src).alias(n) for n, src in leads.items()])
        aggs.append(F.min_by(firsts, F.struct(*[F.col(c) for c in counts_order])).alias("_first"))
    per = _placed(counts_from, keys, position, width).groupBy(*SLICES).agg(*aggs)
    along = Window.partitionBy("_key").orderBy("_slice")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    around = [F.sum("_n").over(before).alias("_n_before")] if rank else []
    around += [F.sum(f"_s_{n}").over(before).alias(f"_b_{n}") for n in sums]
    around += [F.lead("_first").over(along).alias("_after")] if leads else []
    # a slice without others around it needs no row: the left join gives the same nulls
    names = ["_n_before"] * bool(rank) + [f"_b_{n}" for n in sums] + ["_after"] * bool(leads)
    carried = per.select(*SLICES, *around).where(" OR ".join(f"`{n}` IS NOT NULL" for n in names))

    w = Window.partitionBy(*SLICES).orderBy(*_order_cols(order))
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = [F.row_number().over(w).alias("_local_rank")] if rank else []
    local += [F.sum(src).over(run).alias(f"_l_{n}") for n, src in sums.items()]
    # a struct, so that a null value differs from having no next row
    local += [F.lead(F.struct(*[F.col(src).alias(n) for n, src in leads.items()])).over(w).alias("_next")] if leads else []
    # key columns that nothing else reads travel in the key alone
    inside = set(keys) - {*order, *sums.values(), *leads.values()}
    rows = _placed(df, keys, position, width).drop(*inside).select("*", *local).join(carried, list(SLICES), "left")

    cols: list[Column] = [F.col("_key")[c].alias(c) if c in inside else F.col(c) for c in df.columns if c not in SLICES]
    if rank:
        cols.append((F.col("_local_rank") + F.coalesce("_n_before", F.lit(0))).cast("int").alias(rank))
    for n in sums:
        # null as long as no earlier row has a value, like SUM over a window
        own, earlier = F.col(f"_l_{n}"), F.col(f"_b_{n}")
        cols.append(F.when(own.isNull(), earlier).when(earlier.isNull(), own).otherwise(own + earlier).alias(n))
    cols += [F.coalesce("_next", "_after")[n].alias(n) for n in leads]
    return rows.select(*cols, *(SLICES if keep_slices else ()))


def ordered_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], position: Column | None = None,
                   width: int | None = None, rank: str | None = None, sums: dict[str, str] | None = None,
                   leads: dict[str, str] | None = None, counts_from: DataFrame | None = None,
                   counts_order: Sequence[str] | None = None, keep_slices: bool = False) -> DataFrame:
    """Row number, running sums and next values per key in ``order`` (asc, nulls first).

    ``sums`` and ``leads`` map new columns to source columns. ``position`` must not fall along
    ``order`` and be null only for its first rows; without a ``width`` the plain window runs.
    ``order`` should end in tie-breakers that make it total; rows equal on every order
    column get consecutive numbers in an unspecified order.
    ``counts_from`` (same rows as ``df``) is what slices are counted from, e.g. ``df``
    without an ``observe`` node that must fire once; ``counts_order`` tells the first row
    of a slice there (default: ``order``). Ranks are 32-bit, as in SQL's
    ROW_NUMBER: a key with more than 2^31 - 1 rows fails loudly under ANSI.
    """
    sums, leads = dict(sums or {}), dict(leads or {})
    if width is None or position is None:
        return _plain(df, keys, order, rank, sums, leads)
    return _sliced(df, counts_from if counts_from is not None else df, keys, order, counts_order or order,
                   position, width, rank, sums, leads, keep_slices)


def row_number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str,
                      position: Column | None = None, width: int | None = None,
                      counts_from: DataFrame | None = None, keep_slices: bool = False) -> DataFrame:
    """``row_number() over (partition by keys order by order)``."""
    return ordered_within(df, keys, order, position, width, rank=name, counts_from=counts_from, keep_slices=keep_slices)
