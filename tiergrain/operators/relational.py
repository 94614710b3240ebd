"""Joins, scalar aggregates, shares and top-1 selection.

Scale notes
-----------
* No join side is hinted and no size is measured while a frame is built. The
  planner broadcasts scans below ``spark.sql.autoBroadcastJoinThreshold`` from
  their file sizes, and AQE switches a planned sort-merge join to a broadcast, or
  splits its skewed partitions, from the shuffle sizes it measures.
* Scalar aggregates (a total, an average rate) are scalar subqueries
  (``DataFrame.scalar()``): computed once by their own partial+final
  aggregate and inlined as a value. No ``collect`` in the middle of a
  definition, no nested-loop join against a one-row frame.
* Top-1 per group is an aggregate (``max_by`` over an ordering struct), not
  a sorted window: it combines map-side, so a group holding a third of the
  rows costs one partial aggregate per task instead of one giant sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def scan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df`` (file sizes for scans); runs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def left_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                columns: Sequence[Column | str]) -> DataFrame:
    """Left outer equi-join adding ``columns`` of ``dim`` to every fact row.

    Facts without a match keep null attributes; a duplicated dimension key
    repeats the fact, exactly as a SQL LEFT JOIN does.
    """
    k = f"__{dim_key}_k"
    d = dim.select(F.col(dim_key).alias(k), *columns)
    return fact.join(d, fact[fact_key] == d[k], "left").drop(k)


def enrich_star(fact: DataFrame, dims: Sequence[tuple]) -> DataFrame:
    """Star enrichment: a chain of left lookups.

    ``dims`` items are ``(dim_df, fact_key, dim_key, columns)``.
    """
    out = fact
    for dim, fact_key, dim_key, columns in dims:
        out = left_lookup(out, dim, fact_key, dim_key, columns)
    return out


def scalar_or_default(agg: Column, source: DataFrame, default: float) -> Column:
    """A10: one aggregate value of ``source`` as a column, with a default.

    Mirrors Python's ``value or default``: a null *or zero* result takes the
    default.
    """
    value = source.agg(agg.alias("v")).scalar()
    return F.coalesce(F.nullif(value, F.lit(0)), F.lit(default))


def pct_of(part: Column, total: Column) -> Column:
    """``part / total * 100``; null instead of an error when total is 0."""
    return F.try_divide(part, total) * F.lit(100.0)


def top1_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   payload: Sequence[str]) -> DataFrame:
    """Per group of ``keys``, the row with the greatest ``order`` tuple.

    Equivalent to ``row_number() over (partition by keys order by order desc)
    = 1`` with ``order``'s trailing columns as tie-breakers (null orderings
    lose, like DESC NULLS LAST), computed as an aggregate.
    """
    ordering = F.struct(*[F.col(c) for c in order])
    best = F.max_by(F.struct(*[F.col(c) for c in payload]), ordering).alias("_best")
    return (df.groupBy(*keys).agg(best)
              .select(*keys, *[F.col(f"_best.{c}").alias(c) for c in payload]))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name of frames with one schema."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
