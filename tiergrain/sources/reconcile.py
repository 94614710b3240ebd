"""Reconciling two versions of a table: digests first, then only ranges that differ.

``write_digested`` stores a table by range of its keys' hash, one folder a range, with a
digest of every range (number of rows, sum of row hashes). ``reconcile`` compares the
digests, a bounded list, and reads the folders of the differing ranges alone.
Rows are compared as a multiset: a row that one version has three times and
the other once differs by two copies. Null keys and values compare as equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE = "_range"
RANGES = 256


def _row_hash(columns: Sequence[str]):
    return F.xxhash64(*[x for c in columns for x in (F.col(c), F.col(c).isNull())])


def digests(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and sum of row hashes of every range; exact for any number of copies."""
    return rows.groupBy(RANGE).agg(F.count("*").alias("rows"), F.sum(_row_hash(columns).cast("decimal(28,0)")).alias("digest"))


def write_digested(df: DataFrame, base: str, keys: Sequence[str], ranges: int = RANGES) -> None:
    """Store ``df`` under ``base``: ``rows/_range=<n>`` folders and ``digests``."""
    ranged = df.withColumn(RANGE, F.floor((F.shiftrightunsigned(F.xxhash64(*keys), 1) / 2.0 ** 63) * ranges).cast("int"))
    ranged.repartition(RANGE).write.mode("overwrite").partitionBy(RANGE).parquet(f"{base}/rows")
    digests(df.sparkSession.read.parquet(f"{base}/rows"), df.columns).write.mode("overwrite").parquet(f"{base}/digests")


def differing_ranges(spark: SparkSession, old: str, new: str) -> list[int]:
    """Ranges whose digests differ: at most as many numbers as there are ranges."""
    a, b = (spark.read.parquet(f"{p}/digests") for p in (old, new))
    both = a.join(b.select(RANGE, F.col("rows").alias("n"), F.col("digest").alias("d")), RANGE, "full")
    same = F.col("rows").eqNullSafe(F.col("n")) & F.col("digest").eqNullSafe(F.col("d"))
    return sorted(r[0] for r in both.where(~same).select(RANGE).collect())


def reconcile(spark: SparkSession, old: str, new: str, keys: Sequence[str]) -> DataFrame:
    """Differing rows with ``change`` and ``copies``.

    ``added`` and ``removed``: the key is in one version only; ``changed_from`` and ``changed_to``: in both.
    """
    ranges = differing_ranges(spark, old, new)
    sides = [spark.read.parquet(f"{p}/rows").where(F.col(RANGE).isin(ranges)).drop(RANGE) for p in (old, new)]
    columns = sides[0].columns
    tagged = [side.groupBy(*columns).agg(F.count("*").alias("_n")).withColumn("_side", F.lit(s)) for side, s in zip(sides, (-1, 1))]
    both = tagged[0].unionByName(tagged[1])
    rows = both.groupBy(*columns).agg(F.sum(F.col("_n") * F.col("_side")).alias("_more"))
    # a key's versions: which sides have it at all
    held = both.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.count_distinct("_side").alias("_sides"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    more = F.col("_more") > 0
    change = F.when(F.col("_sides") == 2, F.when(more, "changed_to").otherwise("changed_from")) \
        .otherwise(F.when(more, "added").otherwise("removed"))
    return rows.where("_more <> 0").join(held, same).select(*columns, change.alias("change"), F.abs("_more").alias("copies"))
