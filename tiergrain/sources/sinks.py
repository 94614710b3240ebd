"""Batch sinks: raw overwrite (S8), view refresh (S7), clustered write (S10),
row-count audit (S11).

A refreshed view is a new ``version=<n>`` folder under the view's base; the
reader takes the highest version present. A version becomes visible only
when its write job commits (files are moved out of ``_temporary``, which
readers ignore), so readers never see a half-written view and nothing is
deleted in place. Old versions can be expired by retention outside the job.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiergrain.session import hadoop_path

_VERSION = re.compile(r"version=(\d+)")


def write_table(df: DataFrame, path: str) -> str:
    """Replace a raw table's files with ``df``."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> DataFrame:
    """Write a dimension bucketed and sorted by its join key (a catalog table
    stored at ``path`` in the shared folder) and return a reader of it.

    A later sort-merge join on ``key`` takes the table's bucket layout as its
    partitioning: only the other side is shuffled, however often the join
    runs (e.g. once per streaming micro-batch).
    """
    # one task per bucket: without it every task would write a file for every bucket
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
       .option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def _versions(spark: SparkSession, base: str) -> list[int]:
    """Committed versions of a view: folders that hold the writer's _SUCCESS mark.

    Listed by the path's own file system, so a path without a scheme works on
    HDFS and object stores too. One entry per version reaches the driver, no
    data files. A failed listing is raised, not taken for an empty view.
    """
    fs, where = hadoop_path(spark, base)
    if not fs.exists(where):
        return []
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = []
    for status in fs.listStatus(where):
        m = _VERSION.fullmatch(status.getPath().getName())
        if m and fs.exists(path(status.getPath(), "_SUCCESS")):
            found.append(int(m.group(1)))
    return sorted(found)


def clustered(df: DataFrame, cluster_by: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by the clustering keys before a write.

    Each output file then covers a narrow, disjoint key range, so parquet
    min/max statistics let readers skip files on filters over those keys.
    ``repartitionByRange`` samples the keys, so a hot key spreads over as
    many files as its rows need rather than landing in one.
    """
    cols = [F.col(c) for c in cluster_by]
    out = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    return out.sortWithinPartitions(*cols)


def publish_view(df: DataFrame, base: str, cluster_by: Sequence[str] | None = None,
                 partitions: int | None = None) -> str:
    """Write a full recompute of a view as its next version."""
    spark = df.sparkSession
    nxt = max(_versions(spark, base), default=0) + 1
    path = f"{base.rstrip('/')}/version={nxt:08d}"
    out = clustered(df, cluster_by, partitions) if cluster_by else df
    out.write.mode("errorifexists").parquet(path)
    return path


def read_view(spark: SparkSession, base: str) -> DataFrame:
    """Batch read of the newest committed version of a view."""
    vs = _versions(spark, base)
    if not vs:
        raise FileNotFoundError(f"no committed version under {base}")
    return spark.read.parquet(f"{base.rstrip('/')}/version={vs[-1]:08d}")


def row_count_audit(tables: dict[str, DataFrame], checks: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Rows per table plus optional per-defect counts, one union job.

    ``checks`` maps a table to {check_name: SQL predicate}; each becomes a
    ``count_if`` in the same aggregate as the row count.
    """
    checks = checks or {}
    parts = []
    for name, df in tables.items():
        aggs = [F.count(F.lit(1)).alias("rows")]
        names = list(checks.get(name, {}))
        aggs += [F.count_if(F.coalesce(F.expr(e), F.lit(False))).alias(c) for c, e in checks.get(name, {}).items()]
        one = df.agg(*aggs)
        if names:
            long = one.unpivot(ids=["rows"], values=names, variableColumnName="check", valueColumnName="matching")
        else:
            long = one.select("rows", F.lit(None).cast("string").alias("check"),
                              F.lit(None).cast("bigint").alias("matching"))
        parts.append(long.select(F.lit(name).alias("table_name"), F.col("rows").cast("bigint").alias("row_count"),
                                 F.col("check"), F.col("matching").cast("bigint").alias("matching")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
