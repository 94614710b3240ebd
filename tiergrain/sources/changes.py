"""Change application: current rows (SCD1) and history (SCD2) from keyed changes.

A change has a key, a sequence number, an operation (``upsert`` or ``delete``) and
values. Changes may come in any order and more than once. A batch is written
to the log's ``batch=<id>`` folder (a repeated batch replaces itself); then the history's next
version takes over the rows of the keys the batch does not touch and works out
the others anew from the log, so a late change lands between its neighbours.

Of changes with one key and sequence the greatest (operation, values) counts.
Changes without a key or sequence are not applied. An upsert is valid up to the
key's next change; a delete only ends the row before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiergrain.operators.sliced import previous_in_order
from tiergrain.sources.sinks import publish_view, read_view
from tiergrain.streaming.refresh import read_stream

OPERATION, UPSERT, DELETE = "operation", "upsert", "delete"


BUCKETS = 1 << 14      # of key hashes, in which rows are counted


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))


def crowded(log: DataFrame, keys: Sequence[str], most: int) -> list[int]:
    """Buckets of more than ``most`` rows; a key with more lies in one of them. Counts are added up before the shuffle."""
    counts = log.groupBy(_bucket(keys).alias("bucket")).agg(F.count("*").alias("n"))
    return sorted(r.bucket for r in counts.where(F.col("n") > most).collect())      # at most BUCKETS


def history_of(log: DataFrame, keys: Sequence[str], sequence: str, columns: Sequence[str], width: int,
               apart: Sequence[int] = ()) -> DataFrame:
    """``keys``, ``columns``, ``valid_from``, ``valid_to`` (null: still valid).

    Keys of the buckets ``apart`` are worked out in slices of ``width``, so that no key's rows meet in
    one task. The others have few rows each and take one window, whose shuffle is that of a join on the keys below it.
    """
    known = log.where(" AND ".join(f"{c} IS NOT NULL" for c in (*keys, sequence)))
    few = known.where(~_bucket(keys).isin(list(apart))) if apart else known
    # the last row of a sequence is the greatest change, and what follows it is the next sequence
    along = Window.partitionBy(*keys).orderBy(sequence, F.struct(OPERATION, *columns))
    after = few.select(*keys, sequence, OPERATION, *columns, F.lead(sequence).over(along).alias("_next"))
    parts = [after.where(F.col("_next").isNull() | (F.col("_next") != F.col(sequence)))]
    if apart:
        one = known.where(_bucket(keys).isin(list(apart))).groupBy(*keys, sequence).agg(F.max(F.struct(OPERATION, *columns)).alias("c"))
        flat = one.select(*keys, sequence, "c.*")
        # the next change is the previous one in falling order
        parts.append(previous_in_order(flat, keys, -F.col(sequence).cast("long"), [], [sequence], width, prefix="_next_")
                     .withColumnRenamed(f"_next_{sequence}", "_next"))
    return reduce(DataFrame.unionByName, [p.where(F.col(OPERATION) == UPSERT).select(
        *keys, *columns, F.col(sequence).alias("valid_from"), F.col("_next").alias("valid_to")) for p in parts])


class ChangeTable:
    """A table kept by changes under ``base`` in the shared folder."""

    def __init__(self, spark: SparkSession, base: str, keys: Sequence[str], sequence: str, columns: Sequence[str],
                 schema: T.StructType, width: int = 1_000_000):
        self.spark, self.base = spark, base.rstrip("/")
        self.keys, self.sequence, self.columns = list(keys), sequence, list(columns)
        self.schema, self.width = schema, width

    def _log(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.base}/log/batch=*")

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Apply one batch; applying it again changes nothing."""
        folder = f"{self.base}/log/batch={batch_id}"
        batch.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(folder)
        touched = self.spark.read.schema(self.schema).parquet(folder).select(*self.keys).distinct()
        log = self._log()
        new = history_of(log.join(touched, self.keys, "left_semi"), self.keys, self.sequence, self.columns, self.width,
                         crowded(log, self.keys, self.width))
        try:
            new = self.history().join(touched, self.keys, "left_anti").unionByName(new)
        except FileNotFoundError:      # the first batch
            pass
        publish_view(new, f"{self.base}/history")

    def run(self, source_dir: str, max_files: int | None = None) -> None:
        """Apply what has arrived in a folder of changes since the last run."""
        query = (read_stream(self.spark, source_dir, self.schema, max_files).writeStream.foreachBatch(self.apply)
                 .option("checkpointLocation", f"{self.base}/_checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))

    def history(self) -> DataFrame:
        return read_view(self.spark, f"{self.base}/history")

    def current(self) -> DataFrame:
        return self.history().where("valid_to IS NULL").drop("valid_to")
