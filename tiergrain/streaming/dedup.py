"""Streaming dedup: keys seen within a watermark are dropped, duplicates counted per batch.

State holds a key until the watermark (largest event time less ``delay``) has passed its
time plus ``delay``, so it is bounded by the rows of that span. A repeat that
arrives later than the delay is a new row, as in any bounded dedup. The input rows of
every micro-batch are counted beside the checkpoint (replaced if the batch is
repeated); less the sink's rows, they are the duplicates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiergrain.streaming.refresh import _BatchCounts, batch_metrics, read_stream


def dedup_stream(spark: SparkSession, source_dir: str, schema: T.StructType, sink: str, checkpoint: str,
                 keys: Sequence[str], at: str, delay: str, max_files: int | None = None) -> int:
    """One triggered refresh; returns the duplicates dropped over all refreshes so far."""
    rows = read_stream(spark, source_dir, schema, max_files).observe("dedup_input", F.count(F.lit(1)).alias("rows"))
    timed = rows.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)
    counts = _BatchCounts(spark, checkpoint, "dedup_input")
    spark.streams.addListener(counts)
    try:
        query = (timed.dropDuplicatesWithinWatermark(list(keys)).writeStream.format("parquet")
                 .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(sink))
        counts.follow(str(query.runId))
        query.awaitTermination()
        counts.wait()
    finally:
        spark.streams.removeListener(counts)
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return batch_metrics(spark, checkpoint).get("rows", 0) - read_deduplicated(spark, sink).count()


def read_deduplicated(spark: SparkSession, sink: str) -> DataFrame:
    """Committed rows of the sink."""
    return spark.read.parquet(sink)
