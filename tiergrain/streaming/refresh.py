"""Streaming tables (S3-S6, S9) with Structured Streaming.

* ``append_stream``: incremental, exactly-once append from a file source to
  the parquet file sink (its ``_spark_metadata`` log makes batch readers see
  only committed files). ``Trigger.AvailableNow`` processes what has
  arrived, in bounded micro-batches, and stops: the reference's triggered
  (non-continuous) refresh. A rerun with the same checkpoint adds nothing.
* ``enrich_stream``: stream-static star join inside ``foreachBatch``. The
  dimensions are re-read for every micro-batch, so a trade is enriched with
  the dimension as of its batch (point in time) and a replaced dimension
  never breaks the running query. Each batch overwrites its own
  ``batch=<id>`` folder, so a retried batch replaces rather than duplicates.
* ``full_refresh``: a new sink and a new checkpoint, so everything is
  reprocessed from the start.
* Rule metrics ride along with ``observe`` (file sink) or an ``Observation``
  per micro-batch (foreachBatch). Every micro-batch's counts are written to a
  file of its own, named by the batch id, next to the stream's checkpoint: a
  repeated batch replaces its file, and sums over the files are complete however
  many batches there were.
"""

from __future__ import annotations

import dataclasses
import json
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tiergrain.operators.quality import RuleSet, apply_rules, metric_columns
from tiergrain.session import hadoop_path, shared_dir


@dataclasses.dataclass
class StreamRun:
    sink: str
    checkpoint: str
    metrics: dict[str, int]
    batches: int


def _metrics_dir(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-metrics"


def _write_metrics(spark: SparkSession, checkpoint: str, batch_id: int, counts: dict[str, int]) -> None:
    """Counts of one micro-batch as a small JSON file (replaced if the batch is repeated)."""
    fs, where = hadoop_path(spark, f"{_metrics_dir(checkpoint)}/batch={batch_id}.json")
    out = fs.create(where, True)
    out.write(bytearray(json.dumps(counts).encode()))
    out.close()


def batch_metrics(spark: SparkSession, checkpoint: str) -> dict[str, int]:
    """Rule counts summed over all micro-batches a stream has ever run."""
    total: dict[str, int] = {}
    fs, where = hadoop_path(spark, _metrics_dir(checkpoint))
    if not fs.exists(where):
        return total
    rows = (spark.read.schema("value string").text(_metrics_dir(checkpoint))
            .select(F.explode(F.from_json("value", "map<string,bigint>")).alias("rule", "n"))
            .groupBy("rule").agg(F.sum("n").alias("n")))
    return {r.rule: r.n for r in rows.collect()}      # one row per rule


class _BatchCounts(StreamingQueryListener):
    """Writes the observed counts of every progress event of one query.

    Unlike ``recentProgress``, which keeps the last hundred, a listener sees
    every micro-batch.
    """

    def __init__(self, spark: SparkSession, checkpoint: str, name: str | None):
        self.spark, self.checkpoint, self.name = spark, checkpoint, name
        self.run_id: str | None = None
        self.early: list = []
        self.batches = 0
        self.totals: dict[str, int] = {}
        self.ended: set[str] = set()
        self.end = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self.end:
            if self.run_id is None:
                self.early.append(p)
                return
        self._take(p)

    def _take(self, p) -> None:
        if str(p.runId) != self.run_id or not p.numInputRows:
            return
        self.batches += 1
        observed = dict(p.observedMetrics or {}).get(self.name)
        if observed is not None:
            counts = {k: int(v or 0) for k, v in observed.asDict().items()}
            _write_metrics(self.spark, self.checkpoint, p.batchId, counts)
            for k, v in counts.items():
                self.totals[k] = self.totals.get(k, 0) + v

    def follow(self, run_id: str) -> None:
        with self.end:
            self.run_id, early = run_id, self.early
        for p in early:
            self._take(p)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.end:
            self.ended.add(str(event.runId))
            self.end.notify_all()

    def wait(self, seconds: float = 120.0) -> None:
        """Until the end event, which comes after all progress events, has arrived."""
        with self.end:
            if not self.end.wait_for(lambda: self.run_id in self.ended, seconds):
                raise RuntimeError("the end of the streaming query was not reported; rule metrics may be incomplete")


def read_stream(spark: SparkSession, source_dir: str, schema: T.StructType, max_files: int | None = None,
                max_bytes: int | None = None) -> DataFrame:
    """Append-only scan of a parquet folder (raw table or upstream sink).

    A micro-batch takes at most ``max_files`` files or, as whole files, ``max_bytes`` (one file at
    least); with neither, all that has arrived.
    """
    r = spark.readStream.schema(schema).format("parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    elif max_bytes:
        r = r.option("maxBytesPerTrigger", str(max_bytes))
    return r.load(source_dir)


def batch_bytes(spark: SparkSession, source_dir: str, least: int, most_batches: int) -> int:
    """Bytes of a micro-batch: ``least``, or what cuts all files under ``source_dir`` into ``most_batches``.

    Every micro-batch has a fixed cost (planning, logs, commits), so their number must not grow with
    the input. Tasks read splits of files, so a larger micro-batch has more tasks, not larger ones.
    """
    fs, where = hadoop_path(spark, source_dir)
    return max(least, -(-fs.getContentSummary(where).getLength() // most_batches))


def append_stream(spark: SparkSession, source_dir: str, schema: T.StructType, sink: str, checkpoint: str,
                  transform: Callable[[DataFrame], DataFrame] | None = None, ruleset: RuleSet | None = None,
                  max_files: int | None = None, max_bytes: int | None = None) -> StreamRun:
    """Run one triggered refresh of a streaming table into ``sink``.

    ``transform`` maps the source stream to the table's rows (projection,
    derived columns); ``ruleset`` is applied on those rows (warn keeps them,
    drop removes violators) and its counts are observed per micro-batch.
    """
    df = read_stream(spark, source_dir, schema, max_files, max_bytes)
    if transform is not None:
        df = transform(df)
    name = f"rules_{ruleset.dataset}" if ruleset else None
    if ruleset is not None:
        df = df.observe(name, *metric_columns(ruleset))
        if ruleset.mode != "warn":
            df = df.filter(ruleset.all_pass())
    counts = _BatchCounts(spark, checkpoint, name)
    spark.streams.addListener(counts)
    try:
        q = (df.writeStream.format("parquet")
             .option("checkpointLocation", checkpoint)
             .outputMode("append")
             .trigger(availableNow=True)
             .start(sink))
        counts.follow(str(q.runId))
        q.awaitTermination()
        counts.wait()
    finally:
        spark.streams.removeListener(counts)
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return StreamRun(sink, checkpoint, counts.totals, counts.batches)


def enrich_stream(spark: SparkSession, source_dir: str, schema: T.StructType, sink: str, checkpoint: str,
                  enrich: Callable[[DataFrame], DataFrame], ruleset: RuleSet,
                  max_files: int | None = None, max_bytes: int | None = None) -> StreamRun:
    """J1 streaming: ``enrich(batch)`` builds the unfiltered output rows of a
    micro-batch (re-reading the dimensions); the drop rules run on them."""
    metrics: dict[str, int] = {}
    seen = {"batches": 0}

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        obs = Observation(f"rules_{ruleset.dataset}_{batch_id}")
        out = apply_rules(enrich(batch), ruleset, obs)
        out.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
        counts = {k: int(v or 0) for k, v in obs.get.items()}
        _write_metrics(spark, checkpoint, batch_id, counts)
        for k, v in counts.items():
            metrics[k] = metrics.get(k, 0) + v
        seen["batches"] += 1

    q = (read_stream(spark, source_dir, schema, max_files, max_bytes).writeStream
         .foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return StreamRun(sink, checkpoint, metrics, seen["batches"])


def read_enriched(spark: SparkSession, sink: str, schema: T.StructType | None = None) -> DataFrame:
    """Batch read of a ``foreachBatch`` sink (S5), without the batch column."""
    df = spark.read.parquet(sink)
    return df.drop("batch") if "batch" in df.columns else df


def full_refresh(spark: SparkSession, table: str) -> tuple[str, str]:
    """A fresh (sink, checkpoint) pair; nothing is deleted in place."""
    base = shared_dir(spark, "streams", table)
    return f"{base}/data", f"{base}/_checkpoint"


def stage_arrivals(df: DataFrame, target: str, rows_per_file: int, arrivals: int = 1,
                   split_col: str | None = None) -> None:
    """Land a batch DataFrame in ``target`` as one or more appends of files.

    Files are cut after ``rows_per_file`` rows where they are written: no
    shuffle, and as many tasks as the frame has partitions. With ``arrivals > 1``
    the rows are split deterministically by ``pmod(hash(split_col), arrivals)``,
    each part appended as its own set of files: the file source sees them as
    successive arrivals.
    """
    part = F.pmod(F.xxhash64(F.col(split_col)), F.lit(arrivals)) if arrivals > 1 else F.lit(0)
    for i in range(max(1, arrivals)):
        (df.filter(part == i) if arrivals > 1 else df).write.mode("append") \
            .option("maxRecordsPerFile", rows_per_file).parquet(target)
