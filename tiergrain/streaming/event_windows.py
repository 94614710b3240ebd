"""Event-time windows with a watermark; rows that come later than it go to a side table.

Structured Streaming's append-mode aggregate drops late rows without a trace. Here
every micro-batch is split by the watermark that the batches before it left (largest
event time so far less ``delay``), the rule Structured Streaming follows as well: a row whose window
ended at or before that watermark is late and is kept in ``late``; the others are
aggregated and merged with the windows still open. Windows ending at or before the
new watermark are closed, for good.

Everything a micro-batch writes lies in folders named by its id, its watermark last:
a repeated batch replaces its own results and reads the state of the batch before, and readers
see only batches whose watermark is written. State is one row per open window and key
in the shared folder, so neither a lost executor nor a new driver loses it.

Rows without an event time have no window and go to ``late`` with a null window.
A null key forms a group. Sliding windows put a row into several windows, and it may be
late for the earlier ones only. An empty batch changes nothing.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiergrain.session import hadoop_path
from tiergrain.streaming.refresh import read_stream

START, END, _MAX = "window_start", "window_end", "_watermark"


@dataclasses.dataclass(frozen=True)
class Measure:
    """A mergeable aggregate: of rows, and of the results of parts."""
    of_rows: Column
    merge: Callable[[str], Column]


def _from_micros(c: Column) -> Column:
    return F.timestamp_micros(c).cast("timestamp_ntz")


def window_starts(position: Column, width: int, slide: int) -> Column:
    """Starts of all windows of ``width`` that hold a position, one every ``slide``; null for a null."""
    last = position - F.pmod(position, F.lit(slide))
    before = ((F.lit(width - 1) - F.pmod(position, F.lit(slide))) / slide).cast("long")
    return F.when(position.isNotNull(), F.sequence(last - before * slide, last, F.lit(slide).cast("long")))


class EventWindows:
    """Windows over a folder of arriving rows; times in microseconds."""

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType, at: str, keys: Sequence[str],
                 measures: dict[str, Measure], width: int, delay: int, slide: int | None = None):
        if not 0 < (slide or width) <= width or delay < 0:
            raise ValueError("0 < slide <= width and delay >= 0")
        clash = {START, END} & {*schema.fieldNames(), *measures} | {*keys} & {*measures}
        if clash:
            raise ValueError(f"names used twice: {sorted(clash)}")
        self.spark, self.base, self.schema = spark, base.rstrip("/"), schema
        self.at, self.keys, self.measures = at, list(keys), measures
        self.width, self.slide, self.delay = width, slide or width, delay

    def _folder(self, kind: str, batch_id: int) -> str:
        return f"{self.base}/{kind}/batch={batch_id}"

    def _watermark(self, batch_id: int) -> int | None:
        if batch_id < 0:
            return None
        return self.spark.read.schema(f"{_MAX} bigint").parquet(self._folder("watermark", batch_id)).first()[0]

    def committed(self) -> int:
        """Id of the last batch whose watermark is written, -1 if there is none."""
        fs, where = hadoop_path(self.spark, f"{self.base}/watermark")
        if not fs.exists(where):
            return -1
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        done = [s.getPath() for s in fs.listStatus(where) if fs.exists(path(s.getPath(), "_SUCCESS"))]
        return max((int(p.getName().removeprefix("batch=")) for p in done), default=-1)

    def _windows(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(START, F.explode_outer(window_starts(self._position(), self.width, self.slide)))

    def _position(self) -> Column:
        return F.unix_micros(F.col(self.at).cast("timestamp"))

    def _aggregated(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(START, *self.keys).agg(*[m.of_rows.alias(n) for n, m in self.measures.items()])

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Take one micro-batch; taking it again changes nothing."""
        before = self._watermark(batch_id - 1)
        ended = F.lit(False) if before is None else F.col(START) + self.width <= before
        seen = Observation(f"event_windows_{batch_id}")
        watched = batch.observe(seen, F.max(self._position()).alias("latest"))
        late = self._windows(watched).where(F.col(START).isNull() | ended)
        late.write.mode("overwrite").parquet(self._folder("late", batch_id))
        latest = seen.get["latest"]
        now = max((w for w in (before, None if latest is None else latest - self.delay) if w is not None), default=None)

        on_time = self._aggregated(self._windows(batch).where(F.col(START).isNotNull() & ~ended))
        if batch_id > 0:
            still_open = self.spark.read.schema(on_time.schema).parquet(f"{self._folder('windows', batch_id - 1)}/closed=false")
            both = on_time.unionByName(still_open)
            on_time = both.groupBy(START, *self.keys).agg(*[m.merge(n).alias(n) for n, m in self.measures.items()])
        closed = F.lit(False) if now is None else F.col(START) + self.width <= now
        for state in (True, False):      # the folder of the open windows exists even without any
            part = on_time.where(closed if state else ~closed)
            part.write.mode("overwrite").parquet(f"{self._folder('windows', batch_id)}/closed={str(state).lower()}")
        self.spark.range(1, numPartitions=1).select(F.lit(now).cast("bigint").alias(_MAX)) \
            .write.mode("overwrite").parquet(self._folder("watermark", batch_id))
        fs, old = hadoop_path(self.spark, f"{self._folder('windows', batch_id - 2)}/closed=false")
        fs.delete(old, True)             # the batch before is needed for a repeat, earlier state is not

    def run(self, source_dir: str, max_files: int | None = None) -> None:
        """One triggered refresh: everything that has arrived since the last one."""
        query = (read_stream(self.spark, source_dir, self.schema, max_files).writeStream.foreachBatch(self.apply)
                 .option("checkpointLocation", f"{self.base}/_checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))

    def _read(self, rows: DataFrame, folders: list[str]) -> DataFrame:
        found = self.spark.read.schema(rows.schema).parquet(*folders) if folders else rows
        start = F.col(START)
        return found.withColumn(END, _from_micros(start + self.width)).withColumn(START, _from_micros(start))

    def _empty(self) -> DataFrame:
        return self._windows(self.spark.createDataFrame([], self.schema))

    def closed(self) -> DataFrame:
        """Closed windows: ``window_start``, keys, measures, ``window_end``; each once."""
        return self._read(self._aggregated(self._empty()),
                          [f"{self._folder('windows', b)}/closed=true" for b in range(self.committed() + 1)])

    def still_open(self) -> DataFrame:
        """Windows that may still take rows."""
        last = self.committed()
        return self._read(self._aggregated(self._empty()), [f"{self._folder('windows', last)}/closed=false"] if last >= 0 else [])

    def late(self) -> DataFrame:
        """Late rows whole, with the window they missed."""
        return self._read(self._empty(), [self._folder("late", b) for b in range(self.committed() + 1)])
