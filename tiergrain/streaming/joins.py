"""Stream-stream joins within time bounds (inner, or outer on the left).

Both sides have a watermark, and a match must lie between ``lower`` and ``upper``
after the left row's time, so state on either side is bounded: a row goes once
the watermark has passed every time it could match. An unmatched left
row comes out with nulls at that moment. As long as no row arrives later than its side's delay, the
result does not depend on the order of arrival and equals the batch join, but for
the unmatched left rows that the watermark has not yet passed.

Null keys and null times match nothing; a left row with a null time never expires and so
never comes out of an outer join: send such rows elsewhere first.

State is parquet in the shared folder, not a state store in the executors' memory. A
micro-batch adds its rows to it as a folder per side, and one batch join of the rows that
still count gives the pairs with a row of this batch and the left rows that expire without
a match. An outer join keeps a right row until every left row that it could match has
expired, so whether a left row has a match is seen when it expires, without a flag to
rewrite. The rows and the moment that they come out are those of Spark's own join:
the watermark is the smaller of the sides' latest times less their delays, moves only in a refresh that
has rows of both, drops what is late one micro-batch after it lets state out, and a refresh ends with a step that only expires.

Everything a step writes lies in folders named by its number, its marks last: a repeated
batch replaces its own results, and readers see only steps whose marks are written.
"""

from __future__ import annotations

import dataclasses
import datetime
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiergrain.session import hadoop_path
from tiergrain.streaming.refresh import read_stream

_STEPS = ("left_step", "right_step")


@dataclasses.dataclass(frozen=True)
class Side:
    """A folder of arriving rows, its event time and the longest delay of an arrival."""
    folder: str
    schema: T.StructType
    at: str
    delay: str

    def stream(self, spark: SparkSession, max_files: int | None) -> DataFrame:
        rows = read_stream(spark, self.folder, self.schema, max_files)
        return rows.withColumn(self.at, F.col(self.at).cast("timestamp"))


def bounded(left: DataFrame, right: DataFrame, left_at: str, right_at: str, keys: Sequence[tuple[str, str]],
            lower: str, upper: str, how: str) -> DataFrame:
    """The join itself, the same for streams and batches. ``lower`` and ``upper`` are intervals, both included."""
    both = set(left.columns) & set(right.columns)
    if both or how not in ("inner", "left_outer"):
        raise ValueError(f"names on both sides: {sorted(both)}" if both else f"no such join here: {how}")
    matches = F.col(right_at).between(F.col(left_at) + F.expr(f"INTERVAL {lower}"), F.col(left_at) + F.expr(f"INTERVAL {upper}"))
    for a, b in keys:
        matches = (F.col(a) == F.col(b)) & matches
    return left.join(right, matches, how)


@dataclasses.dataclass
class _Marks:
    """What a step leaves to the next: the watermark it expired by, the one to expire by next, and
    per side the steps whose rows still count with their latest time (milliseconds)."""
    used: int
    next: int
    latest: tuple[dict[int, int], dict[int, int]]


def _committed(spark: SparkSession, sink: str) -> list[int]:
    """Numbers of the steps whose marks are written."""
    fs, where = hadoop_path(spark, f"{sink}/_marks")
    if not fs.exists(where):
        return []
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    done = [s.getPath() for s in fs.listStatus(where) if fs.exists(path(s.getPath(), "_SUCCESS"))]
    return sorted(int(p.getName().removeprefix("step=")) for p in done)


def _delay(spark: SparkSession, span: str) -> int:
    """Milliseconds of a delay; a month has 31 days, as in ``withWatermark``."""
    units = {"YEARS": 12 * 31 * 86_400_000, "MONTHS": 31 * 86_400_000, "DAYS": 86_400_000, "HOURS": 3_600_000, "MINUTES": 60_000,
             "SECONDS": 1000}
    found = spark.sql("SELECT " + ", ".join(f"extract({u} FROM i)" for u in units) + " FROM (SELECT CAST(:span AS INTERVAL) AS i)",
                      args={"span": span}).first()
    delay = None if None in found else int(sum(n * ms for n, ms in zip(found, units.values())))
    if delay is None or delay < 0:
        raise ValueError(f"not a delay: {span}")
    return delay


def _span(spark: SparkSession, interval: str) -> int:
    """Microseconds of a day-time interval; months have no fixed length, so no state could be bounded by them."""
    found = spark.sql(f"SELECT INTERVAL {interval}")
    if not isinstance(found.schema[0].dataType, T.DayTimeIntervalType):
        raise ValueError(f"not an interval of days or less: {interval}")
    return found.first()[0] // datetime.timedelta(microseconds=1)


class _Join:
    """One refresh. Data batch ``n`` is step ``2n``; what only expires after it is step ``2n + 1``."""

    def __init__(self, spark: SparkSession, sides: tuple[Side, Side], keys: Sequence[tuple[str, str]], lower: str, upper: str,
                 sink: str, checkpoint: str, how: str):
        self.spark, self.sides, self.keys, self.lower, self.upper = spark, sides, list(keys), lower, upper
        self.sink, self.state, self.how = sink.rstrip("/"), f"{checkpoint.rstrip('/')}-state", how
        self.delays = [_delay(spark, s.delay) for s in sides]
        self.spans = _span(spark, lower), _span(spark, upper)
        self.latest: list[int | None] = [None, None]         # of this refresh

    def _folder(self, side: int, step: int) -> str:
        return f"{self.state}/{_STEPS[side]}={step}"

    def _schema(self, side: int) -> T.StructType:
        at = self.sides[side].at
        return T.StructType([T.StructField(f.name, T.TimestampType() if f.name == at else f.dataType) for f in self.sides[side].schema])

    def marks(self, before: int | None = None) -> tuple[int, _Marks]:
        """The last step, or the last one before another, and its marks."""
        done = [s for s in _committed(self.spark, self.sink) if before is None or s < before]
        if not done:
            return -1, _Marks(0, 0, ({}, {}))
        found = json.loads(self.spark.read.text(f"{self.sink}/_marks/step={done[-1]}").first()[0])
        left, right = ({int(s): at for s, at in side.items()} for side in found["latest"])
        return done[-1], _Marks(found["used"], found["next"], (left, right))

    def _gone(self, side: int, mark: int) -> int:
        """Rows up to this time (milliseconds) cannot match, nor still expire, once the watermark has passed ``mark``."""
        lower, upper = self.spans
        left = (mark * 1000 - upper) // 1000 - 1
        if side == 0:
            return left
        right = mark + lower // 1000                       # for left rows still to come
        return right if self.how == "inner" else min(right, left + lower // 1000)

    def _after(self, side: int, mark: int) -> Column:
        return F.col(self.sides[side].at) > F.timestamp_millis(F.lit(mark))

    def _rows(self, side: int, marks: _Marks, step: int) -> DataFrame:
        """The rows of earlier steps that still count, and all of this one's: one may expire as it arrives."""
        schema = T.StructType([*self._schema(side), T.StructField(_STEPS[side], T.IntegerType())])
        folders = [self._folder(side, s) for s in sorted(marks.latest[side])]
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", self.state).parquet(*folders)
        return rows.where(self._after(side, self._gone(side, marks.used)) | (F.col(_STEPS[side]) == step))

    def _take(self, side: int, rows: DataFrame, step: int, late: int) -> dict[int, int]:
        """Writes the rows of a batch that are not late; their latest time, if there are any."""
        at, folder = F.col(self.sides[side].at), self._folder(side, step)
        rows.where(self._after(side, late)).write.mode("overwrite").parquet(folder)
        latest = self.spark.read.schema(self._schema(side)).parquet(folder).agg(F.max(F.unix_millis(at))).first()[0]
        if latest is None:
            return {}
        self.latest[side] = max(latest, self.latest[side] or latest)
        return {step: latest}

    def _write(self, step: int, marks: _Marks, watermark: int) -> None:
        """Joins the rows that count after ``marks``, expires by ``marks.next`` and commits the step."""
        left, right = (self._rows(side, marks, step) for side in (0, 1))
        gone = [self._gone(side, marks.next) for side in (0, 1)]
        expires = ~self._after(0, gone[0])
        if not any(step in own for own in marks.latest):     # nothing new: only what expires, and its matches
            left, right = left.where(expires), right.where(~self._after(1, gone[0] + -(-self.spans[1] // 1000)))
        rows = bounded(left, right, self.sides[0].at, self.sides[1].at, self.keys, self.lower, self.upper, self.how)
        own_left, own_right = (F.col(c) == step for c in _STEPS)
        wanted = F.col("right_step").isNotNull() & (own_left | own_right)
        if self.how == "left_outer":
            wanted = wanted | (F.col("right_step").isNull() & expires)
        rows.where(wanted).drop(*_STEPS).write.mode("overwrite").parquet(f"{self.sink}/step={step}")

        live = [{s: at for s, at in own.items() if at >= least} for own, least in zip(marks.latest, gone)]
        text = json.dumps({"used": marks.next, "next": watermark, "latest": live})
        self.spark.range(1, numPartitions=1).select(F.lit(text).alias("value")) \
            .write.mode("overwrite").text(f"{self.sink}/_marks/step={step}")
        fs, where = hadoop_path(self.spark, self.state)
        for s in fs.listStatus(where) if fs.exists(where) else []:
            name, _, number = s.getPath().getName().partition("=")
            if int(number) not in marks.latest[_STEPS.index(name)] and int(number) < step:
                fs.delete(s.getPath(), True)             # a repeat of this step needs what it has read, nothing older

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Takes one micro-batch of both sides; taking it again changes nothing."""
        step = 2 * batch_id
        _, marks = self.marks(step)
        for side, name in enumerate(("l", "r")):
            rows = batch.where(F.col(name).isNotNull()).select(f"{name}.*")
            marks.latest[side].update(self._take(side, rows, step, marks.used))
        times = [0 if at is None else at - delay for at, delay in zip(self.latest, self.delays)]
        self._write(step, marks, max(marks.next, min(times)))

    def expire(self) -> None:
        """After the last batch of a refresh: what its watermark lets out."""
        step, marks = self.marks()
        if marks.next > marks.used:
            self._write(step + 1, marks, marks.next)


def join_streams(spark: SparkSession, left: Side, right: Side, keys: Sequence[tuple[str, str]], lower: str, upper: str,
                 sink: str, checkpoint: str, how: str = "left_outer", max_files: int | None = None) -> None:
    """One triggered refresh: joins what has arrived on either side since the last one."""
    bounded(*(spark.createDataFrame([], s.schema) for s in (left, right)), left.at, right.at, keys, lower, upper, how)
    clash = {*_STEPS} & {*left.schema.fieldNames(), *right.schema.fieldNames()}
    if clash:
        raise ValueError(f"names that the join's state has: {sorted(clash)}")
    join = _Join(spark, (left, right), keys, lower, upper, sink, checkpoint, how)
    rows = [F.struct("*").alias(n) for n in ("l", "r")]
    streams = [s.stream(spark, max_files).select(row) for s, row in zip((left, right), rows)]
    both = streams[0].unionByName(streams[1], allowMissingColumns=True)
    query = (both.writeStream.foreachBatch(join.apply).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    join.expire()


def read_joined(spark: SparkSession, sink: str) -> DataFrame:
    """Rows of the committed steps."""
    return spark.read.parquet(*[f"{sink.rstrip('/')}/step={s}" for s in _committed(spark, sink.rstrip("/"))])
