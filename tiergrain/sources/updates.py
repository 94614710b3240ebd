"""Fail-the-update expectation: a refresh that commits whole or not at all.

``refresh_or_fail`` writes the next version of a view without its ``_SUCCESS`` mark,
counting rule violations in the same pass (``observe``). Readers
(``sinks.read_view``) take only marked versions, so the new one is invisible until the mark is
created, one atomic step on any file system. With a violation the mark
is never made: readers keep the version before, and the next attempt gets a
number of its own. ``append_or_fail`` does the same for a stream: each
micro-batch has its folder, a violating batch raises before its
mark, its offsets are not committed, and a rerun repeats that batch into the same folder.
"""

from __future__ import annotations

import dataclasses
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from tiergrain.operators.quality import RuleSet, metric_columns
from tiergrain.session import hadoop_path
from tiergrain.streaming.refresh import read_stream

_FOLDER = re.compile(r"(?:version|batch)=(\d+)")
_NO_MARK = ("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")


class ExpectationFailed(RuntimeError):
    """Rows broke a rule that must hold; nothing was committed."""

    def __init__(self, dataset: str, failed: dict[str, int]):
        super().__init__(f"{dataset}: " + ", ".join(f"{r} failed {n} times" for r, n in failed.items()))
        self.failed = failed


@dataclasses.dataclass(frozen=True)
class Attempt:
    committed: bool
    evaluated: int
    failed: dict[str, int]


def _folders(spark: SparkSession, base: str) -> dict[int, bool]:
    """Numbered folders under ``base`` and whether they are marked."""
    fs, where = hadoop_path(spark, base)
    if not fs.exists(where):
        return {}
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = {}
    for status in fs.listStatus(where):
        m = _FOLDER.fullmatch(status.getPath().getName())
        if m:
            found[int(m.group(1))] = fs.exists(path(status.getPath(), "_SUCCESS"))
    return found


def _mark(spark: SparkSession, folder: str) -> None:
    fs, where = hadoop_path(spark, f"{folder}/_SUCCESS")
    fs.create(where, True).close()


def _staged(df: DataFrame, folder: str, rules: RuleSet) -> Attempt:
    """Write ``df`` unmarked and count what breaks the rules, in one pass."""
    seen = Observation()
    df.observe(seen, *metric_columns(rules)).write.option(*_NO_MARK).mode("overwrite").parquet(folder)
    counts = {k: int(v or 0) for k, v in seen.get.items()}
    failed = {r: counts[r] for r in rules.names}
    return Attempt(not any(failed.values()), counts["_evaluated"], failed)


def refresh_or_fail(df: DataFrame, base: str, rules: RuleSet) -> Attempt:
    """Publish ``df`` as the view's next version if every row passes every rule."""
    spark = df.sparkSession
    folder = f"{base.rstrip('/')}/version={max(_folders(spark, base), default=0) + 1:08d}"
    done = _staged(df, folder, rules)
    if done.committed:
        _mark(spark, folder)
    return done


def append_or_fail(spark: SparkSession, source_dir: str, schema: T.StructType, sink: str, checkpoint: str, rules: RuleSet,
                   transform: Callable[[DataFrame], DataFrame] = lambda df: df, max_files: int | None = None) -> None:
    """One triggered refresh of an append-only table; ``ExpectationFailed`` if a batch breaks a rule."""
    broken: list[ExpectationFailed] = []

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        folder = f"{sink.rstrip('/')}/batch={batch_id}"
        done = _staged(transform(batch), folder, rules)
        if not done.committed:
            broken.append(ExpectationFailed(rules.dataset, {r: n for r, n in done.failed.items() if n}))
            raise broken[0]
        _mark(spark, folder)

    query = (read_stream(spark, source_dir, schema, max_files).writeStream.foreachBatch(per_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    try:
        query.awaitTermination()
    except Exception:
        if broken:
            raise broken[0] from None
        raise


def read_appended(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame:
    """Rows of the marked batches."""
    marked = [f"{sink.rstrip('/')}/batch={n}" for n, done in sorted(_folders(spark, sink).items()) if done]
    return spark.read.schema(schema).parquet(*marked) if marked else spark.createDataFrame([], schema)
