"""Session helper and the shared folder used for written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of the library relies on. UTC keeps DATE(ts) stable,
# ANSI keeps silent overflow out, AQE re-plans joins and shuffle sizes at run
# time (broadcast conversion, partition coalescing, skew-join splitting).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # parquet written by the sinks keeps row-group statistics small and
    # useful for min/max skipping after a clustered write
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(
    master: str | None = None,
    app: str = "tiergrain",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` so that one partition stays well under executor
    memory at the target scale (AQE then coalesces small ones).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # runtime-settable SQL confs also apply when the session already existed
    for k, v in conf.items():
        if k.startswith("spark.sql.") and "catalogImplementation" not in k:
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an existing session
                pass
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session first. Only a local master without one (as in tests)
    gets a private folder; on a cluster a folder of the driver's own would be
    invisible to the executors, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):     # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tiergrain-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, *parts: str, fresh: bool = True) -> str:
    """A new folder under the shared checkpoint root for written tables.

    ``fresh`` appends a unique suffix, so a rerun never reads another run's
    files and nothing needs deleting in place.
    """
    root = checkpoint_root(spark)
    name = "/".join(p.strip("/") for p in ("tiergrain", *parts) if p)
    if fresh:
        name = f"{name}-{uuid.uuid4().hex[:12]}"
    path = f"{root.rstrip('/')}/{name}"
    fs, where = hadoop_path(spark, path)       # a path without a scheme belongs to the default file system
    fs.mkdirs(where)
    return path


def hadoop_path(spark: SparkSession, path: str):
    """Hadoop's file system of ``path`` and the path as it knows it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where
