"""Spark session helpers.

The library never creates a session behind the caller's back; these helpers
are for scripts, tests and the bench.  Cluster jobs pass their own session.
"""

from __future__ import annotations

import os
import tempfile
import threading

from pyspark.sql import SparkSession

# Settings the operators are designed around: AQE re-plans joins (a side that
# turns out small at runtime becomes a broadcast, hot partitions are split),
# ANSI arithmetic stays on (operators guard divisions), UTC session zone.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "aulastar", conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared file system)
    and its absence is an error; only in local mode (tests) a scratch folder
    is created when it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a shared folder "
                           "(intermediate tables and checkpoints must survive the loss of any machine)")
    local = tempfile.mkdtemp(prefix="aulastar-ckpt-", dir=os.environ.get("AULASTAR_SCRATCH", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared folder named by ``spark.checkpoint.dir`` (for
    intermediate tables); falls back to the session's checkpoint folder when
    the setting is absent (tests)."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return "/".join([root.rstrip("/"), *parts])


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system of ``path`` delete it when the session's JVM ends
    (stored intermediate tables are worth nothing to a later session)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, through the Hadoop FileSystem of the path's
    scheme (works for local, HDFS and object-store paths alike)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


# Serialises "build once, then read" steps (stored intermediate tables) when
# several threads of one driver ask for the same table at the same time.
BUILD_LOCK = threading.RLock()
