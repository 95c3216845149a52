"""Spark session and shared-storage helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: The folder in use, by application.
_private: dict[str, str] = {}


def build_session(master: str | None = None, app: str = "staylens",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session with AQE on; used by tests, bench and the command line.

    On a cluster the launcher owns master, memory and shuffle sizing; this
    only fills what is unset.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               # checkpoint files of unreachable frames are removed by the cleaner
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables: ``spark.checkpoint.dir``.

    Where the session names none, a local session (one JVM) gets a private
    folder; on a cluster that is an error, since a machine-local folder is not
    visible to other executors.  The folder is registered once; the setting
    stays as the user made it.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None) or _private.get(spark.sparkContext.applicationId)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by the cluster")
        path = tempfile.mkdtemp(prefix="staylens-ckpt-")
    if spark.sparkContext.applicationId not in _private:
        spark.sparkContext.setCheckpointDir(path)
        _private[spark.sparkContext.applicationId] = path
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder."""
    base = shared_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read again.

    A lineage cut that a lost executor takes nothing of; its measured size lets
    Spark decide on broadcasts.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)
