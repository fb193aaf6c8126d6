"""Session settings and durable intermediate storage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(app: str = "wattloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library assumes; `conf` adds or overrides.

    Shuffle partitions are left to the cluster: AQE coalesces small ones and
    splits skewed ones, so a deployment only sets an upper bound.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and intermediate tables.

    Taken from `spark.checkpoint.dir`. Only a local master may fall back to a
    temporary folder, since there the driver and the executors share one disk.
    """
    named = spark.conf.get(_CHECKPOINT_CONF, None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_CONF} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="wattloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so that lost executors cannot
    change row placement that later steps rely on."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
