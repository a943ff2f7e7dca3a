"""SparkSession construction with settings that suit the corpus operators.

The settings are only *defaults*: a cluster-provided value always wins, so the
same code runs under spark-submit with the cluster's own configuration.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults applied only where the session (or spark-submit) has not set a value.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "docweave",
              shuffle_partitions: int | None = None, driver_memory: str | None = None) -> SparkSession:
    """``driver_memory`` only takes effect when this call launches the JVM
    (local runs); under spark-submit the cluster's setting stands."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared filesystem path set by the cluster
    configuration; a folder of our own is made only for ``local[...]``
    sessions that set none (tests), where driver and executors are one process.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="docweave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table below the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), name)


def stored(df: DataFrame) -> DataFrame:
    """The rows written once below the checkpoint folder, as compressed columns, and read from there."""
    path = scratch_path(df.sparkSession, f"stored-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
