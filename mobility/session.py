"""Spark session settings shared by jobs, tests and the bench.

Everything is UTC (the reference pins the session time zone too) and AQE is on,
so shuffle width adapts to the data actually produced. ``spark.sql.shuffle.partitions``,
the upper bound that AQE coalesces down from, is left to the cluster's setting.
"""
from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast on a planner estimate: a side is broadcast only when AQE has
    # measured it below the threshold at run time (or, for tables with a fixed
    # bound such as the zone dimension, by an explicit hint).
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Checkpoint files of DataFrames that are gone are removed, not left behind.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
    # RocksDB keeps keyed streaming state off the JVM heap, which matters once
    # the vehicle-state and window stores hold millions of keys.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app: str = "mobility",
                  shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and derived tables.

    On a cluster this is ``spark.checkpoint.dir`` as the deployment sets it; we
    only choose one ourselves when it is unset and the master is local (tests):
    a folder of one machine is no shared folder.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="mobility-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([shared_root(spark), *parts])
