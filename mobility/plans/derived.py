"""Tables the registered queries derive from the supplied ones and keep.

The lake and the landing zone are written once per application and input version under the
session's shared checkpoint folder (``spark.checkpoint.dir``; our own folder
only when none is configured), then read like production tables. The folder
name carries a fingerprint of the input files, so changed inputs get a fresh
copy. A marker file is created only after the write has committed (dynamic
partition overwrite writes no ``_SUCCESS``), so a half-written copy left by a
lost job is simply written again.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import SparkSession

from mobility.session import shared_path
from mobility.sources.lake import path_exists, touch

DONE = "_MATERIALIZED"


def fingerprint(spark: SparkSession, sf_dir: str, tables: list[str]) -> str:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    h = hashlib.sha1(sf_dir.encode())
    for t in tables:
        p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        fs = p.getFileSystem(conf)
        if not fs.exists(p):
            continue
        for st in fs.listStatus(p) if fs.getFileStatus(p).isDirectory() else [fs.getFileStatus(p)]:
            h.update(f"{st.getPath().getName()}:{st.getLen()}:{st.getModificationTime()}".encode())
    return h.hexdigest()[:16]


def materialized(spark: SparkSession, name: str, sf_dir: str, tables: list[str],
                 build: Callable[[str], None]) -> str:
    path = shared_path(spark, "mobility-derived", f"{name}-{spark.sparkContext.applicationId}-{fingerprint(spark, sf_dir, tables)}")
    if not path_exists(spark, f"{path}/{DONE}"):
        build(path)
        touch(spark, f"{path}/{DONE}")
    return path
