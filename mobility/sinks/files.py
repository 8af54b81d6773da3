"""Batch sinks: the day-partitioned archive, dead letters and plain appends."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mobility.functions.clock import SimClock
from mobility.schema import TS
from mobility.sources.lake import backfill_root, is_streamed, path_exists


def with_day(valid: DataFrame, clock: SimClock) -> DataFrame:
    return valid if "sim_day" in valid.columns else valid.withColumn("sim_day", clock.day(TS))


def archive_by_day(valid: DataFrame, root: str, clock: SimClock) -> None:
    """Row 32 (batch form): write events under ``sim_day=<N>``. Dynamic
    partition overwrite replaces exactly the days present in ``valid``, so a
    re-run of a day is idempotent and other days are untouched.

    Rows are range-partitioned on (sim_day, event time) first: the bounds
    come from a sample, so tasks get equal row counts even when one day or
    one vehicle dominates, and each task covers a contiguous time slice
    (few day folders, few files). Hash-partitioning on sim_day alone would
    hand each whole day to a single task. Within a file rows are sorted by vehicle and carry a
    Bloom filter of its ids, so a read of one vehicle skips row groups.

    A root that a stream writes is left alone: readers of it would not see the new
    files, and replacing a day would delete files that its log still lists. The
    rows go to the backfill folder beside it, which ``lake_scan`` unites with it."""
    if is_streamed(valid.sparkSession, root):
        root = backfill_root(root)
    out = with_day(valid, clock)
    rows = out.repartitionByRange("sim_day", TS)
    if "vehicle_id" in out.columns:
        rows = rows.sortWithinPartitions("sim_day", "vehicle_id", TS)
    (rows.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("parquet.bloom.filter.enabled#vehicle_id", "true")
     .partitionBy("sim_day").parquet(root))


def write_dead_letters(dead: DataFrame, path: str) -> None:
    """Row 33 (batch form): append rejected payloads to a dead-letter table."""
    dead.write.mode("append").parquet(path)


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Row 35: plain append. A repeated call appends twice; see :func:`append_once`."""
    df.write.mode("append").format(fmt).save(path)


def append_once(df: DataFrame, path: str, token: str) -> None:
    """Row 35, safe to retry: rows are appended under a token of the caller's (a batch id, a
    day and its input's fingerprint). The token's folder is replaced as a whole and committed by the
    marker that the write leaves last, so a repeated or broken-off call never counts twice."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{_TOKEN}{token}")


def committed_tokens(spark: SparkSession, path: str) -> list[str]:
    """Tokens whose append has ended."""
    if not path_exists(spark, path):
        return []
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [(st.getPath().getName(), st.getPath()) for st in fs.listStatus(root) if st.isDirectory()]
    return sorted(n[len(_TOKEN):] for n, p in names if n.startswith(_TOKEN) and fs.exists(hadoop.Path(p, "_SUCCESS")))


def read_appended(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all committed appends (:func:`append_once`) and of plain ones beside them."""
    base = path.rstrip("/")
    plain = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "false")
    out = spark.createDataFrame([], schema)
    tokens = committed_tokens(spark, base)
    if tokens:
        out = out.unionByName(plain.parquet(*[f"{base}/{_TOKEN}{t}" for t in tokens]))
    if path_exists(spark, base) and _has_files(spark, base):
        out = out.unionByName(plain.parquet(f"{base}/*.parquet"))
    return out


def _has_files(spark: SparkSession, path: str) -> bool:
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return any(st.isFile() and st.getPath().getName().endswith(".parquet") for st in fs.listStatus(root))


_TOKEN = "token="
HEARTBEAT_SCHEMA = "component string, at timestamp, detail string"


def heartbeat(spark: SparkSession, path: str, component: str, detail: str, token: str | None = None) -> None:
    """One row saying that a component has just succeeded, once per token (by default one of its own)."""
    row = spark.range(1).select(
        F.lit(component).alias("component"), F.current_timestamp().alias("at"), F.lit(detail).alias("detail"))
    append_once(row, path, token or uuid.uuid4().hex)
