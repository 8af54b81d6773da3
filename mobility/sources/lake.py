"""The event lake: valid events as Parquet, one directory per simulated day."""
from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from mobility.schema import EVENT_SCHEMA, TS

# Lake rows: the business columns (event time as ``event_ts``), the message
# offset used as tie-break, and the partition column.
LAKE_SCHEMA = StructType(
    [StructField("event_id", LongType())]
    + [StructField(TS if f.name == "timestamp" else f.name, f.dataType)
       for f in EVENT_SCHEMA.fields if f.name != "_corrupt_record"]
    + [StructField("sim_day", IntegerType())])


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file (any Hadoop file system)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True).close()


def is_streamed(spark: SparkSession, root: str) -> bool:
    """Whether a streaming file sink owns the folder: readers then see only the
    files in its log."""
    return path_exists(spark, f"{root.rstrip('/')}/_spark_metadata")


def backfill_root(root: str) -> str:
    """Where batch writes into a streamed lake go."""
    return f"{root.rstrip('/')}_backfill"


def lake_scan(spark: SparkSession, root: str) -> DataFrame:
    """All archived events, backfilled ones included. Reading the root honours a streaming sink's
    ``_spark_metadata`` log, so files of uncommitted batches are skipped."""
    lake = spark.createDataFrame([], LAKE_SCHEMA)
    parts = [spark.read.schema(LAKE_SCHEMA).parquet(r) for r in (root, backfill_root(root)) if path_exists(spark, r)]
    return functools.reduce(DataFrame.unionByName, parts) if parts else lake


def lake_day_scan(spark: SparkSession, root: str, day: int) -> DataFrame:
    """Row 3: one day's events. The predicate is on the partition column, so
    the scan lists and reads only ``sim_day=<day>`` (``PartitionFilters``);
    a day with no directory gives an empty frame of the lake schema."""
    return lake_scan(spark, root).where(F.col("sim_day") == F.lit(day))
