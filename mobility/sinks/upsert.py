"""Keyed upsert as a join, plus an append-only upsert log for streams.

Batch form (row 34): a full outer join of the stored table and the updates
on the key; per column, the update wins when present and the column is in
``update_cols``. Both sides are shuffled by the key once; with bucketed or
key-partitioned storage the target side needs no shuffle at all.

Stream form: each micro-batch's rows are written under ``batch_id=<n>``
(overwriting that folder, so a replayed batch is idempotent) and readers take
``max_by(row, batch_id)`` per key. Compaction folds the log into versioned
snapshots ``upto=<n>``; readers then read the newest snapshot plus the later
batches only, so the read cost stays bounded as the log grows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mobility.sources.lake import path_exists


def keyed_upsert(target: DataFrame, updates: DataFrame, keys: list[str],
                 update_cols: list[str] | None = None) -> DataFrame:
    """Insert new keys; for existing keys overwrite ``update_cols`` (default:
    every non-key column of ``updates``; empty list = insert-if-absent).
    Two update rows with the same key raise at run time."""
    if update_cols is None:
        update_cols = [c for c in updates.columns if c not in keys]
    columns = list(target.columns) + [c for c in updates.columns if c not in target.columns]
    per_key = Window.partitionBy(*keys)
    u = updates.select(
        *keys,
        *[F.col(c).alias(f"_u_{c}") for c in updates.columns if c not in keys],
        F.when(F.count(F.lit(1)).over(per_key) > 1,
               F.raise_error(F.lit("keyed_upsert: duplicate key in updates")))
         .otherwise(F.lit(True)).alias("_u_present"))
    t = target.select(*target.columns, F.lit(True).alias("_t_present"))
    j = t.join(u, keys, "full_outer")
    has_u = F.coalesce(F.col("_u_present"), F.lit(False))
    has_t = F.coalesce(F.col("_t_present"), F.lit(False))
    out = []
    for c in columns:
        if c in keys:
            out.append(F.col(c))
            continue
        mine = F.col(c) if c in target.columns else F.lit(None)
        theirs = F.col(f"_u_{c}") if c in updates.columns else F.lit(None)
        if c in update_cols:
            out.append(F.when(has_u, theirs).otherwise(mine).alias(c))
        else:
            out.append(F.when(has_t, mine).otherwise(theirs).alias(c))
    return j.select(*out)


def write_upsert_batch(batch: DataFrame, batch_id: int, log_path: str) -> None:
    """One micro-batch of an upsert stream, with its write time; replaying ``batch_id`` overwrites it."""
    batch.withColumn("updated_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{log_path.rstrip('/')}/batch_id={batch_id}")


def _latest(log: DataFrame, keys: list[str]) -> DataFrame:
    cols = [c for c in log.columns if c not in keys]
    newest = F.max_by(F.struct(*cols), F.col("batch_id"))
    return log.groupBy(*keys).agg(newest.alias("_r")).select(*keys, *[f"_r.{c}" for c in cols])


def _numbered_dirs(spark, root: str, prefix: str, committed: bool = False) -> list[int]:
    """Numbers N of ``<root>/<prefix>N`` folders (optionally only those with ``_SUCCESS``)."""
    if not path_exists(spark, root):
        return []
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix) and name[len(prefix):].isdigit():
            if not committed or fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                found.append(int(name[len(prefix):]))
    return sorted(found)


def _with_snapshot(spark, log_path: str, snapshot: str | None) -> DataFrame:
    log = spark.read.parquet(log_path)
    versions = _numbered_dirs(spark, snapshot, "upto=", committed=True) if snapshot else []
    if not versions:
        return log
    upto = versions[-1]
    snap = spark.read.parquet(f"{snapshot.rstrip('/')}/upto={upto}")
    return snap.unionByName(log.where(F.col("batch_id") > upto))


def read_upsert_log(spark, log_path: str, keys: list[str], snapshot: str | None = None,
                    rows: Column | None = None) -> DataFrame:
    """Current table from an upsert log: per key the row of the newest batch.
    ``rows``, a condition on the keys, leaves the others out before that.

    With snapshots written by :func:`compact_upsert_log`, the newest committed
    snapshot is read plus only the log batches after it (a partition filter
    on ``batch_id``)."""
    log = _with_snapshot(spark, log_path, snapshot)
    return _latest(log if rows is None else log.where(rows), keys).drop("batch_id")


def expire_upsert_log(spark, log_path: str, snapshot: str) -> list[int]:
    """Delete the log's batches that the newest committed snapshot holds, and
    older snapshots; returns the batches deleted."""
    versions = _numbered_dirs(spark, snapshot, "upto=", committed=True)
    if not versions:
        return []
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    old = [b for b in _numbered_dirs(spark, log_path, "batch_id=") if b < versions[-1]]  # the last one keeps the schema
    paths = [f"{log_path.rstrip('/')}/batch_id={b}" for b in old]
    paths += [f"{snapshot.rstrip('/')}/upto={v}" for v in versions[:-1]]
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return old


def compact_upsert_log(spark, log_path: str, keys: list[str], snapshot: str) -> int | None:
    """Fold the log into a new snapshot ``<snapshot>/upto=<N>``, N = the newest
    batch in the log; rows keep their ``batch_id``. Each snapshot is its own
    committed folder, so readers never see a half-written one, and log
    batches up to N (and older snapshots) may then be expired by retention.
    Returns N, or None when the log is empty."""
    batches = _numbered_dirs(spark, log_path, "batch_id=")
    if not batches:
        return None
    upto = batches[-1]
    state = _latest(_with_snapshot(spark, log_path, snapshot).where(F.col("batch_id") <= upto), keys)
    state.write.mode("overwrite").parquet(f"{snapshot.rstrip('/')}/upto={upto}")
    return upto
