"""Ordered per-key scans (running count, previous value) as an associative fold, balanced
when one key - or one instant of one key - holds a large share of the rows.

A plain ``Window.partitionBy(key).orderBy(ts, id)`` sends every row of a key to
one task. Here a key's rows fall into buckets that follow each other in order, one a day; a
built-in window runs per (key, bucket), a bucket is summed up in one row (its count, its
last value), and what the earlier buckets of a key hold is a prefix scan over these summaries,
carried in by a join on the bucket, which the windows have already partitioned by.

A day of a key with more than ``quota`` rows is cut by second, a second of more than
``quota`` rows by instant and ranges of ``quota`` ids, which hold at most that many rows as ids
are unique. One count by (key, day) finds these days; the rows of none but them are
counted by second. The list of cut days is broadcast: it holds at most rows / ``quota`` entries and
as many seconds (10**12 rows, about 100 TB of telemetry: a million of each, under 64 MB), and a join that
shuffled the rows to it would bring a cut day together again.

Everything is a function of the data: no sampling, so a recomputed task cuts the
same buckets, and nothing runs or is stored while a plan is built. All joins are left joins on unique
keys, so the optimizer removes the whole scan from a query that doesn't read its result.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mobility.functions.clock import floor_div, micros

#: Rows of a day, second or instant of a key that one task orders.
QUOTA = 1_000_000
DAY_US = 86_400_000_000
SECOND_US = 1_000_000

_BUCKET = ["_slot", "_instant", "_range"]
_UNCUT = -(1 << 62)


def _large(rows: DataFrame, keys: list[str], quota: int, mark: str) -> DataFrame:
    """The values of ``keys`` with more than ``quota`` rows, marked."""
    return (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > quota)
            .select(*keys, F.lit(True).alias(mark)))


def with_buckets(df: DataFrame, key: str, order: list[str], quota: int = QUOTA) -> DataFrame:
    """``df`` (rows with a key) with its bucket columns: the day, or the second of a cut day, then
    the instant and the range of ids of a cut second (``_UNCUT`` where there is no cut)."""
    ts, tiebreak = order
    rows = df.where(F.col(key).isNotNull())
    dated = rows.withColumn("_t", micros(ts)).withColumn("_d", floor_div(F.col("_t"), DAY_US))
    narrow = dated.select(key, "_d", floor_div(F.col("_t"), SECOND_US).alias("_s"))
    large_day = F.broadcast(_large(narrow, [key, "_d"], quota, "_kd"))
    # Few days are large, most often none: their rows alone are counted by second.
    large_second = _large(narrow.join(large_day, [key, "_d"]), [key, "_d", "_s"], quota, "_ks")
    seconds = large_second.groupBy(key, "_d").agg(F.collect_set("_s").alias("_seconds"))
    marked = dated.join(large_day, [key, "_d"], "left").join(F.broadcast(seconds), [key, "_d"], "left")
    second = floor_div(F.col("_t"), SECOND_US)
    hot = F.coalesce(F.array_contains("_seconds", second), F.lit(False))

    def cut(condition: Column, value: Column) -> Column:
        return F.when(condition, value).otherwise(F.lit(_UNCUT)).cast("long")

    return marked.select(
        *df.columns, F.when(F.col("_kd"), second).otherwise(F.col("_d") * (DAY_US // SECOND_US)).alias("_slot"),
        cut(hot, F.col("_t")).alias("_instant"), cut(hot, floor_div(F.col(tiebreak), quota)).alias("_range"))


def _bucket_order(key: str, order: list[str]):
    return Window.partitionBy(key, *_BUCKET).orderBy(*order)


def running_count(df: DataFrame, key: str, order: list[str], flag: str, out: str,
                  inclusive: bool = True, quota: int = QUOTA) -> DataFrame:
    """Per-key running sum of a 0/1 ``flag`` in ``order`` (time, unique id).
    Rows with a NULL key are dropped."""
    rows = with_buckets(df, key, order, quota)
    local = rows.withColumn("_local", F.sum(flag).over(
        _bucket_order(key, order).rowsBetween(Window.unboundedPreceding, 0)))
    totals = rows.groupBy(key, *_BUCKET).agg(F.sum(flag).alias("_total"))
    earlier = Window.partitionBy(key).orderBy(*_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(key, *_BUCKET, F.sum("_total").over(earlier).alias("_carry"))
    value = F.col("_local") + F.coalesce(F.col("_carry"), F.lit(0))
    if not inclusive:
        value = value - F.col(flag)
    return (local.join(carry, [key, *_BUCKET], "left")
            .select(*df.columns, value.cast("bigint").alias(out)))


def previous_value(df: DataFrame, key: str, order: list[str], value: str, out: str,
                   quota: int = QUOTA) -> DataFrame:
    """``lag(value)`` per key in ``order`` (NULL on a key's first row)."""
    rows = with_buckets(df, key, order, quota)
    in_order = _bucket_order(key, order)
    local = (rows.withColumn("_lag", F.lag(value).over(in_order))
             .withColumn("_first", F.row_number().over(in_order) == 1))
    lasts = rows.groupBy(key, *_BUCKET).agg(F.max_by(value, F.struct(*order)).alias("_last"))
    before = Window.partitionBy(key).orderBy(*_BUCKET)
    carry = lasts.select(key, *_BUCKET, F.lag("_last").over(before).alias("_carry"))
    return (local.join(carry, [key, *_BUCKET], "left")
            .select(*df.columns, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_lag")).alias(out)))
