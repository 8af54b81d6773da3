"""Serving reads over the result tables: newest rows, reports, alert lists.

Newest-per-key uses ``max_by`` (a map-side combined aggregate, no sort of the
table); top-k uses ``row_number() <= k``, which the optimizer turns into a
per-task group limit before the shuffle, so a day with many rows ships only
k of them per task.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mobility.schema import MONEY


def fleet_latest(fleet_metrics: DataFrame) -> DataFrame:
    """Row 37: the newest fleet window (no row if there is none)."""
    return fleet_metrics.orderBy(F.col("window_start").desc()).limit(1)


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    cols = [c for c in df.columns if c != key]
    newest = F.max_by(F.struct(*cols), F.col(order))
    return df.groupBy(key).agg(newest.alias("_n")).select(key, *[f"_n.{c}" for c in cols])


def zone_latest(zone_metrics: DataFrame) -> DataFrame:
    """Row 38: newest window row per zone (``DISTINCT ON (zone)``)."""
    return latest_per_key(zone_metrics, "zone", "window_start")


def latest_day(profit: DataFrame) -> F.Column:
    return profit.select(F.max("sim_day")).scalar()


def profit_report(profit: DataFrame, day: int | F.Column | None = None, unprofitable_only: bool = False) -> DataFrame:
    """Row 39: one day's rows (default: the newest day), profit ascending, nulls last."""
    target = latest_day(profit) if day is None else day if isinstance(day, F.Column) else F.lit(day)
    rows = profit.where(F.col("sim_day") == target)
    if unprofitable_only:
        rows = rows.where(F.col("unprofitable"))
    return rows.orderBy(F.col("profit").asc_nulls_last(), F.col("vehicle_id"))


def report_summary(profit: DataFrame) -> DataFrame:
    """Row 40a: per day, vehicles reporting, unprofitable vehicles, total earnings."""
    return profit.groupBy("sim_day").agg(
        F.count(F.lit(1)).alias("vehicles"),
        F.sum(F.col("unprofitable").cast("int")).cast("bigint").alias("unprofitable_vehicles"),
        F.coalesce(F.sum("earnings"), F.lit(0)).cast(MONEY).alias("total_earnings"),
    )


def top_unprofitable(profit: DataFrame, n: int = 10) -> DataFrame:
    """Row 40b: per day the ``n`` flagged vehicles with the lowest profit."""
    w = Window.partitionBy("sim_day").orderBy(F.col("profit").asc_nulls_last(), F.col("vehicle_id"))
    return (profit.where(F.col("unprofitable"))
            .withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= n))


def report_days(profit: DataFrame) -> DataFrame:
    """Row 41: days with a report, newest first."""
    return profit.select("sim_day").distinct().orderBy(F.col("sim_day").desc())


def recent_alerts(alerts: DataFrame, vehicle_id: str | None = None, limit: int = 50) -> DataFrame:
    """Row 42: newest alerts, optionally for one vehicle."""
    rows = alerts if vehicle_id is None else alerts.where(F.col("vehicle_id") == vehicle_id)
    return rows.orderBy(F.col("created_at").desc(), F.col("vehicle_id"), F.col("message")).limit(limit)
