"""Audits re-aimed from the telemetry simulator: fare against distance, and
the status lifecycle idle -> enroute -> on_trip -> idle."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mobility.operators.dims import BASE_FARE, RATE_PER_KM
from mobility.operators.scan import QUOTA, previous_value
from mobility.schema import TS

# Allowed lifecycle steps (fixed by the simulator's state machine).
LIFECYCLE = [("idle", "enroute"), ("enroute", "on_trip"), ("on_trip", "idle")]


def trip_fare_audit(events: DataFrame, interval_seconds: float = 3.0) -> DataFrame:
    """Row 46: per trip, distance = sum(speed km/h x interval) over on_trip
    events, expected fare = base + rate x km, and the settled fare of the
    completion event. Speeds are summed as decimal(10,1), so the sum is exact."""
    trips = events.where(F.col("trip_id").isNotNull())
    on_trip = F.col("status") == "on_trip"
    agg = trips.groupBy("trip_id", "vehicle_id").agg(
        F.sum(F.when(on_trip, F.col("speed").cast("decimal(10,1)"))).alias("_speed"),
        F.sum(on_trip.cast("int")).cast("bigint").alias("on_trip_events"),
        F.max(F.when(F.col("trip_completed"), F.col("fare"))).alias("settled_fare"),
    )
    km = F.coalesce(F.col("_speed"), F.lit(0).cast("decimal(10,1)")).cast("double") * F.lit(interval_seconds / 3600.0)
    expected = F.lit(BASE_FARE) + F.lit(RATE_PER_KM) * km
    return agg.select(
        "trip_id", "vehicle_id", "on_trip_events",
        km.alias("distance_km"), expected.alias("expected_fare"), "settled_fare",
        (F.col("settled_fare") - expected).alias("fare_gap"),
    )


def status_transitions(events: DataFrame, spark: SparkSession, tiebreak: str = "event_id",
                       quota: int = QUOTA) -> DataFrame:
    """Row 47: count each status change per (from, to) and flag the ones the
    lifecycle does not allow."""
    ev = events.where(F.col("vehicle_id").isNotNull()).select("vehicle_id", "status", TS, tiebreak)
    ev = previous_value(ev, "vehicle_id", [TS, tiebreak], "status", "from_status", quota=quota)
    changes = (ev.where(F.col("from_status").isNotNull() & (F.col("from_status") != F.col("status")))
               .groupBy("from_status", F.col("status").alias("to_status"))
               .agg(F.count(F.lit(1)).alias("transitions")))
    allowed = F.broadcast(spark.createDataFrame(LIFECYCLE, "from_status string, to_status string")
                          .withColumn("allowed", F.lit(True)))
    return (changes.join(allowed, ["from_status", "to_status"], "left")
            .withColumn("allowed", F.coalesce(F.col("allowed"), F.lit(False))))
