"""Vehicle state, idle episodes and idle alerts (batch forms).

``vehicle_latest`` is a ``max_by`` aggregate, so it combines map-side and a hot
vehicle costs one partial row per task. Idle episodes are gaps-and-islands on
a per-vehicle running count of non-idle events, computed with the
bucketed scan of :mod:`mobility.operators.scan`, so one busy vehicle
does not become one task.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mobility.functions.clock import SimClock, micros
from mobility.operators.scan import QUOTA, running_count
from mobility.schema import IDLE, TS

# Fixed alert values of the reference.
ALERT_TYPE = "VEHICLE_IDLE"
ALERT_SEVERITY = "warning"
IDLE_ALERT_MINUTES = 3.0


def _order_key(tiebreak: str | None) -> Column:
    return F.struct(F.col(TS), F.col(tiebreak)) if tiebreak else F.col(TS)


def vehicle_latest(valid: DataFrame, tiebreak: str | None = "event_id") -> DataFrame:
    """Row 16: newest (status, zone, event time) per vehicle."""
    latest = F.max_by(F.struct("status", "zone", F.col(TS).alias("last_event_ts")), _order_key(tiebreak))
    return (valid.groupBy("vehicle_id").agg(latest.alias("_l"))
            .select("vehicle_id", "_l.status", "_l.zone", "_l.last_event_ts"))


def vehicle_state_step(prev_state: DataFrame, latest: DataFrame) -> DataFrame:
    """Row 24: apply each vehicle's latest event to the stored state.

    idle_since stays when the vehicle was already idle, starts at this event
    when it turns idle, and is NULL otherwise. Vehicles without a new event
    keep their stored row."""
    p = prev_state.select("vehicle_id", F.col("status").alias("_ps"), F.col("zone").alias("_pz"),
                          F.col("last_event_ts").alias("_pts"), F.col("idle_since").alias("_pidle"))
    j = latest.join(p, "vehicle_id", "full_outer")
    fresh = F.col("last_event_ts").isNotNull()
    idle_since = (F.when(F.col("status") != IDLE, F.lit(None))
                  .when((F.col("_ps") == IDLE) & F.col("_pidle").isNotNull(), F.col("_pidle"))
                  .otherwise(F.col("last_event_ts")))
    return j.select(
        "vehicle_id",
        F.when(fresh, F.col("status")).otherwise(F.col("_ps")).alias("status"),
        F.when(fresh, F.col("zone")).otherwise(F.col("_pz")).alias("zone"),
        F.when(fresh, F.col("last_event_ts")).otherwise(F.col("_pts")).alias("last_event_ts"),
        F.when(fresh, idle_since).otherwise(F.col("_pidle")).alias("idle_since"),
    )


def state_from_latest(latest: DataFrame) -> DataFrame:
    """A first state table from latest events (no stored state yet)."""
    return latest.select(
        "vehicle_id", "status", "zone", "last_event_ts",
        F.when(F.col("status") == IDLE, F.col("last_event_ts")).alias("idle_since"))


def idle_episodes(valid: DataFrame, tiebreak: str = "event_id", quota: int = QUOTA) -> DataFrame:
    """Row 28: one row per idle run of a vehicle.

    ``run`` counts the vehicle's non-idle events so far; idle events sharing a
    run value form one episode. ``ended_at`` is the time of the non-idle event
    that closed it (NULL while open)."""
    ev = (valid.where(F.col("vehicle_id").isNotNull())
          .select("vehicle_id", "status", TS, tiebreak,
                  (F.col("status") != IDLE).cast("int").alias("_busy")))
    ev = running_count(ev, "vehicle_id", [TS, tiebreak], "_busy", "run", quota=quota)
    busy = F.col("_busy") == 1
    # A non-idle event closes the run before its own, so each row belongs to one episode.
    groups = ev.groupBy("vehicle_id", (F.col("run") - F.col("_busy")).alias("run")).agg(
        F.min(F.when(~busy, F.col(TS))).alias("idle_since"),
        F.max(F.when(~busy, F.col(TS))).alias("last_idle_ts"),
        F.sum(1 - F.col("_busy")).cast("bigint").alias("idle_events"),
        F.min(F.when(busy, F.col(TS))).alias("ended_at"),
    )
    return groups.where(F.col("idle_events") > 0).drop("run")


def iso_text(ts: Column) -> Column:
    """``datetime.isoformat()`` of a UTC instant: fraction only when non-zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    frac = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return F.when(F.pmod(micros(ts), F.lit(1_000_000)) == 0, whole).otherwise(frac)


def idle_alerts(episodes: DataFrame, as_of: Column, clock: SimClock,
                minutes: float = IDLE_ALERT_MINUTES) -> DataFrame:
    """Row 29: an alert for every episode idle for at least ``minutes``.

    An episode lasts until the event that ended it, or until ``as_of`` while
    open, so a silent vehicle still alerts. The alert is stamped when the
    threshold was crossed."""
    limit_us = int(round(minutes * 60 * 1_000_000))
    until = F.coalesce(F.col("ended_at"), as_of)
    crossed = F.timestamp_micros(micros("idle_since") + F.lit(limit_us))
    alerts = episodes.where(micros(until) - micros("idle_since") >= F.lit(limit_us)).select(
        F.lit(ALERT_TYPE).alias("alert_type"),
        "vehicle_id",
        F.lit(ALERT_SEVERITY).alias("severity"),
        F.concat(F.lit("Vehicle "), F.col("vehicle_id"), F.lit(" idle since "),
                 iso_text(F.col("idle_since"))).alias("message"),
        clock.day(crossed).alias("sim_day"),
        crossed.alias("created_at"),
        F.col("ended_at").isNull().alias("open"),
    )
    return alerts.dropDuplicates(["alert_type", "vehicle_id", "message"])
