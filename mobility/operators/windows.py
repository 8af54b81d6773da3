"""Sliding-window utilisation and earnings, per zone and for the whole fleet.

Exact form (batch): three map-side combined aggregations.

1. Events collapse to one row per (zone, vehicle, step), where the step is
   the gcd of window size and slide (1 minute for 5 min / 1 min): every
   window boundary is a step boundary, so a step lies wholly inside the same
   windows. Telemetry arrives every few seconds per vehicle, so this shrinks
   the rows the sliding window multiplies by size/slide (x5) about twentyfold.
2. Step rows are slid into windows and collapsed per (window, zone, vehicle):
   the vehicle's flags and sums. A hot zone is spread by vehicle.
3. Those rows are summed per (window, zone).

This also avoids the Expand x3 that two ``count(DISTINCT ...)`` over
different expressions would add on top of the sliding window's Expand.

Sketch form: one HLL sketch of the active and of the idle vehicles per (key, step) is stored; a window of any
size and slide that are whole steps is the union of its steps' sketches. Events are read once for all windows, and
what slides is a row per (key, step), never an event.

Approximate form (streaming, the reference's estimator): one aggregation with
``approx_count_distinct``, which a streaming query accepts in update mode.
"""
from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mobility.functions.clock import SimClock, floor_div, micros, ntz
from mobility.functions.money import cents, from_cents
from mobility.schema import IDLE, TS

WINDOW = "5 minutes"
SLIDE = "1 minute"
#: Relative standard error of approximate distinct counts.
RSD = 0.05


#: Registers of a stored sketch, as a power of two, and the relative standard error that gives.
SKETCH_LG_K = 12
SKETCH_RSD = 1.04 / math.sqrt(1 << SKETCH_LG_K)


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def interval_seconds(text: str) -> int:
    """Seconds of a duration such as ``"5 minutes"``."""
    m = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day)s?\s*", text.lower())
    if not m:
        raise ValueError(f"unsupported interval {text!r}")
    return int(m.group(1)) * _UNIT_SECONDS[m.group(2)]


def _flags(valid: DataFrame) -> tuple[Column, Column, Column, Column]:
    vid = F.col("vehicle_id")
    active = F.when(F.col("status") != IDLE, vid)
    idle = F.when(F.col("status") == IDLE, vid)
    trip = F.when(F.col("trip_completed"), F.lit(1)).otherwise(F.lit(0))
    fare = F.when(F.col("trip_completed"), cents(F.col("fare"))).otherwise(F.lit(0).cast("long"))
    return active, idle, trip, fare


def window_aggregate(valid: DataFrame, keys: list[str], size: str = WINDOW, slide: str = SLIDE,
                     exact: bool = True, rsd: float = RSD, per_step: bool = True) -> DataFrame:
    """``window`` struct + keys + active_vehicles, idle_vehicles, trips_completed,
    earnings_cents (summed as whole cents, see :mod:`mobility.functions.money`).

    ``per_step=False`` skips step 1: for sparse input (far fewer than one event
    per vehicle and step) it only adds a shuffle that removes no rows."""
    active, idle, trip, fare = _flags(valid)
    w = F.window(F.col(TS), size, slide).alias("window")
    if not exact:
        return valid.groupBy(w, *keys).agg(
            F.approx_count_distinct(active, rsd).alias("active_vehicles"),
            F.approx_count_distinct(idle, rsd).alias("idle_vehicles"),
            F.sum(trip).alias("trips_completed"),
            F.sum(fare).alias("earnings_cents"),
        )
    rows = valid.select(*keys, "vehicle_id", TS, active.isNotNull().cast("int").alias("_a"),
                        idle.isNotNull().cast("int").alias("_i"), trip.alias("_t"), fare.alias("_e"))
    if per_step:
        step_us = math.gcd(interval_seconds(size), interval_seconds(slide)) * 1_000_000
        rows = (rows.withColumn("_step", floor_div(micros(TS), step_us))
                .groupBy(*keys, "vehicle_id", "_step").agg(
                    F.max("_a").alias("_a"), F.max("_i").alias("_i"), F.sum("_t").alias("_t"), F.sum("_e").alias("_e"))
                .withColumn(TS, F.timestamp_micros(F.col("_step") * F.lit(step_us))))
    per_vehicle = rows.groupBy(F.window(F.col(TS), size, slide).alias("window"), *keys, "vehicle_id").agg(
        F.max("_a").alias("_a"), F.max("_i").alias("_i"), F.sum("_t").alias("_t"), F.sum("_e").alias("_e"))
    return per_vehicle.groupBy("window", *keys).agg(
        F.sum("_a").alias("active_vehicles"),
        F.sum("_i").alias("idle_vehicles"),
        F.sum("_t").alias("trips_completed"),
        F.sum("_e").alias("earnings_cents"),
    )


def finish_window_metrics(agg: DataFrame, clock: SimClock, keys: list[str]) -> DataFrame:
    """Row 15: flatten the window, add sim_day/sim_hour of its start, the idle
    ratio (NULL with no vehicles) and zeros for empty sums."""
    active = F.coalesce(F.col("active_vehicles"), F.lit(0)).cast("int")
    idle = F.coalesce(F.col("idle_vehicles"), F.lit(0)).cast("int")
    start = F.col("window.start")
    return agg.select(
        ntz(start).alias("window_start"),
        ntz(F.col("window.end")).alias("window_end"),
        *keys,
        clock.day(start).alias("sim_day"),
        clock.hour(start).alias("sim_hour"),
        active.alias("active_vehicles"),
        idle.alias("idle_vehicles"),
        F.try_divide(idle.cast("double"), (active + idle).cast("double")).alias("idle_ratio"),
        F.coalesce(F.col("trips_completed"), F.lit(0)).cast("int").alias("trips_completed"),
        from_cents(F.coalesce(F.col("earnings_cents"), F.lit(0))).alias("earnings"),
    )


def zone_window_metrics(valid: DataFrame, clock: SimClock, size: str = WINDOW,
                        slide: str = SLIDE, exact: bool = True, per_step: bool = True) -> DataFrame:
    agg = window_aggregate(valid, ["zone"], size, slide, exact, per_step=per_step)
    return finish_window_metrics(agg, clock, ["zone"])


def fleet_window_metrics(valid: DataFrame, clock: SimClock, size: str = WINDOW,
                         slide: str = SLIDE, exact: bool = True, per_step: bool = True) -> DataFrame:
    return finish_window_metrics(window_aggregate(valid, [], size, slide, exact, per_step=per_step), clock, [])


def distinct_sketches(valid: DataFrame, keys: list[str], step: str = SLIDE, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """Rows 12-14, mergeable: keys, ``step_start``, and per step the sketches of its active and idle vehicles
    and its exact trips and cents. One aggregation that combines before it shuffles; meant to be stored."""
    active, idle, trip, fare = _flags(valid)
    step_us = interval_seconds(step) * 1_000_000
    at = F.timestamp_micros(floor_div(micros(TS), step_us) * F.lit(step_us))
    return valid.groupBy(*keys, at.alias("step_start")).agg(
        F.hll_sketch_agg(active, F.lit(lg_k)).alias("active_sketch"), F.hll_sketch_agg(idle, F.lit(lg_k)).alias("idle_sketch"),
        F.sum(trip).alias("trips_completed"), F.sum(fare).alias("earnings_cents"))


def windows_of_sketches(sketches: DataFrame, keys: list[str], size: str = WINDOW, slide: str = SLIDE,
                        step: str = SLIDE) -> DataFrame:
    """``window`` struct + keys + counts of :func:`window_aggregate`, from stored sketches of ``step``."""
    if interval_seconds(size) % interval_seconds(step) or interval_seconds(slide) % interval_seconds(step):
        raise ValueError(f"windows of {size} each {slide} are no whole steps of {step}")
    return sketches.groupBy(F.window(F.col("step_start"), size, slide).alias("window"), *keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("active_sketch")).alias("active_vehicles"),
        F.hll_sketch_estimate(F.hll_union_agg("idle_sketch")).alias("idle_vehicles"),
        F.sum("trips_completed").alias("trips_completed"), F.sum("earnings_cents").alias("earnings_cents"))
