"""Batch layer: trips x expenses -> per-vehicle daily profitability, the
speed-vs-batch consistency check, and discovery of days still to process.

All of it is one lazy plan per call. Joins are left to the planner: AQE turns a
shuffle join into a broadcast at run time when a side's measured size is below
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and keeps the shuffle
otherwise, so no side is broadcast on an unchecked guess.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobility.functions.clock import SimClock, micros
from mobility.functions.money import money_sum
from mobility.schema import COST, MONEY, TS

# A landed file, or a folder of that name holding part files.
EXPENSE_FILE_PATTERN = r"expenses_day_(\d+)\.csv(?:$|/)"

# The columns of the profitability table.
PROFIT_COLUMNS = [
    "vehicle_id", "sim_day", "trips", "earnings", "fuel_cost", "maintenance_cost",
    "distance_covered", "profit", "profit_per_km", "cost_per_km", "unprofitable",
    "service_flag", "has_expenses",
]


def money(col) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast(MONEY)


# ---------------------------------------------------------------- discovery (row 5)


def landed_days(listing: DataFrame, path_col: str = "path",
                pattern: str = EXPENSE_FILE_PATTERN) -> DataFrame:
    """Day numbers of landed files whose name matches ``pattern``."""
    day = F.regexp_extract(F.col(path_col), pattern, 1)
    return (listing.where(F.col(path_col).rlike(pattern))
            .select(day.cast("int").alias("sim_day")).distinct())


def pending_days(listing: DataFrame, ledger: DataFrame, path_col: str = "path",
                 pattern: str = EXPENSE_FILE_PATTERN) -> DataFrame:
    """Landed days not in the ledger of processed days (``ledger.sim_day``)."""
    done = ledger.select(F.col("sim_day").cast("int").alias("sim_day")).distinct()
    return landed_days(listing, path_col, pattern).join(done, "sim_day", "left_anti")


def next_pending_day(listing: DataFrame, ledger: DataFrame, **kw) -> DataFrame:
    """One row: the earliest pending day, NULL when none is pending."""
    return pending_days(listing, ledger, **kw).agg(F.min("sim_day").alias("next_day"))


# ---------------------------------------------------------------- expenses (row 11)


def label_expenses(expenses: DataFrame, keys=("vehicle_id", "sim_day")) -> DataFrame:
    """Expense rows with ``reject_reason`` (NULL = loadable). Enforces the
    table constraints: every column in the file (where ``missing_columns`` is given; it is dropped), key present (vehicle and day), costs and distance that fit
    their type and are >= 0, one row per key."""
    keys = list(keys)
    counts = (expenses.where(F.col("vehicle_id").isNotNull())
              .groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")))
    labeled = expenses.join(counts, keys, "left")
    if "missing_columns" not in labeled.columns:
        labeled = labeled.withColumn("missing_columns", F.lit(None).cast("string"))
    reason = (F.when(F.col("missing_columns").isNotNull(), F.concat(F.lit("missing_columns:"), F.col("missing_columns")))
              .when(F.col("vehicle_id").isNull(), "missing_vehicle_id")
              .when(F.col("sim_day").isNull(), "missing_sim_day")
              .when(F.col("fuel_cost").isNull(), "fuel_cost_out_of_range")
              .when(F.col("maintenance_cost").isNull(), "maintenance_cost_out_of_range")
              .when(F.col("distance_covered").isNull(), "distance_out_of_range")
              .when(F.col("fuel_cost") < 0, "negative_fuel_cost")
              .when(F.col("maintenance_cost") < 0, "negative_maintenance_cost")
              .when(F.col("distance_covered") < 0, "negative_distance")
              .when(F.col("_rows") > 1, "duplicate_key"))
    return labeled.withColumn("reject_reason", reason).drop("_rows", "missing_columns")


def validate_expenses(expenses: DataFrame, keys=("vehicle_id", "sim_day")) -> tuple[DataFrame, DataFrame]:
    labeled = label_expenses(expenses, keys)
    good = labeled.where(F.col("reject_reason").isNull()).drop("reject_reason")
    rejects = labeled.where(F.col("reject_reason").isNotNull())
    return good, rejects


# ---------------------------------------------------------------- trips (row 17)


def trip_summary(events: DataFrame, clock: SimClock | None = None) -> DataFrame:
    """Per (vehicle, sim_day): trips = completed events with a trip id,
    earnings = their fares. Needs ``sim_day`` or a clock to derive it."""
    if "sim_day" not in events.columns:
        if clock is None:
            raise ValueError("events have no sim_day column and no clock was given")
        events = events.withColumn("sim_day", clock.day(TS))
    done = events.where(F.col("trip_completed") & F.col("vehicle_id").isNotNull())
    return done.groupBy("vehicle_id", "sim_day").agg(
        F.count("trip_id").cast("int").alias("trips"),
        money_sum(F.col("fare")).alias("earnings"),
    )


# ---------------------------------------------------------------- profitability (rows 21-22)


def daily_profitability(trips: DataFrame, expenses: DataFrame, threshold: float = 0.0) -> DataFrame:
    """Full outer join of trip summaries and expenses on (vehicle, day)."""
    t = trips.select("vehicle_id", "sim_day", "trips", "earnings", F.lit(True).alias("_has_trips"))
    e = expenses.select("vehicle_id", "sim_day",
                        F.col("fuel_cost").cast(COST).alias("fuel_cost"),
                        F.col("maintenance_cost").cast(COST).alias("maintenance_cost"),
                        F.col("distance_covered").cast(COST).alias("distance_covered"),
                        "service_flag", F.lit(True).alias("_has_expenses"))
    j = t.join(e, ["vehicle_id", "sim_day"], "full_outer")
    has_exp = F.coalesce(F.col("_has_expenses"), F.lit(False))
    earnings = F.coalesce(F.col("earnings"), F.lit(0).cast(MONEY))
    total_cost = (F.coalesce(F.col("fuel_cost"), F.lit(0).cast(COST))
                  + F.coalesce(F.col("maintenance_cost"), F.lit(0).cast(COST)))
    profit = money(F.when(has_exp, earnings - total_cost))
    km = F.when(F.col("distance_covered") > 0, F.col("distance_covered").cast("double"))
    return j.select(
        "vehicle_id",
        F.col("sim_day").cast("int").alias("sim_day"),
        F.coalesce(F.col("trips"), F.lit(0)).cast("int").alias("trips"),
        money(earnings).alias("earnings"),
        "fuel_cost", "maintenance_cost", "distance_covered",
        profit.alias("profit"),
        (profit.cast("double") / km).alias("profit_per_km"),
        (total_cost.cast("double") / km).alias("cost_per_km"),
        (profit.isNotNull() & (profit < F.lit(threshold))).alias("unprofitable"),
        F.coalesce(F.col("service_flag"), F.lit(False)).alias("service_flag"),
        has_exp.alias("has_expenses"),
    )


# ---------------------------------------------------------------- consistency (rows 18, 19, 23)


def batch_day_totals(profit: DataFrame) -> DataFrame:
    return profit.groupBy("sim_day").agg(
        F.coalesce(F.sum("trips"), F.lit(0)).cast("bigint").alias("batch_trips"),
        money(F.coalesce(F.sum("earnings"), F.lit(0))).alias("batch_earnings"),
    )


def batch_day_totals_of(trips: DataFrame, expenses: DataFrame) -> DataFrame:
    """``batch_day_totals`` of the table that ``daily_profitability`` makes of these inputs,
    without the join: its trips and earnings are those of the trips, and days
    with expenses only count zero."""
    rows = trips.select("sim_day", "trips", "earnings").unionByName(expenses.select("sim_day").distinct().select(
        "sim_day", F.lit(0).alias("trips"), F.lit(0).cast(MONEY).alias("earnings")))
    return batch_day_totals(rows)


def speed_day_totals(fleet_metrics: DataFrame) -> DataFrame:
    """Sum the fleet windows that tile the day: sliding windows overlap, and
    only the starts that are a multiple of the window span partition time."""
    start, end = micros("window_start"), micros("window_end")
    aligned = F.pmod(start, end - start) == 0
    return fleet_metrics.where(aligned).groupBy("sim_day").agg(
        F.coalesce(F.sum("trips_completed"), F.lit(0)).cast("bigint").alias("speed_trips"),
        money(F.coalesce(F.sum("earnings"), F.lit(0))).alias("speed_earnings"),
    )


def consistency_check(speed: DataFrame, batch: DataFrame) -> DataFrame:
    """Per day: both layers' totals and |speed - batch| / batch * 100 (NULL
    when batch earnings are 0). A day missing on one side counts as zeros."""
    j = speed.join(batch, "sim_day", "full_outer")
    s = F.coalesce(F.col("speed_earnings"), F.lit(0).cast(MONEY))
    b = F.coalesce(F.col("batch_earnings"), F.lit(0).cast(MONEY))
    delta = F.when(b != 0, F.abs((s - b).cast("double")) / b.cast("double") * F.lit(100.0))
    return j.select(
        F.col("sim_day").cast("int").alias("sim_day"),
        F.coalesce(F.col("speed_trips"), F.lit(0)).cast("bigint").alias("speed_trips"),
        F.coalesce(F.col("batch_trips"), F.lit(0)).cast("bigint").alias("batch_trips"),
        money(s).alias("speed_earnings"),
        money(b).alias("batch_earnings"),
        delta.alias("earnings_delta_pct"),
    )


def report_with_check(profit: DataFrame, check: DataFrame) -> DataFrame:
    """Report rows with their day's check row.

    The check has one row per simulated day. AQE broadcasts it once it has
    measured it, and splits a large day's report rows otherwise."""
    c = check.select("sim_day", "speed_trips", "batch_trips", "speed_earnings",
                     "batch_earnings", "earnings_delta_pct")
    return profit.join(c, "sim_day", "left")
