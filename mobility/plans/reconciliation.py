"""The daily batch job: lake x landed expenses -> profitability -> check -> report.

Runs all pending days in one pass (one scan, one join, one shuffle per
aggregate) instead of a loop of per-day jobs. The days are literals in the plan:
the lake and the stored tables are read by partition, the landing zone by
file, and the fleet windows between the days' first and last instant, so the work follows the days asked
for and not all that was ever stored. Results are written as
day-partitioned tables with dynamic partition overwrite, so re-running a day
(late expense files, retries) replaces exactly that day. Each written table
is read back for the next step, which also cuts the lineage. A ledger row per day
is written last, with a fingerprint of the files that the day was made from (its lake partition, backfill included, and its
expense files). Days in the ledger are no longer pending, also if they had no rows, until their files change:
events that arrive late, or an expense file landed again, make the day pending once more.
"""
from __future__ import annotations

import functools
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mobility.functions.clock import SimClock, micros
from mobility.operators import reconcile as rc
from mobility.schema import COST, MONEY
from mobility.sinks.files import append_once, read_appended
from mobility.sinks.report import daily_report, write_reports
from mobility.sinks.upsert import read_upsert_log
from mobility.sources.expenses import expenses_scan, landing_files
from mobility.sources.lake import backfill_root, lake_scan, path_exists


@dataclass
class BatchConfig:
    clock: SimClock
    lake: str
    landing: str
    fleet_metrics: str          # upsert log written by the speed layer
    profitability: str
    expense_rejects: str
    consistency: str
    reports: str
    heartbeats: str
    threshold: float = 0.0
    span_seconds: int = 300
    expenses: str | None = None     # accepted expense rows
    ledger: str | None = None       # days processed

    def __post_init__(self):
        base = self.profitability.rstrip("/").rpartition("/")[0]
        self.expenses = self.expenses or f"{base}/expenses"
        self.ledger = self.ledger or f"{base}/processed_days"


def _write_days(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("sim_day").parquet(path))


LEDGER_SCHEMA = "sim_day int, fingerprint string, files long, bytes long, processed_at timestamp"


def processed_days(spark: SparkSession, cfg: BatchConfig) -> DataFrame:
    """The ledger's newest row of each day that a run has finished."""
    rows = read_appended(spark, cfg.ledger, LEDGER_SCHEMA)
    newest = F.max_by(F.struct("fingerprint", "files", "bytes", "processed_at"), "processed_at")
    return rows.groupBy("sim_day").agg(newest.alias("r")).select("sim_day", "r.*")


def input_fingerprints(spark: SparkSession, cfg: BatchConfig) -> DataFrame:
    """``sim_day, fingerprint, files, bytes`` of the files each day is made from: names, sizes and times of change,
    from listings alone. The order of the files has no influence."""
    found = [_listed(spark, root, "*.parquet", r"/sim_day=(\d+)/")
             for root in (cfg.lake, backfill_root(cfg.lake)) if path_exists(spark, root)]
    if path_exists(spark, cfg.landing):
        found.append(_listed(spark, cfg.landing, "*.csv", rc.EXPENSE_FILE_PATTERN))
    empty = spark.createDataFrame([], "sim_day int, h long, length long")
    files = functools.reduce(DataFrame.unionByName, found, empty).where("sim_day is not null")
    # The sum beside the XOR tells a file given twice from none.
    return files.groupBy("sim_day").agg(
        F.concat_ws("-", F.hex(F.bit_xor("h")), F.count(F.lit(1)), F.sum("length")).alias("fingerprint"),
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def _listed(spark: SparkSession, root: str, glob: str, day_pattern: str) -> DataFrame:
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
             .load(root).select("path", "length", "modificationTime"))
    day = F.regexp_extract("path", day_pattern, 1).try_cast("int")
    return files.select(day.alias("sim_day"), F.xxhash64("path", "length", "modificationTime").alias("h"), "length")


def days_to_do(spark: SparkSession, cfg: BatchConfig) -> DataFrame:
    """Landed days that no run has finished, or whose files have changed since."""
    landed = rc.landed_days(landing_files(spark, cfg.landing))
    done = processed_days(spark, cfg).select("sim_day", F.lit(True).alias("done"), F.col("fingerprint").alias("seen"))
    now = input_fingerprints(spark, cfg).select("sim_day", "fingerprint")
    j = landed.join(done, "sim_day", "left").join(now, "sim_day", "left")
    return j.where(F.col("done").isNull() | (F.col("seen") != F.col("fingerprint"))).select("sim_day")


def _days_to_run(spark: SparkSession, cfg: BatchConfig, days: list[int] | None) -> tuple[list[int], list[str]]:
    """(days, their files): at most one row per landed file that is still to do."""
    listing = landing_files(spark, cfg.landing)
    if days is None:
        days = sorted(r.sim_day for r in days_to_do(spark, cfg).collect())  # bounded: days to do
    day = F.regexp_extract("path", rc.EXPENSE_FILE_PATTERN, 1).try_cast("int")
    files = listing.where(day.isin(days)).collect() if days else []  # bounded: files of these days
    return days, sorted(r.path for r in files)


def run(spark: SparkSession, cfg: BatchConfig, days: list[int] | None = None,
        generated_at=None) -> DataFrame:
    """Reconcile ``days`` (default: every landed day not yet processed).
    Returns the consistency rows of the processed days."""
    cfg.clock.check_span(cfg.span_seconds)
    days, files = _days_to_run(spark, cfg, days)
    of_days = F.col("sim_day").isin(days)
    # Taken before the files are read: what arrives meanwhile makes the day pending again.
    seen = {r.sim_day: r for r in input_fingerprints(spark, cfg).where(of_days).collect()} if days else {}  # bounded: days to do

    if files:
        labeled = expenses_scan(spark, files, rc.EXPENSE_FILE_PATTERN, True)
    else:
        labeled = expenses_frame(spark)
    labels = f"{cfg.expenses.rstrip('/')}_labeled"
    rc.label_expenses(labeled).write.mode("overwrite").parquet(labels)  # one pass over the files
    labeled = spark.read.parquet(labels)
    loaded_at = F.current_timestamp().alias("loaded_at")
    _write_days(labeled.where("reject_reason is not null").select("*", loaded_at), cfg.expense_rejects)
    _write_days(labeled.where("reject_reason is null").drop("reject_reason").select("*", loaded_at), cfg.expenses)
    good = labeled.where("reject_reason is null")

    events = lake_scan(spark, cfg.lake).where(of_days)
    profit = rc.daily_profitability(rc.trip_summary(events), good, cfg.threshold)
    _write_days(profit.withColumn("generated_at", F.current_timestamp()), cfg.profitability)
    profit = spark.read.schema(PROFIT_SCHEMA).parquet(cfg.profitability).where(of_days)

    fleet = read_upsert_log(spark, cfg.fleet_metrics, ["window_start"], snapshot=f"{cfg.fleet_metrics}_snapshots",
                            rows=_window_of(cfg.clock, days))
    speed = rc.speed_day_totals(fleet).where(of_days)
    check = rc.consistency_check(speed, rc.batch_day_totals(profit))
    _write_days(check.withColumn("checked_at", F.current_timestamp()), cfg.consistency)
    check = spark.read.schema(CHECK_SCHEMA).parquet(cfg.consistency).where(of_days)

    write_reports(daily_report(profit, check, generated_at), cfg.reports)
    rows = [(d, seen[d].fingerprint, seen[d].files, seen[d].bytes) if d in seen else (d, None, 0, 0) for d in days]
    done = spark.createDataFrame(rows, "sim_day int, fingerprint string, files long, bytes long")
    token = uuid.uuid5(uuid.NAMESPACE_OID, repr(rows)).hex  # the same days of the same inputs count once
    append_once(done.withColumn("processed_at", F.current_timestamp()).coalesce(1), cfg.ledger, token)
    append_once(done.select(F.lit("batch_reconcile").alias("component"), F.current_timestamp().alias("at"),
                            F.concat(F.lit("day "), F.col("sim_day").cast("string")).alias("detail")).coalesce(1),
                cfg.heartbeats, f"reconcile-{token}")
    return check


def expenses_frame(spark: SparkSession) -> DataFrame:
    """An empty table of expense rows."""
    return spark.createDataFrame([], f"vehicle_id string, sim_day int, fuel_cost {COST}, maintenance_cost {COST}, "
                                     f"distance_covered {COST}, service_flag boolean")


def _window_of(clock: SimClock, days: list[int]) -> Column:
    """Windows that start within the days' span (day 0 has all before it too)."""
    if not days:
        return F.lit(False)
    start = micros("window_start")
    first = F.lit(True) if min(days) == 0 else start >= F.lit(clock.epoch_us + min(days) * clock.day_us)
    return first & (start < F.lit(clock.epoch_us + (max(days) + 1) * clock.day_us))


PROFIT_SCHEMA = (f"vehicle_id string, trips int, earnings {MONEY}, fuel_cost {COST}, maintenance_cost {COST}, "
                 f"distance_covered {COST}, profit {MONEY}, profit_per_km double, cost_per_km double, "
                 "unprofitable boolean, service_flag boolean, has_expenses boolean, generated_at timestamp, sim_day int")
CHECK_SCHEMA = (f"speed_trips bigint, batch_trips bigint, speed_earnings {MONEY}, batch_earnings {MONEY}, "
                "earnings_delta_pct double, checked_at timestamp, sim_day int")
