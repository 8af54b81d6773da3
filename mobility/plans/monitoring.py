"""Health and alert rules over the stored tables, as a job (``python -m mobility rules``).

Reads the ingest counters that the streams' listener stored, the heartbeats of all components and the
ledger of batch runs; evaluates the three alert rules (row 45) and the components' health
(row 43) up to an instant, and writes both, so that a dashboard reads tables. A run for the same
instant replaces its result.
"""
from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mobility.functions.clock import SimClock, micros
from mobility.operators import quality
from mobility.plans.reconciliation import LEDGER_SCHEMA
from mobility.sinks.files import HEARTBEAT_SCHEMA, append_once, read_appended
from mobility.streaming.metrics import read_metrics


def component_limits(clock: SimClock) -> dict[str, float]:
    """Seconds without success after which a component counts as stale."""
    return {"stream_sink": quality.STALE_EVENT_SECONDS, "batch_reconcile": 3.0 * clock.day_seconds}


def evaluate(spark: SparkSession, root: str, clock: SimClock, until: datetime,
             rules: dict[str, tuple[float, int]] | None = None) -> tuple[DataFrame, DataFrame]:
    """(breaches of the alert rules, health of the components) of the tables under ``root`` up to ``until``."""
    base = root.rstrip("/")
    at = F.lit(until).cast("timestamp")
    metrics = read_metrics(spark, f"{base}/ingest_metrics").where(F.col("at") <= at)
    runs = read_appended(spark, f"{base}/processed_days", LEDGER_SCHEMA).where(F.col("processed_at") <= at).select(
        micros("processed_at").alias("_first"), micros("processed_at").alias("_last"))
    breaches = quality.rule_breaches(quality.metrics_steps(metrics), runs, at, rules)
    beats = read_appended(spark, f"{base}/heartbeats", HEARTBEAT_SCHEMA).where(F.col("at") <= at)
    health = quality.pipeline_health(beats, quality.thresholds_frame(spark, component_limits(clock)), at)
    return breaches, health


def run(spark: SparkSession, root: str, clock: SimClock, until: datetime) -> None:
    """Evaluate and store: ``rule_breaches`` and ``component_health`` under ``root``."""
    breaches, health = evaluate(spark, root, clock, until)
    token = until.strftime("%Y%m%dT%H%M%S%f")
    stamped = F.lit(until).cast("timestamp").alias("evaluated_at")
    append_once(breaches.select("*", stamped), f"{root.rstrip('/')}/rule_breaches", token)
    append_once(health.select("*", stamped), f"{root.rstrip('/')}/component_health", token)
