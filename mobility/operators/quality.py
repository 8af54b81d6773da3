"""Data-quality and pipeline-health rules, re-aimed from the metrics/alerting
stack as DataFrame queries: ingest validity per window, staleness, health
per component, and "held for N seconds" breach intervals."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mobility.functions.clock import floor_div, micros, ntz
from mobility.operators.ingest import valid_condition

# Fixed thresholds of the reference's rules.
STALE_EVENT_SECONDS = 60.0
INVALID_RATIO_LIMIT = 0.05
STALE_BATCH_SECONDS = 900.0
MISSING_HEARTBEAT_AGE = 1e9
# Rule -> (limit that its value must be over, seconds that it must stay so).
ALERT_RULES = {
    "no_recent_events": (STALE_EVENT_SECONDS, 15),
    "high_invalid_ratio": (INVALID_RATIO_LIMIT, 30),
    "batch_stale": (STALE_BATCH_SECONDS, 30),
}
SAMPLE_SECONDS = 15


def ingest_quality(decoded: DataFrame, size: str = "1 minute", ingest_ts: str = "ingest_ts") -> DataFrame:
    """Row 20: valid / invalid record counts and the invalid ratio per window
    of ingest time (broken payloads have no event time of their own)."""
    ok = valid_condition()
    return decoded.groupBy(F.window(F.col(ingest_ts), size).alias("w")).agg(
        F.sum(ok.cast("int")).cast("bigint").alias("valid_records"),
        F.sum((~ok).cast("int")).cast("bigint").alias("invalid_records"),
    ).select(
        ntz(F.col("w.start")).alias("window_start"),
        ntz(F.col("w.end")).alias("window_end"),
        "valid_records", "invalid_records",
        F.try_divide(F.col("invalid_records").cast("double"),
                     (F.col("valid_records") + F.col("invalid_records")).cast("double")).alias("invalid_ratio"),
    )


def event_staleness(events: DataFrame, as_of: Column, key: str = "vehicle_id",
                    ts: str = "event_ts", limit_seconds: float = STALE_EVENT_SECONDS) -> DataFrame:
    """Row 44: per key, seconds from its last event to ``as_of``; stale above the limit."""
    last = events.groupBy(key).agg(F.max(ts).alias("last_event_ts"))
    age = (micros(as_of) - micros("last_event_ts")).cast("double") / F.lit(1_000_000.0)
    return last.select(key, ntz("last_event_ts").alias("last_event_ts"),
                       age.alias("seconds_since_last_event"),
                       (age > F.lit(limit_seconds)).alias("stale"))


def thresholds_frame(spark: SparkSession, thresholds: dict[str, float]) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in thresholds.items()],
                                 "component string, threshold_seconds double")


def pipeline_health(heartbeats: DataFrame, thresholds: DataFrame, as_of: Column) -> DataFrame:
    """Row 43: age of each component's last success; ``healthy`` iff below its
    threshold; a component that never reported gets age 1e9. ``overall`` is
    ``degraded`` when any component is stale."""
    last = heartbeats.groupBy("component").agg(F.max("at").alias("last_success_at"))
    j = thresholds.join(last, "component", "left")
    age = F.coalesce((micros(as_of) - micros("last_success_at")).cast("double") / F.lit(1_000_000.0),
                     F.lit(MISSING_HEARTBEAT_AGE))
    rows = j.select("component", ntz("last_success_at").alias("last_success_at"),
                    age.alias("seconds_since_last_success"), "threshold_seconds",
                    (age < F.col("threshold_seconds")).alias("healthy"))
    any_stale = rows.select(F.max((~F.col("healthy")).cast("int"))).scalar()
    return rows.withColumn("overall", F.when(any_stale == 1, "degraded").otherwise("ok"))


def step_summary(decoded: DataFrame, ingest_ts: str = "ingest_ts", step_seconds: int = SAMPLE_SECONDS) -> DataFrame:
    """``_i, _first, _last, _bad, _n``: the records of each step of ingest time, summed up once for all rules."""
    step_us = step_seconds * 1_000_000
    ok = valid_condition()
    return (decoded.select(micros(ingest_ts).alias("_t"), (~ok).cast("long").alias("_b"))
            .groupBy(floor_div(F.col("_t"), step_us).alias("_i"))
            .agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"), F.sum("_b").alias("_bad"), F.count(F.lit(1)).alias("_n")))


def metrics_steps(metrics: DataFrame, step_seconds: int = SAMPLE_SECONDS) -> DataFrame:
    """The :func:`step_summary` of stored ingest counters (:mod:`mobility.streaming.metrics`): batches with
    records, by the step that they were reported in."""
    step_us = step_seconds * 1_000_000
    t = micros("at")
    n = F.col("valid_records") + F.col("invalid_records")
    return (metrics.where(n > 0).groupBy(floor_div(t, step_us).alias("_i"))
            .agg(F.min(t).alias("_first"), F.max(t).alias("_last"), F.sum("invalid_records").alias("_bad"), F.sum(n).alias("_n")))


def rule_breaches(steps: DataFrame, runs: DataFrame, until: Column, rules: dict[str, tuple[float, int]] | None = None) -> DataFrame:
    """Row 45: the breaches of the three alert rules. ``steps``: ingest summed up by step; ``runs``: ``_first`` and
    ``_last`` instant (microseconds) of batch runs that succeeded."""
    rules = rules or ALERT_RULES
    found = (age_breaches(steps, "no_recent_events", until, rules["no_recent_events"][0])
             .unionByName(ratio_breaches(steps, "high_invalid_ratio", rules["high_invalid_ratio"][0]))
             .unionByName(age_breaches(runs, "batch_stale", until, rules["batch_stale"][0])))
    return alert_rule_breaches(found, rules)


def age_breaches(steps: DataFrame, rule: str, until: Column, limit_seconds: float,
                 step_seconds: int = SAMPLE_SECONDS) -> DataFrame:
    """``rule, window_start, samples``: the samples (every multiple of ``step_seconds`` from the first success to
    ``until``) that are over ``limit_seconds`` after the last success, one row per gap between successes.

    ``steps``: ``_first`` and ``_last`` success of each step. A gap answers for its samples by arithmetic, however
    long it is. Steps are ordered within a day; between days one row a day is ordered."""
    step_us = step_seconds * 1_000_000
    limit_us = max(int(round(limit_seconds * 1_000_000)), step_us)
    # A success on the very instant of a sample counts for it: it belongs to the step before.
    last = (steps.select(F.explode(F.array("_first", "_last")).alias("_t"))
            .groupBy(floor_div(F.col("_t") - 1, step_us).alias("_i")).agg(F.max("_t").alias("_t")))
    days = last.withColumn("_d", floor_div(F.col("_i"), 86_400 // step_seconds))
    first = days.groupBy("_d").agg(F.min("_i").alias("_first"))
    after = first.select("_d", F.lead("_first").over(Window.orderBy("_d")).alias("_after"))
    inside = F.lead("_i").over(Window.partitionBy("_d").orderBy("_i"))
    ends = days.withColumn("_next", inside).join(after, "_d", "left")
    ends = ends.withColumn("_end", floor_div(micros(until), step_us))
    # sample k is at k * step; a success of step i is the last one for samples i + 1 .. the next success's step
    begin = F.greatest(F.col("_i") + 1, floor_div(F.col("_t") + limit_us, step_us) + 1)
    stop = F.least(F.coalesce("_next", "_after", "_end"), F.col("_end"))
    return ends.select(begin.alias("_k"), (stop - begin + 1).alias("samples")).where("samples > 0").select(
        F.lit(rule).alias("rule"), F.timestamp_micros(F.col("_k") * F.lit(step_us)).alias("window_start"), "samples")


def ratio_breaches(steps: DataFrame, rule: str, limit: float, range_seconds: int = 60,
                   step_seconds: int = SAMPLE_SECONDS) -> DataFrame:
    """``rule, window_start, samples``: the samples whose ``range_seconds`` before hold an invalid ratio over ``limit``."""
    step_us, n = step_seconds * 1_000_000, range_seconds // step_seconds
    slid = (steps.select(F.explode(F.sequence(F.col("_i") + 1, F.col("_i") + n)).alias("_k"), "_bad", "_n")
            .groupBy("_k").agg(F.sum("_bad").alias("_bad"), F.sum("_n").alias("_n")))
    over = F.col("_bad").cast("double") / F.col("_n").cast("double") > F.lit(limit)
    return slid.where(over).select(
        F.lit(rule).alias("rule"), F.timestamp_micros(F.col("_k") * F.lit(step_us)).alias("window_start"),
        F.lit(1).cast("long").alias("samples"))


def alert_rule_breaches(breaches: DataFrame, rules: dict[str, tuple[float, int]] | None = None,
                        step_seconds: int = SAMPLE_SECONDS) -> DataFrame:
    """Row 45 for several rules at once: each rule's breaches (``rule, window_start, samples``) held long enough."""
    islands = merged_breaches(breaches, step_seconds)
    held = reduce(lambda a, b: a | b, [
        (F.col("rule") == name) & (F.col("held_seconds") >= hold) for name, (_, hold) in (rules or ALERT_RULES).items()])
    return islands.where(held)


def merged_breaches(breaches: DataFrame, step_seconds: int, rule: str = "rule", start: str = "window_start",
                    samples: str = "samples") -> DataFrame:
    """Islands of touching breaches: each row is ``samples`` samples in a row, one every ``step_seconds``, from ``start`` on.

    A sample is a session that lasts until the next one, so sessions merge where samples follow each
    other. They merge within each (rule, day) first; a rule's days then meet with a row an island."""
    def seconds(count: Column) -> Column:
        return F.concat((count * F.lit(step_seconds)).cast("string"), F.lit(" seconds"))

    day = F.date_trunc("day", F.col(start))
    daily = (breaches.groupBy(rule, day.alias("_day"), F.session_window(start, seconds(F.col(samples))).alias("_w"))
             .agg(F.sum(samples).alias("_n")).select(rule, F.col("_w.start").alias("_s"), "_n"))
    whole = (daily.groupBy(rule, F.session_window("_s", seconds(F.col("_n"))).alias("_w"))
             .agg(F.sum("_n").cast("bigint").alias("samples")))
    last = F.timestamp_micros(micros("_w.start") + (F.col("samples") - 1) * F.lit(step_seconds * 1_000_000))
    return whole.select(
        rule, ntz("_w.start").alias("breach_start"), ntz(last).alias("last_breach_sample"), "samples",
        ((F.col("samples") - 1) * F.lit(step_seconds)).cast("bigint").alias("held_seconds"))


def sustained_breach(samples: DataFrame, breach: Column, step_seconds: int, hold_seconds: int,
                     rule: str = "rule", start: str = "window_start") -> DataFrame:
    """Row 45: islands of consecutive breaching samples (one every
    ``step_seconds``) that last at least ``hold_seconds`` - the ``for:`` clause."""
    one = samples.where(breach).select(rule, F.col(start).cast("timestamp").alias(start), F.lit(1).cast("long").alias("samples"))
    return merged_breaches(one, step_seconds, rule, start).where(F.col("held_seconds") >= F.lit(hold_seconds))
