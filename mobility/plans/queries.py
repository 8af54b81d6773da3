"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the
supplied tables, built from the operators. Outputs use the declared types and
``timestamp_ntz`` for instants (what DuckDB calls TIMESTAMP)."""
from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mobility.functions.clock import SimClock, micros, ntz, with_sim_clock
from mobility.operators import audit, dims, serve
from mobility.operators import ingest as ing
from mobility.operators import quality as qual
from mobility.operators import reconcile as rc
from mobility.operators import state as st
from mobility.operators import windows as win
from mobility.schema import BUSINESS_COLUMNS, CORRUPT_COLUMN, TS
from mobility.plans.derived import materialized
from mobility.plans.memo import shared_plan
from mobility.sinks import report
from mobility.sinks import upsert as ups
from mobility.sinks.files import archive_by_day
from mobility.sources import expenses as exp_src
from mobility.sources import fixtures as fx
from mobility.sources import lake as lake_src

CLOCK = fx.FIXTURE_CLOCK

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(fn: Query) -> Query:
    """Add a query; it runs with the UTC session zone its semantics assume
    (instants are UTC; naive timestamps are read as UTC)."""
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    REGISTRY[fn.__name__] = run
    return run


def _ntz_out(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, ntz(c))
    return df


# ---------------------------------------------------------------- shared pieces


@shared_plan
def lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid events with their simulated day, as the archive holds them."""
    return fx.lake_events(spark, sf_dir).withColumn("sim_day", CLOCK.day(TS))


@shared_plan
def profitability(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = rc.trip_summary(lake(spark, sf_dir))
    return rc.daily_profitability(trips, fx.expenses(spark, sf_dir), threshold=0.0)


# ---------------------------------------------------------------- batch layer


@register
def trip_summary(spark, sf_dir):
    return rc.trip_summary(lake(spark, sf_dir))


@register
def daily_profitability(spark, sf_dir):
    return profitability(spark, sf_dir)


# ---------------------------------------------------------------- more shared pieces


@shared_plan
def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads through the real decoder; the broker timestamp is the event's."""
    raw = fx.raw_payloads(spark, sf_dir)
    return ing.decode_telemetry(raw, value="raw_value", keep=["event_id", "ingest_ts"])


@shared_plan
def fleet_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return win.fleet_window_metrics(lake(spark, sf_dir), CLOCK)


@shared_plan
def zone_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return win.zone_window_metrics(lake(spark, sf_dir), CLOCK)


def as_of_last_event(events: DataFrame) -> F.Column:
    """Newest event time as a scalar subquery (evaluated by Spark, not collected)."""
    return events.select(F.max(TS)).scalar()


@shared_plan
def state_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored state after the first half of the period (days < SPLIT_DAY)."""
    early = lake(spark, sf_dir).where(F.col("sim_day") < SPLIT_DAY)
    return st.state_from_latest(st.vehicle_latest(early))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = lake(spark, sf_dir)
    return st.idle_alerts(st.idle_episodes(ev), as_of_last_event(ev), CLOCK)


SPLIT_DAY = 15
SCAN_DAY = 29  # the last simulated day of the fixture period
SHORT_CLOCK = SimClock(epoch=CLOCK.epoch, day_seconds=300)


# ---------------------------------------------------------------- ingest


@register
def decode_telemetry(spark, sf_dir):
    d = decoded(spark, sf_dir)
    return _ntz_out(d.select("event_id", *BUSINESS_COLUMNS,
                             F.col(CORRUPT_COLUMN).isNotNull().alias("corrupt")), TS)


@register
def valid_events(spark, sf_dir):
    return _ntz_out(ing.valid_events(decoded(spark, sf_dir), keep=["event_id"]), TS)


@register
def dead_letters(spark, sf_dir):
    return ing.dead_letters(decoded(spark, sf_dir), keep=["event_id"])


@register
def sim_clock(spark, sf_dir):
    ev = fx.lake_events(spark, sf_dir).select("event_id", TS)
    return with_sim_clock(ev, SHORT_CLOCK).drop(TS)


@register
def vehicle_dim(spark, sf_dir):
    ids = fx.table(spark, sf_dir, "events").select((F.col("user_id") + 1).alias("i")).distinct()
    return dims.vehicle_dim(spark, source=ids)


@register
def validate_expenses(spark, sf_dir):
    return rc.label_expenses(fx.expense_lines(spark, sf_dir))


# ---------------------------------------------------------------- windows


@register
def zone_window_metrics(spark, sf_dir):
    return zone_metrics(spark, sf_dir)


@register
def fleet_window_metrics(spark, sf_dir):
    return fleet_metrics(spark, sf_dir)


@register
def window_distinct_approx(spark, sf_dir):
    return win.zone_window_metrics(lake(spark, sf_dir), CLOCK, exact=False)


@register
def window_distinct_bound(spark, sf_dir):
    """Exact counts of each window, and whether the approximate ones are within three standard errors."""
    keys = ["window_start", "zone"]
    exact = zone_metrics(spark, sf_dir).select(*keys, "active_vehicles", "idle_vehicles")
    approx = win.zone_window_metrics(lake(spark, sf_dir), CLOCK, exact=False).select(
        *keys, F.col("active_vehicles").alias("_a"), F.col("idle_vehicles").alias("_i"))

    def within(approximate: str, count: str) -> F.Column:
        return F.abs(F.col(approximate) - F.col(count)) <= F.ceil(3 * win.RSD * F.col(count))

    return exact.join(approx, keys).select(
        *keys, "active_vehicles", "idle_vehicles",
        (within("_a", "active_vehicles") & within("_i", "idle_vehicles")).alias("within_bound"))


@register
def window_distinct_sketch(spark, sf_dir):
    """Exact counts of each window, and whether those of the united sketches are within three standard errors."""
    keys = ["window_start", "zone"]
    exact = zone_metrics(spark, sf_dir).select(*keys, "active_vehicles", "idle_vehicles")
    sketches = win.distinct_sketches(lake(spark, sf_dir), ["zone"])
    united = win.windows_of_sketches(sketches, ["zone"]).select(
        ntz(F.col("window.start")).alias("window_start"), "zone", F.col("active_vehicles").alias("_a"), F.col("idle_vehicles").alias("_i"))

    def within(estimate: str, count: str) -> F.Column:
        return F.abs(F.col(estimate) - F.col(count)) <= F.ceil(3 * win.SKETCH_RSD * F.col(count))

    return exact.join(united, keys).select(
        *keys, "active_vehicles", "idle_vehicles",
        (within("_a", "active_vehicles") & within("_i", "idle_vehicles")).alias("within_bound"))


@register
def ingest_quality(spark, sf_dir):
    return qual.ingest_quality(decoded(spark, sf_dir), size="1 hour")


# ---------------------------------------------------------------- state


@register
def vehicle_latest(spark, sf_dir):
    return _ntz_out(st.vehicle_latest(lake(spark, sf_dir)), "last_event_ts")


@register
def vehicle_state_step(spark, sf_dir):
    latest = st.vehicle_latest(lake(spark, sf_dir))
    return _ntz_out(st.vehicle_state_step(state_before(spark, sf_dir), latest), "last_event_ts", "idle_since")


@register
def keyed_upsert(spark, sf_dir):
    return _upserted(spark, sf_dir, None)


def _upserted(spark, sf_dir, update_cols):
    late = lake(spark, sf_dir).where(F.col("sim_day") >= SPLIT_DAY)
    updates = st.state_from_latest(st.vehicle_latest(late))
    merged = ups.keyed_upsert(state_before(spark, sf_dir), updates, ["vehicle_id"], update_cols)
    return _ntz_out(merged, "last_event_ts", "idle_since")


@register
def keyed_upsert_some_columns(spark, sf_dir):
    return _upserted(spark, sf_dir, ["zone", "last_event_ts"])


@register
def keyed_upsert_insert_only(spark, sf_dir):
    return _upserted(spark, sf_dir, [])


@register
def idle_episodes(spark, sf_dir):
    return _ntz_out(st.idle_episodes(lake(spark, sf_dir)), "idle_since", "last_idle_ts", "ended_at")


@register
def idle_alerts(spark, sf_dir):
    return _ntz_out(alerts(spark, sf_dir), "created_at")


@register
def recent_alerts(spark, sf_dir):
    return _ntz_out(serve.recent_alerts(alerts(spark, sf_dir), limit=50), "created_at")


@register
def recent_alerts_of_vehicle(spark, sf_dir):
    return _ntz_out(serve.recent_alerts(alerts(spark, sf_dir), vehicle_id="V0003", limit=50), "created_at")


# ---------------------------------------------------------------- consistency and reports


@register
def batch_day_totals(spark, sf_dir):
    return rc.batch_day_totals(profitability(spark, sf_dir))


@register
def speed_day_totals(spark, sf_dir):
    CLOCK.check_span(300)
    return rc.speed_day_totals(fleet_metrics(spark, sf_dir))


@shared_plan
def _check(spark, sf_dir):
    speed = rc.speed_day_totals(fleet_metrics(spark, sf_dir))
    trips = rc.trip_summary(lake(spark, sf_dir))
    return rc.consistency_check(speed, rc.batch_day_totals_of(trips, fx.expenses(spark, sf_dir)))


@register
def consistency_check(spark, sf_dir):
    CLOCK.check_span(300)
    return _check(spark, sf_dir)


@register
def report_with_check(spark, sf_dir):
    return rc.report_with_check(profitability(spark, sf_dir), _check(spark, sf_dir))


@register
def fleet_latest(spark, sf_dir):
    return serve.fleet_latest(fleet_metrics(spark, sf_dir))


@register
def zone_latest(spark, sf_dir):
    return serve.zone_latest(zone_metrics(spark, sf_dir))


@register
def profit_report(spark, sf_dir):
    # The newest day of the joined table is that of its inputs: no second join for it.
    done = lake(spark, sf_dir).where(F.col("trip_completed") & F.col("vehicle_id").isNotNull())
    newest = F.greatest(serve.latest_day(done), serve.latest_day(fx.expenses(spark, sf_dir)))
    return serve.profit_report(profitability(spark, sf_dir), day=newest)


@register
def profit_report_unprofitable(spark, sf_dir):
    return serve.profit_report(profitability(spark, sf_dir), day=SPLIT_DAY, unprofitable_only=True)


@register
def daily_report(spark, sf_dir):
    return report.daily_report(profitability(spark, sf_dir), _check(spark, sf_dir),
                               F.lit("2024-02-01 00:00:00").cast("timestamp"))


@register
def report_summary(spark, sf_dir):
    return serve.report_summary(profitability(spark, sf_dir))


@register
def top_unprofitable(spark, sf_dir):
    return serve.top_unprofitable(profitability(spark, sf_dir), n=10)


@register
def report_days(spark, sf_dir):
    return serve.report_days(profitability(spark, sf_dir))


@register
def pending_days(spark, sf_dir):
    return rc.pending_days(fx.landing_listing(spark, sf_dir), profitability(spark, sf_dir))


@register
def next_pending_day(spark, sf_dir):
    return rc.next_pending_day(fx.landing_listing(spark, sf_dir), profitability(spark, sf_dir))


# ---------------------------------------------------------------- health and audits


def day_end(day: F.Column) -> F.Column:
    """The instant a simulated day closes (when its batch work can succeed)."""
    return F.timestamp_micros(F.lit(CLOCK.epoch_us) + (day + 1).cast("bigint") * F.lit(CLOCK.day_us))


@register
def pipeline_health(spark, sf_dir):
    ev = lake(spark, sf_dir)
    profit = profitability(spark, sf_dir)
    beats = (ev.select(F.lit("stream_sink").alias("component"), F.col(TS).alias("at"))
             .unionByName(fx.expenses(spark, sf_dir).select(
                 F.lit("batch_sim").alias("component"), day_end(F.col("sim_day")).alias("at")))
             .unionByName(profit.where(F.col("has_expenses")).select(
                 F.lit("batch_reconcile").alias("component"), day_end(F.col("sim_day")).alias("at"))))
    thresholds = qual.thresholds_frame(spark, {
        "stream_sink": qual.STALE_EVENT_SECONDS,
        "batch_sim": 2 * CLOCK.day_seconds,
        "batch_reconcile": 3 * CLOCK.day_seconds,
    })
    return qual.pipeline_health(beats, thresholds, as_of_last_event(ev))


@register
def event_staleness(spark, sf_dir):
    ev = lake(spark, sf_dir)
    return qual.event_staleness(ev, as_of_last_event(ev))


@register
def sustained_breach(spark, sf_dir):
    samples = qual.ingest_quality(decoded(spark, sf_dir), size="3 hours")
    samples = samples.withColumn("rule", F.lit("invalid_ratio"))
    return qual.sustained_breach(samples, F.col("invalid_ratio") > 0.02, step_seconds=10_800,
                                 hold_seconds=10_800)


@register
def alert_rule_breaches(spark, sf_dir):
    """The three alert rules at their own limits: events, invalid payloads, batch runs (one per closed day)."""
    steps = qual.step_summary(decoded(spark, sf_dir))
    runs = profitability(spark, sf_dir).where("has_expenses").select("sim_day").distinct().select(
        micros(day_end(F.col("sim_day"))).alias("_first"), micros(day_end(F.col("sim_day"))).alias("_last"))
    until = F.timestamp_micros(steps.select(F.max("_last")).scalar())
    return qual.rule_breaches(steps, runs, until)


@register
def trip_fare_audit(spark, sf_dir):
    return audit.trip_fare_audit(lake(spark, sf_dir), interval_seconds=3600.0)


@register
def status_transitions(spark, sf_dir):
    return audit.status_transitions(lake(spark, sf_dir), spark)


# ---------------------------------------------------------------- written tables, read back


def lake_root(spark: SparkSession, sf_dir: str) -> str:
    return materialized(spark, "lake", sf_dir, ["events"],
                        lambda p: archive_by_day(fx.lake_events(spark, sf_dir), p, CLOCK))


def landing_root(spark: SparkSession, sf_dir: str) -> str:
    return materialized(spark, "landing", sf_dir, ["lineitem"],
                        lambda p: exp_src.write_landing(fx.expenses(spark, sf_dir), p))


@register
def lake_day_scan(spark, sf_dir):
    day = lake_src.lake_day_scan(spark, lake_root(spark, sf_dir), SCAN_DAY)
    return _ntz_out(day, TS)


@register
def lake_scan(spark, sf_dir):
    return _ntz_out(lake_src.lake_scan(spark, lake_root(spark, sf_dir)), TS)


@register
def expenses_scan(spark, sf_dir):
    return exp_src.expenses_scan(spark, landing_root(spark, sf_dir))
