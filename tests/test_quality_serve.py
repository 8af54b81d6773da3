from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mobility.operators import audit, quality, serve


def _ts(s):
    return F.lit(s).cast("timestamp")


def test_pipeline_health_missing_heartbeat_and_degraded(spark):
    beats = spark.createDataFrame([("stream_sink", "2024-01-01 00:00:30"), ("stream_sink", "2024-01-01 00:00:50"),
                                   ("batch_sim", "2023-12-31 00:00:00")], "component string, at string") \
        .withColumn("at", F.col("at").cast("timestamp"))
    th = quality.thresholds_frame(spark, {"stream_sink": 60, "batch_sim": 600, "batch_reconcile": 900})
    rows = {r.component: r for r in quality.pipeline_health(beats, th, _ts("2024-01-01 00:01:00")).collect()}
    assert rows["stream_sink"].seconds_since_last_success == 10.0 and rows["stream_sink"].healthy
    assert not rows["batch_sim"].healthy
    assert rows["batch_reconcile"].seconds_since_last_success == 1e9 and rows["batch_reconcile"].last_success_at is None
    assert {r.overall for r in rows.values()} == {"degraded"}


def test_pipeline_health_all_fresh_is_ok(spark):
    beats = spark.createDataFrame([("a", "2024-01-01 00:00:59")], "component string, at string") \
        .withColumn("at", F.col("at").cast("timestamp"))
    th = quality.thresholds_frame(spark, {"a": 60})
    assert quality.pipeline_health(beats, th, _ts("2024-01-01 00:01:00")).first().overall == "ok"


def test_sustained_breach_needs_the_hold(spark):
    samples = spark.createDataFrame(
        [("r", f"2024-01-01 00:00:{s:02d}", v) for s, v in
         [(0, 0.1), (10, 0.1), (20, 0.0), (30, 0.2), (40, 0.3), (50, 0.3)]],
        "rule string, window_start string, ratio double").withColumn("window_start", F.col("window_start").cast("timestamp"))
    got = quality.sustained_breach(samples, F.col("ratio") > 0.05, step_seconds=10, hold_seconds=20).collect()
    assert [(str(r.breach_start), r.samples, r.held_seconds) for r in got] == [("2024-01-01 00:00:30", 3, 20)]
    got = quality.sustained_breach(samples, F.col("ratio") > 0.05, step_seconds=10, hold_seconds=10).collect()
    assert sorted(r.samples for r in got) == [2, 3]


def test_event_staleness_flags_silent_keys(spark):
    ev = spark.createDataFrame([("V1", "2024-01-01 00:00:00"), ("V2", "2024-01-01 00:01:30")],
                               "vehicle_id string, event_ts string").withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    rows = {r.vehicle_id: r for r in quality.event_staleness(ev, _ts("2024-01-01 00:02:00")).collect()}
    assert rows["V1"].stale and rows["V1"].seconds_since_last_event == 120.0
    assert not rows["V2"].stale


def test_ingest_quality_ratio(spark):
    from mobility.operators.ingest import decode_telemetry
    good = ('{"vehicle_id":"V1","zone":"z","status":"idle","timestamp":"2024-01-01T00:00:00+00:00"}')
    raw = spark.createDataFrame([(good, "2024-01-01 00:00:10"), ("{bad", "2024-01-01 00:00:20"),
                                 (good, "2024-01-01 00:00:30"), (good, "2024-01-01 00:01:30")],
                                "value string, ingest_ts string").withColumn("ingest_ts", F.col("ingest_ts").cast("timestamp"))
    rows = {str(r.window_start): r for r in quality.ingest_quality(decode_telemetry(raw, keep=["ingest_ts"])).collect()}
    first = rows["2024-01-01 00:00:00"]
    assert (first.valid_records, first.invalid_records) == (2, 1) and first.invalid_ratio == pytest.approx(1 / 3)
    assert rows["2024-01-01 00:01:00"].invalid_ratio == 0.0


def test_trip_fare_audit_rebuilds_distance(spark):
    ev = spark.createDataFrame([
        ("t1", "V1", "enroute", 30.0, False, 0.0), ("t1", "V1", "on_trip", 36.0, False, 0.0),
        ("t1", "V1", "on_trip", 24.0, False, 0.0), ("t1", "V1", "idle", 0.0, True, 4.0),
        ("t2", "V1", "enroute", 10.0, False, 0.0)],
        "trip_id string, vehicle_id string, status string, speed double, trip_completed boolean, fare double")
    rows = {r.trip_id: r for r in audit.trip_fare_audit(ev, interval_seconds=3.0).collect()}
    assert rows["t1"].on_trip_events == 2 and rows["t1"].distance_km == pytest.approx(0.05)
    assert rows["t1"].expected_fare == pytest.approx(3.5 + 0.85 * 0.05) and rows["t1"].settled_fare == 4.0
    assert rows["t2"].settled_fare is None and rows["t2"].distance_km == 0.0


def test_status_transitions_flag_lifecycle_breaks(spark):
    ev = spark.createDataFrame([
        (1, "V1", "idle", "2024-01-01 00:00:00"), (2, "V1", "enroute", "2024-01-01 00:00:03"),
        (3, "V1", "on_trip", "2024-01-01 00:00:06"), (4, "V1", "idle", "2024-01-01 00:00:09"),
        (5, "V1", "on_trip", "2024-01-01 00:00:12"), (6, "V2", "idle", "2024-01-01 00:00:00")],
        "event_id long, vehicle_id string, status string, event_ts string").withColumn(
        "event_ts", F.col("event_ts").cast("timestamp"))
    rows = {(r.from_status, r.to_status): (r.transitions, r.allowed)
            for r in audit.status_transitions(ev, spark, quota=3).collect()}
    assert rows == {("idle", "enroute"): (1, True), ("enroute", "on_trip"): (1, True),
                    ("on_trip", "idle"): (1, True), ("idle", "on_trip"): (1, False)}


PROFIT = ("vehicle_id string, sim_day int, trips int, earnings decimal(12,2), profit decimal(12,2), "
          "unprofitable boolean")


def test_report_queries(spark):
    profit = spark.createDataFrame([
        ("V1", 1, 1, Decimal("5"), Decimal("-3"), True), ("V2", 1, 2, Decimal("9"), Decimal("-8"), True),
        ("V3", 1, 0, Decimal("0"), None, False), ("V4", 2, 3, Decimal("7"), Decimal("2"), False),
        ("V5", 2, 1, Decimal("1"), Decimal("-1"), True)], PROFIT)
    latest = serve.profit_report(profit).collect()
    assert [r.vehicle_id for r in latest] == ["V5", "V4"]
    day1 = [r.vehicle_id for r in serve.profit_report(profit, day=1).collect()]
    assert day1 == ["V2", "V1", "V3"]  # profit ascending, NULL last
    assert [r.vehicle_id for r in serve.profit_report(profit, day=1, unprofitable_only=True).collect()] == ["V2", "V1"]
    summary = {r.sim_day: r for r in serve.report_summary(profit).collect()}
    assert (summary[1].vehicles, summary[1].unprofitable_vehicles, summary[1].total_earnings) == (3, 2, Decimal("14.00"))
    top = serve.top_unprofitable(profit, n=1).collect()
    assert sorted((r.sim_day, r.vehicle_id) for r in top) == [(1, "V2"), (2, "V5")]
    assert [r.sim_day for r in serve.report_days(profit).collect()] == [2, 1]


def test_latest_rows(spark):
    zm = spark.createDataFrame([("a", "2024-01-01 00:00:00", 1), ("a", "2024-01-01 00:01:00", 2),
                                ("b", "2024-01-01 00:00:00", 3)], "zone string, window_start string, v int") \
        .withColumn("window_start", F.col("window_start").cast("timestamp"))
    rows = {r.zone: r.v for r in serve.zone_latest(zm).collect()}
    assert rows == {"a": 2, "b": 3}
    assert serve.fleet_latest(zm).first().v == 2
    assert serve.fleet_latest(zm.limit(0)).count() == 0
