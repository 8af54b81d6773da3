"""Stored counters, once-only appends, the rules job, SQL table functions, sketches, data skipping, the ledger."""
import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from mobility.operators import windows as win
from mobility.operators.ingest import valid_events
from mobility.plans import monitoring, reconciliation, views
from mobility.sinks import files
from mobility.sinks.upsert import write_upsert_batch
from mobility.sources import fixtures as fx
from mobility.sources.lake import lake_scan
from mobility.streaming import app
from mobility.streaming.metrics import IngestMetrics, read_metrics
from tests.conftest import SF_SMALL

CLOCK = fx.FIXTURE_CLOCK


def _payloads(folder, batches):
    """One JSON-lines file per micro-batch of (vehicle, seconds after midnight); a vehicle of None is a broken payload."""
    folder.mkdir()
    for i, rows in enumerate(batches):
        lines = []
        for vehicle, sec in rows:
            at = (datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=sec)).isoformat()
            lines.append("{broken" + str(sec) if vehicle is None else json.dumps(
                {"vehicle_id": vehicle, "zone": "z", "status": "enroute", "trip_completed": False, "timestamp": at}))
        p = folder / f"b{i:03d}.json"
        p.write_text("\n".join(lines) + "\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


def _config(tmp_path):
    now = {"availableNow": True}
    names = ["lake", "dead_letters", "zone_metrics", "fleet_metrics", "vehicle_state", "alerts", "checkpoints"]
    return app.StreamConfig(clock=CLOCK, **{n: str(tmp_path / n) for n in names}, metrics=str(tmp_path / "ingest_metrics"),
                            heartbeats=str(tmp_path / "heartbeats"), archive_trigger=now, window_trigger=now, state_trigger=now)


BATCHES = [[("A", 0), ("B", 600), (None, 1)], [("A", 700)], [("A", 100), ("B", 200), ("B", 470), (None, 2), (None, 3), ("A", 900)]]


def test_counters_and_late_drops_are_stored_per_batch(spark, tmp_path):
    folder = _payloads(tmp_path / "in", BATCHES)
    cfg = _config(tmp_path)
    listener = IngestMetrics(spark, cfg.metrics)
    spark.streams.addListener(listener)
    try:
        decoded = app.observe_ingest(app.decoded_stream(app.raw_events(spark, "text", {"maxFilesPerTrigger": "1"}, folder)))
        query = app.window_query(valid_events(decoded, keep=["event_id"]), cfg, by_zone=True)
        query.awaitTermination(300)
        listener.wait_for("zone_metrics")
    finally:
        spark.streams.removeListener(listener)
        listener.close()
    rows = {r.batch_id: r for r in read_metrics(spark, cfg.metrics).where("input_rows > 0").collect()}
    assert [(rows[i].valid_records, rows[i].invalid_records) for i in range(3)] == [(2, 1), (1, 0), (4, 2)]
    # an aggregation drops what the batch before's watermark had passed, 600 - 120 s for the third one: of its
    # windows, those that end at 120, 180, ... 480 s (100, 200 and 470 s fall into them)
    assert [rows[i].dropped_rows for i in range(3)] == [0, 0, 7]


def test_late_events_are_stored_or_counted_and_not_applied(spark, tmp_path):
    """The engine drops rows by the watermark of the batch before; the rows between that one and the current one are stored."""
    second = [("A", 700), ("A", 100), ("B", 200), ("B", 470)]
    folder = _payloads(tmp_path / "in", [[("A", 0), ("B", 600)], second, [("A", 130), ("B", 300), ("A", 520), ("A", 900)]])
    cfg = _config(tmp_path)
    listener = IngestMetrics(spark, cfg.metrics)
    spark.streams.addListener(listener)
    try:
        decoded = app.observe_ingest(app.decoded_stream(app.raw_events(spark, "text", {"maxFilesPerTrigger": "1"}, folder)))
        app.vehicle_state_query(valid_events(decoded, keep=["event_id"]), cfg).awaitTermination(300)
        listener.wait_for("vehicle_state")
    finally:
        spark.streams.removeListener(listener)
        listener.close()
    late = files.read_appended(spark, app.late_path(cfg), app.LATE_SCHEMA).collect()
    assert sorted((r.vehicle_id, str(r.event_ts)) for r in late) == [
        ("A", "2024-01-01 00:01:40"), ("A", "2024-01-01 00:08:40"), ("B", "2024-01-01 00:03:20"), ("B", "2024-01-01 00:07:50")]
    rows = {r.batch_id: r.dropped_rows for r in read_metrics(spark, cfg.metrics).where("input_rows > 0").collect()}
    assert [rows[i] for i in range(3)] == [0, 0, 2]


def test_state_holds_a_row_for_each_waiting_event(spark, tmp_path):
    folder = _payloads(tmp_path / "in", [[("A", i) for i in range(50)] + [("B", 5)]])
    cfg = _config(tmp_path)
    query = app.vehicle_state_query(
        valid_events(app.decoded_stream(app.raw_events(spark, "text", {}, folder)), keep=["event_id"]), cfg)
    query.awaitTermination(300)
    first = next(p for p in query.recentProgress if p["numInputRows"])
    # a value and a list of waiting rows (merged under one key as rows come) for each of the two vehicles
    assert first["stateOperators"][0]["customMetrics"]["numListStateVars"] >= 1
    assert first["stateOperators"][0]["numRowsTotal"] == 2 * 2


def test_appends_of_a_token_count_once_and_unfinished_ones_not(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k long, v string"
    assert files.read_appended(spark, path, schema).count() == 0
    one, two = spark.createDataFrame([(1, "a"), (2, "b")], schema), spark.createDataFrame([(3, "c")], schema)
    files.append_once(one, path, "one")
    files.append_once(one, path, "one")  # a retry
    files.append_once(two, path, "two")
    broken = tmp_path / "t" / "token=three"
    spark.createDataFrame([(4, "d")], schema).write.parquet(str(broken))
    (broken / "_SUCCESS").unlink()  # broken off before its commit
    assert files.committed_tokens(spark, path) == ["one", "two"]
    assert sorted(map(tuple, files.read_appended(spark, path, schema).collect())) == [(1, "a"), (2, "b"), (3, "c")]
    files.append_rows(spark.createDataFrame([(9, "plain")], schema), path)
    assert files.read_appended(spark, path, schema).count() == 4


def test_rules_job_over_stored_tables(spark, tmp_path):
    at = datetime(2024, 1, 1, 12, 0, 0, tzinfo=timezone.utc)
    schema = ("query string, batch_id long, at timestamp, input_rows long, valid_records long, invalid_records long, dropped_rows long")
    rows = [("archive", i, at + timedelta(seconds=10 * i), 10, 10 if i < 6 else 5, 0 if i < 6 else 5, 0) for i in range(12)]
    for r in rows:
        files.append_once(spark.createDataFrame([r], schema), str(tmp_path / "ingest_metrics"), f"archive-{r[1]}")
    until = at + timedelta(minutes=5)
    ledger = spark.createDataFrame([(1, "f", 1, 1, at)], reconciliation.LEDGER_SCHEMA)
    files.append_once(ledger, str(tmp_path / "processed_days"), "a")
    files.heartbeat(spark, str(tmp_path / "heartbeats"), "stream_sink", "x")
    spark.sql("SELECT 1").collect()
    breaches, health = monitoring.evaluate(spark, str(tmp_path), CLOCK, until)
    got = {r.rule: (str(r.breach_start), str(r.last_breach_sample)) for r in breaches.collect()}
    # the last batch reported at 12:01:50: over 60 s of silence from the sample at 12:03:00 on
    assert got["no_recent_events"] == ("2024-01-01 12:03:00", "2024-01-01 12:05:00")
    assert got["high_invalid_ratio"][0] == "2024-01-01 12:01:15" and "batch_stale" not in got
    # heartbeats of this moment lie after the instant evaluated: nothing had reported by then
    assert {(r.component, r.healthy, r.overall) for r in health.collect()} == {
        ("stream_sink", False, "degraded"), ("batch_reconcile", False, "degraded")}
    for _ in range(2):
        monitoring.run(spark, str(tmp_path), CLOCK, until)
    assert len(files.committed_tokens(spark, str(tmp_path / "rule_breaches"))) == 1


def test_sketches_serve_windows_of_any_size(spark):
    lake = fx.lake_events(spark, SF_SMALL)
    sketches = win.distinct_sketches(lake, ["zone"], step="30 minutes")
    for size, slide in (("1 hour", "30 minutes"), ("6 hours", "2 hours")):
        got = win.windows_of_sketches(sketches, ["zone"], size, slide, step="30 minutes")
        want = win.window_aggregate(lake, ["zone"], size, slide)
        j = got.alias("g").join(want.alias("w"), ["window", "zone"])
        assert j.count() == want.count() == got.count()
        assert j.where("g.trips_completed <> w.trips_completed or g.earnings_cents <> w.earnings_cents "
                       "or abs(g.active_vehicles - w.active_vehicles) > 1 or abs(g.idle_vehicles - w.idle_vehicles) > 1").count() == 0
    with pytest.raises(ValueError):
        win.windows_of_sketches(sketches, ["zone"], "45 minutes", "15 minutes", step="30 minutes")


def test_sketches_move_no_event_through_the_sliding_window(spark):
    plan = win.windows_of_sketches(win.distinct_sketches(fx.lake_events(spark, SF_SMALL), ["zone"]), ["zone"]) \
        ._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    # the expansion into windows stands above the aggregation that makes the sketches
    assert next(i for i, x in enumerate(lines) if "Expand" in x) < next(i for i, x in enumerate(lines) if "hll_sketch_agg" in x)


def test_sql_table_functions_equal_the_serving_statements(spark, tmp_path):
    schema = "vehicle_id string, sim_day int, profit double, unprofitable boolean"
    spark.createDataFrame([("V1", 1, -2.0, True), ("V2", 1, 3.0, False), ("V1", 2, 1.0, False), ("V2", 2, -1.0, True)], schema) \
        .write.parquet(str(tmp_path / "daily_profitability"))
    alerts = spark.createDataFrame([("T", f"V{i % 2}", f"m{i}", datetime(2024, 1, 1, i)) for i in range(6)],
                                   "alert_type string, vehicle_id string, message string, created_at timestamp")
    write_upsert_batch(alerts, 0, str(tmp_path / "alerts"))
    views.register_views(spark, str(tmp_path))
    made = views.register_functions(spark)
    assert {"alerts_of", "profitability_of", "reported_days"} <= set(made) and "fleet_now" not in made

    def same(sql, name, **params):
        got, want = spark.sql(sql), views.serving_query(spark, name, **params)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect())) and want.count() > 0

    same("SELECT * FROM profitability_of()", "profitability_report")
    same("SELECT * FROM profitability_of(1, true)", "profitability_report", sim_day=1, unprofitable_only=True)
    same("SELECT * FROM alerts_of('V1', 2)", "alerts", vehicle_id="V1", limit=2)
    same("SELECT * FROM alerts_of()", "alerts")
    same("SELECT * FROM reported_days()", "report_days")


def test_a_read_of_one_vehicle_skips_row_groups(spark, tmp_path):
    lake = str(tmp_path / "lake")
    rows = spark.range(200_000).select(
        F.col("id").alias("event_id"), *[F.lit(None).cast("string").alias(c) for c in ("trip_id", "driver_id", "zone")],
        F.concat(F.lit("V"), F.lpad((F.col("id") % 1000).cast("string"), 4, "0")).alias("vehicle_id"), F.lit("idle").alias("status"),
        *[F.lit(0.0).alias(c) for c in ("lat", "lon", "speed", "fare")], F.lit(False).alias("trip_completed"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 80_000).alias("event_ts"))
    spark.conf.set("parquet.block.size", str(64 << 10))
    try:
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        hadoop.set("parquet.block.size", str(64 << 10))
        files.archive_by_day(rows, lake, CLOCK)
    finally:
        hadoop.unset("parquet.block.size")
        spark.conf.unset("parquet.block.size")
    one = lake_scan(spark, lake).where("vehicle_id = 'V0500'").select("event_id")
    found = one.collect()
    assert len(found) == 200
    node = one._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().apply(0)
    read = node.metrics().get("numOutputRows").get().value()
    assert 200 <= read < 100_000


def _batch_config(root):
    names = ["lake", "landing", "fleet", "profit", "rejects", "check", "reports", "beats"]
    return reconciliation.BatchConfig(CLOCK, *[str(root / n) for n in names])


def test_rows_that_land_after_reconciliation_reopen_their_day(spark, tmp_path):
    cfg = _batch_config(tmp_path)
    (tmp_path / "landing").mkdir()
    for d in (1, 2):
        (tmp_path / "landing" / f"expenses_day_{d}.csv").write_text(
            "vehicle_id,fuel_cost,maintenance_cost,distance_covered,service_flag\nV0001,1,1,10,no\n")
    events = fx.lake_events(spark, SF_SMALL).withColumn("vehicle_id", F.lit("V0001"))
    files.archive_by_day(events.where(CLOCK.day("event_ts").isin(1, 2)), cfg.lake, CLOCK)
    write_upsert_batch(spark.createDataFrame([], "window_start timestamp, window_end timestamp, sim_day int, "
                                                 "trips_completed int, earnings decimal(20,2)"), 0, cfg.fleet_metrics)
    assert reconciliation._days_to_run(spark, cfg, None)[0] == [1, 2]
    reconciliation.run(spark, cfg)
    assert reconciliation._days_to_run(spark, cfg, None)[0] == []
    before = {r.sim_day: r.trips for r in spark.read.parquet(cfg.profitability).collect()}
    late = (spark.createDataFrame([(10**9, "t9", 5.0)], "event_id long, trip_id string, fare double")
            .select("event_id", "trip_id", *[F.lit(None).cast("string").alias(c) for c in ("driver_id", "zone")],
                    F.lit("V0001").alias("vehicle_id"), F.lit("idle").alias("status"),
                    *[F.lit(0.0).alias(c) for c in ("lat", "lon", "speed")], "fare", F.lit(True).alias("trip_completed"),
                    F.timestamp_seconds(F.lit(CLOCK.epoch_us // 1_000_000 + 2 * 86_400 + 60)).alias("event_ts")))
    late.withColumn("sim_day", F.lit(2)).write.mode("append").partitionBy("sim_day").parquet(cfg.lake)
    assert reconciliation._days_to_run(spark, cfg, None)[0] == [2]
    reconciliation.run(spark, cfg)
    after = {r.sim_day: r.trips for r in spark.read.parquet(cfg.profitability).collect()}
    assert after == {1: before[1], 2: before[2] + 1}
    assert reconciliation._days_to_run(spark, cfg, None)[0] == []
    assert {r.sim_day for r in reconciliation.processed_days(spark, cfg).collect()} == {1, 2}
