"""Stream-equals-batch checks: time-ordered payload files,
one per micro-batch, ``availableNow``, results read back from the sinks."""
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from mobility.operators import state as st
from mobility.operators import windows as win
from mobility.operators.ingest import valid_events
from mobility.sinks.upsert import read_upsert_log
from mobility.sources import fixtures as fx
from mobility.sources.lake import lake_day_scan, lake_scan
from mobility.streaming import app
from mobility.streaming.state import vehicle_state_stream
from tests.conftest import SF_SMALL

CLOCK = fx.FIXTURE_CLOCK
FILES = 5


@pytest.fixture(scope="module")
def payload_dir(spark, tmp_path_factory):
    """sf0.001 payloads as FILES time-ordered JSON-lines files (test-sized)."""
    d = tmp_path_factory.mktemp("payloads")
    raw = fx.raw_payloads(spark, SF_SMALL).orderBy("ingest_ts", "event_id").collect()
    chunk = (len(raw) + FILES - 1) // FILES
    for i in range(FILES):
        p = d / f"batch_{i:02d}.json"
        p.write_text("\n".join(r.raw_value for r in raw[i * chunk:(i + 1) * chunk]) + "\n")
        os.utime(p, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    return str(d)


def _stream(spark, path):
    raw = app.raw_events(spark, "text", {"maxFilesPerTrigger": "1"}, path)
    return app.decoded_stream(raw)


def _payload_files(folder, batches, start=1_700_000_000):
    """One JSON-lines file per micro-batch of (vehicle, status, seconds after midnight)."""
    import json
    folder.mkdir()
    for i, rows in enumerate(batches):
        lines = []
        for vid, status, sec in rows:
            at = f"2024-01-01T{sec // 3600:02d}:{sec // 60 % 60:02d}:{sec % 60:02d}+00:00"
            lines.append(json.dumps({"vehicle_id": vid, "zone": "z", "status": status, "trip_completed": False, "timestamp": at}))
        p = folder / f"b{i:03d}.json"
        p.write_text("\n".join(lines) + "\n")
        os.utime(p, (start + i, start + i))
    return str(folder)


def _run(query):
    query.awaitTermination(300)
    assert query.exception() is None


def test_window_stream_equals_batch(spark, payload_dir, tmp_path):
    valid = valid_events(_stream(spark, payload_dir), keep=["event_id"])
    log = str(tmp_path / "zone_log")
    q = (app.window_stream(valid, CLOCK, by_zone=True).writeStream.outputMode("update")
         .foreachBatch(app._upsert_log_writer(log))
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    _run(q)
    streamed = read_upsert_log(spark, log, ["window_start", "zone"])
    lake = fx.lake_events(spark, SF_SMALL)
    batch = win.zone_window_metrics(lake, CLOCK, exact=False)
    cols = sorted(batch.columns)
    a = streamed.select(*cols).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    b = batch.select(*cols)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_vehicle_state_stream_equals_batch_twin(spark, payload_dir, tmp_path):
    # A far later event of another vehicle moves the watermark past all rows.
    d = tmp_path / "in"
    d.mkdir()
    for i, name in enumerate(sorted(os.listdir(payload_dir))):
        (d / name).write_text(open(os.path.join(payload_dir, name)).read())
        os.utime(d / name, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    (d / "zz.json").write_text('{"vehicle_id":"VX","zone":"z","status":"enroute","trip_completed":false,'
                               '"timestamp":"2024-02-05T00:00:00+00:00"}\n')
    os.utime(d / "zz.json", (1_700_001_000, 1_700_001_000))
    valid = valid_events(_stream(spark, str(d)), keep=["event_id"]).where("vehicle_id is not null")
    out = str(tmp_path / "state_rows")
    q = (vehicle_state_stream(valid).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    _run(q)
    rows = spark.read.parquet(out).where("vehicle_id <> 'VX'")
    states = rows.where("kind = 'state'")
    final = states.groupBy("vehicle_id").agg(F.max_by(F.struct("status", "idle_since"), "last_event_ts").alias("s"))
    final = final.select("vehicle_id", "s.status", "s.idle_since")

    lake = fx.lake_events(spark, SF_SMALL)
    eps = st.idle_episodes(lake)
    open_eps = eps.where("ended_at IS NULL").select("vehicle_id", "idle_since")
    twin = st.vehicle_latest(lake).join(open_eps, "vehicle_id", "left").select(
        "vehicle_id", "status", F.when(F.col("status") == "idle", F.col("idle_since")).alias("idle_since"))
    assert final.count() == twin.count() > 0
    assert final.exceptAll(twin).count() == 0

    # Alerts for idle runs that closed: same set as the batch rule.
    stream_closed = rows.where("kind = 'alert' and not open").join(
        eps.where("ended_at IS NOT NULL").select("vehicle_id", "idle_since"), ["vehicle_id", "idle_since"])
    batch_closed = eps.where("ended_at IS NOT NULL").where(
        F.unix_micros("ended_at") - F.unix_micros("idle_since") >= 180_000_000).select("vehicle_id", "idle_since")
    assert batch_closed.count() > 0
    assert stream_closed.select("vehicle_id", "idle_since").exceptAll(batch_closed).count() == 0
    assert batch_closed.exceptAll(stream_closed.select("vehicle_id", "idle_since")).count() == 0


def test_out_of_order_row_does_not_roll_state_back(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    import json
    def payload(eid, status, ts):
        return json.dumps({"vehicle_id": "V1", "zone": "z", "status": status, "timestamp": ts,
                           "trip_completed": False, "event_id": eid})
    files = [[payload(1, "idle", "2024-01-01T00:00:00+00:00"), payload(2, "enroute", "2024-01-01T00:10:00+00:00")],
             [payload(3, "idle", "2024-01-01T00:05:00+00:00")],   # older than the seen enroute row
             [payload(4, "idle", "2024-01-01T00:20:00+00:00")]]
    for i, lines in enumerate(files):
        p = d / f"f{i}.json"
        p.write_text("\n".join(lines) + "\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    valid = valid_events(_stream(spark, str(d)), keep=["event_id"])
    out = str(tmp_path / "rows")
    q = (vehicle_state_stream(valid).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    _run(q)
    states = spark.read.parquet(out).where("kind = 'state'").orderBy("last_event_ts").collect()
    assert [str(s.idle_since) for s in states][-1] == "2024-01-01 00:20:00"
    assert all(str(s.last_event_ts) != "2024-01-01 00:05:00" for s in states)


def test_late_rows_are_dropped_by_the_watermark(spark, tmp_path):
    d = tmp_path / "late"
    d.mkdir()
    import json
    base = "2024-01-01T00:{:02d}:00+00:00"
    def payload(minute, vid="V1"):
        return json.dumps({"vehicle_id": vid, "zone": "z", "status": "idle", "trip_completed": False,
                           "timestamp": base.format(minute)})
    # The watermark moves to 00:18 after batch 1, but late rows are judged by
    # the previous batch's watermark, so the late row comes two batches later.
    batches = [[payload(0)], [payload(20)], [payload(21)], [payload(1, "V9")], [payload(40)]]
    for i, lines in enumerate(batches):
        p = d / f"b{i}.json"
        p.write_text("\n".join(lines) + "\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    valid = valid_events(_stream(spark, str(d)), keep=["event_id"])
    q = (app.window_stream(valid, CLOCK, by_zone=False).writeStream.outputMode("update").format("memory")
         .queryName("late_test").option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    _run(q)
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for op in p.get("stateOperators", []))
    assert dropped > 0
    seen = spark.sql("SELECT max(idle_vehicles) AS m FROM late_test WHERE window_start <= '2024-01-01 00:01:00'")
    assert seen.first().m == 1  # V9's late row never raised the old windows to 2


def test_archive_sink_is_exactly_once_and_prunes_days(spark, payload_dir, tmp_path):
    lake = str(tmp_path / "lake")
    cfg = app.StreamConfig(clock=CLOCK, lake=lake, dead_letters=str(tmp_path / "dlq"),
                           zone_metrics="", fleet_metrics="", vehicle_state="", alerts="",
                           checkpoints=str(tmp_path / "ck"), archive_trigger={"availableNow": True})
    for _ in range(2):  # the second start replays nothing: same checkpoint
        _run(app.archive_query(valid_events(_stream(spark, payload_dir), keep=["event_id"]), cfg))
    _run(app.dead_letter_query(app.dead_letters(_stream(spark, payload_dir), keep=["event_id"]), cfg))
    stored = lake_scan(spark, lake)
    expected = fx.lake_events(spark, SF_SMALL)
    assert stored.count() == expected.count()
    assert spark.read.parquet(str(tmp_path / "dlq")).count() == fx.raw_payloads(spark, SF_SMALL).count() - expected.count()
    day = lake_day_scan(spark, lake, 3)
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sim_day" in plan and "= 3)" in plan
    assert day.count() == expected.where(CLOCK.day("event_ts") == 3).count()
    assert lake_day_scan(spark, lake, 999).count() == 0
    assert lake_day_scan(spark, str(tmp_path / "nowhere"), 1).count() == 0


def test_timeout_alerts_a_silent_vehicle(spark, tmp_path):
    import json
    d = tmp_path / "silent"
    d.mkdir()
    def payload(vid, status, minute):
        return json.dumps({"vehicle_id": vid, "zone": "z", "status": status, "trip_completed": False,
                           "timestamp": f"2024-01-01T00:{minute:02d}:00+00:00"})
    batches = [[payload("V1", "idle", 0), payload("V2", "enroute", 0)], [payload("V2", "enroute", 10)],
               [payload("V2", "enroute", 20)]]
    for i, lines in enumerate(batches):
        p = d / f"s{i}.json"
        p.write_text("\n".join(lines) + "\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    valid = valid_events(_stream(spark, str(d)), keep=["event_id"])
    out = str(tmp_path / "rows")
    q = (vehicle_state_stream(valid).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    _run(q)
    alerts = spark.read.parquet(out).where("kind = 'alert'").collect()
    assert [(a.vehicle_id, str(a.alert_at)) for a in alerts] == [("V1", "2024-01-01 00:03:00")]


def test_alerts_close_and_disorder_within_the_watermark_changes_nothing(spark, tmp_path):
    """Rows shuffled by up to 100 s (watermark 120 s): the alerts table equals the batch rule, ``open`` included."""
    import random
    rng = random.Random(11)
    events, t = [], 0
    for _ in range(160):
        t += rng.choice([20, 40, 90, 200])
        events.append((f"V{rng.randrange(4)}", rng.choice(["idle", "idle", "enroute", "on_trip"]), t))
    t += 400
    events.append(("W", "enroute", t))
    arrival = sorted(events, key=lambda e: e[2] + rng.uniform(0, 100) * (e[0] != "W"))
    batches = [arrival[i: i + 12] for i in range(0, len(arrival), 12)]
    folder = _payload_files(tmp_path / "in", batches)
    cfg = app.StreamConfig(clock=CLOCK, lake="", dead_letters="", zone_metrics="", fleet_metrics="",
                           vehicle_state=str(tmp_path / "state"), alerts=str(tmp_path / "alerts"),
                           heartbeats=str(tmp_path / "beats"), checkpoints=str(tmp_path / "ck"), state_trigger={"availableNow": True})
    _run(app.vehicle_state_query(valid_events(_stream(spark, folder), keep=["event_id"]), cfg))
    keys = ["alert_type", "vehicle_id", "message"]
    got = read_upsert_log(spark, cfg.alerts, keys).select(*keys, "created_at", "open")

    rows = spark.createDataFrame([(i, v, s, x) for i, (v, s, x) in enumerate(events)],
                                 "event_id long, vehicle_id string, status string, sec long").withColumn(
        "event_ts", F.timestamp_seconds(F.lit(CLOCK.epoch_us // 1_000_000) + F.col("sec")))
    as_of = F.timestamp_seconds(F.lit(CLOCK.epoch_us // 1_000_000 + t - 120))
    want = st.idle_alerts(st.idle_episodes(rows.where(F.col("event_ts") <= as_of)), as_of, CLOCK).select(*keys, "created_at", "open")
    assert want.where("open").count() > 0 and want.where("not open").count() > 3
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert {r.component for r in spark.read.parquet(cfg.heartbeats).collect()} == {"stream_sink"}
    log = spark.read.parquet(cfg.alerts)
    assert log.where("open").join(log.where("not open"), keys, "left_semi").count() > 0  # some closed after they had opened


def test_a_vehicle_with_many_rows_is_stored_in_few_elements(spark, tmp_path):
    """Two micro-batches of a vehicle with more rows than an element holds: the batch rule's alerts and
    last state, and as many updates of the state store as there are elements, not rows."""
    import random

    from mobility.streaming import state
    rng = random.Random(5)
    events, at = [], 0
    for _ in range(2 * state.CHUNK + 300):
        at += rng.choice([1, 5, 90])
        events.append(("A", rng.choice(["idle", "idle", "idle", "enroute"]), at))
    end = at + 600
    first, second = events[:-100], events[-100:] + [("W", "enroute", end)]
    batches = [first[::2] + first[1::2], second]
    folder = _payload_files(tmp_path / "in", batches)
    cfg = app.StreamConfig(clock=CLOCK, lake="", dead_letters="", zone_metrics="", fleet_metrics="", vehicle_state=str(tmp_path / "s"),
                           alerts=str(tmp_path / "a"), checkpoints=str(tmp_path / "ck"), state_trigger={"availableNow": True})
    query = app.vehicle_state_query(valid_events(_stream(spark, folder), keep=["event_id"]), cfg)
    _run(query)
    begun = next(p for p in query.recentProgress if p["numInputRows"])
    assert begun["numInputRows"] == len(first) > state.CHUNK
    assert begun["stateOperators"][0]["numRowsUpdated"] <= 2 + len(first) // state.CHUNK + 1

    rows = spark.createDataFrame([(i, v, s, sec) for i, (v, s, sec) in enumerate(events)],
                                 "event_id long, vehicle_id string, status string, sec long").withColumn(
        "event_ts", F.timestamp_seconds(F.lit(CLOCK.epoch_us // 1_000_000) + F.col("sec")))
    as_of = F.timestamp_seconds(F.lit(CLOCK.epoch_us // 1_000_000 + end - 120))
    keys = ["alert_type", "vehicle_id", "message"]
    want = st.idle_alerts(st.idle_episodes(rows), as_of, CLOCK).select(*keys, "created_at", "open").collect()
    got = read_upsert_log(spark, cfg.alerts, keys).select(*keys, "created_at", "open").collect()
    assert len(want) > 20 and sorted(map(tuple, got)) == sorted(map(tuple, want))
    last = read_upsert_log(spark, cfg.vehicle_state, ["vehicle_id"]).where("vehicle_id = 'A'").first()
    assert (last.status, last.last_event_ts) == (events[-1][1], datetime(2024, 1, 1) + timedelta(seconds=events[-1][2]))


def test_rows_applied_at_once_give_what_they_give_one_by_one():
    from mobility.streaming.state import Row, Vehicle
    for begin in (Vehicle(), Vehicle("idle", "z", 1, 1, 1, 1, True, 9), Vehicle("enroute", "z", 1, 1)):
        for picks in range(3 ** 4):
            rows = [Row(10 + i, i, ("idle", "enroute", "on_trip")[picks // 3 ** i % 3], "z") for i in range(4)][: picks % 5]
            one = begin
            for row in rows:
                one = one.after(row)
            assert begin.after_all(rows) == one


def test_idle_threshold_is_a_setting(spark, tmp_path):
    folder = _payload_files(tmp_path / "in", [[("A", "idle", 0)], [("B", "enroute", 900)], [("B", "enroute", 1800)]])
    cfg = app.StreamConfig(clock=CLOCK, lake="", dead_letters="", zone_metrics="", fleet_metrics="", vehicle_state=str(tmp_path / "s"),
                           alerts=str(tmp_path / "a"), checkpoints=str(tmp_path / "ck"), state_trigger={"availableNow": True}, idle_minutes=10)
    _run(app.vehicle_state_query(valid_events(_stream(spark, folder), keep=["event_id"]), cfg))
    assert [str(r.created_at) for r in spark.read.parquet(cfg.alerts).collect()] == ["2024-01-01 00:10:00"]


def test_backfill_into_a_streamed_lake_is_read_back(spark, payload_dir, tmp_path):
    from mobility.sinks.files import archive_by_day
    lake = str(tmp_path / "lake")
    cfg = app.StreamConfig(clock=CLOCK, lake=lake, dead_letters="", zone_metrics="", fleet_metrics="", vehicle_state="", alerts="",
                           checkpoints=str(tmp_path / "ck"), archive_trigger={"availableNow": True})
    _run(app.archive_query(valid_events(_stream(spark, payload_dir), keep=["event_id"]), cfg))
    before = lake_scan(spark, lake).count()
    extra = fx.lake_events(spark, SF_SMALL).limit(5).withColumn("event_id", F.col("event_id") + 10**9)
    archive_by_day(extra.withColumn("sim_day", F.lit(77)), lake, CLOCK)
    assert lake_scan(spark, lake).count() == before + 5 and lake_day_scan(spark, lake, 77).count() == 5


def test_multi_query_app_runs_all_queries(spark, payload_dir, tmp_path):
    from mobility.sinks.upsert import read_upsert_log
    r = tmp_path
    once = {"availableNow": True}
    cfg = app.StreamConfig(clock=CLOCK, lake=str(r / "lake"), dead_letters=str(r / "dlq"),
                           zone_metrics=str(r / "zone"), fleet_metrics=str(r / "fleet"),
                           vehicle_state=str(r / "state"), alerts=str(r / "alerts"),
                           checkpoints=str(r / "ck"), source_format="text",
                           source_options={"maxFilesPerTrigger": "1"},
                           archive_trigger=once, window_trigger=once, state_trigger=once)
    queries = app.multi_query_app(spark, cfg, path=payload_dir)
    for query in queries:
        _run(query)
    assert len(queries) == 5
    valid_n = fx.lake_events(spark, SF_SMALL).count()
    assert lake_scan(spark, cfg.lake).count() == valid_n
    observed = [p["observedMetrics"]["ingest"] for p in queries[0].recentProgress
                if "ingest" in p.get("observedMetrics", {})]
    assert sum(o["valid_records"] for o in observed) == valid_n
    assert sum(o["invalid_records"] for o in observed) == 1000 - valid_n
    fleet = read_upsert_log(spark, cfg.fleet_metrics, ["window_start"])
    assert fleet.count() == win.fleet_window_metrics(fx.lake_events(spark, SF_SMALL), CLOCK).count()
    assert read_upsert_log(spark, cfg.vehicle_state, ["vehicle_id"]).count() == 15


def test_upsert_log_replay_is_idempotent(spark, tmp_path):
    from mobility.sinks.upsert import read_upsert_log, write_upsert_batch
    log = str(tmp_path / "log")
    b0 = spark.createDataFrame([("x", 1), ("y", 1)], "k string, v int")
    b1 = spark.createDataFrame([("x", 2)], "k string, v int")
    write_upsert_batch(b0, 0, log)
    write_upsert_batch(b1, 1, log)
    write_upsert_batch(b1, 1, log)  # replayed batch
    assert {r.k: r.v for r in read_upsert_log(spark, log, ["k"]).collect()} == {"x": 2, "y": 1}


def test_append_rows_and_serving_read(spark, tmp_path):
    from mobility.sinks.files import append_rows
    from mobility.sources.tables import serving_read
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1,)], "a int")
    append_rows(df, path)
    append_rows(df, path)
    assert serving_read(spark, path, "parquet").count() == 2


def test_speed_and_batch_layers_share_one_root_served_by_sql(spark, payload_dir, tmp_path):
    """The deployment end to end: stream app -> lake and metric logs; batch job
    on the same root -> profitability and checks; SQL views over all of it."""
    from mobility.__main__ import main
    from mobility.plans.views import register_views, serving_query
    from mobility.sources.expenses import write_landing
    root = tmp_path / "fleet"
    once = {"availableNow": True}
    cfg = app.StreamConfig(clock=CLOCK, lake=str(root / "lake"), dead_letters=str(root / "dead_letters"),
                           zone_metrics=str(root / "zone_metrics"), fleet_metrics=str(root / "fleet_metrics"),
                           vehicle_state=str(root / "vehicle_state"), alerts=str(root / "alerts"),
                           checkpoints=str(root / "checkpoints"), source_format="text",
                           source_options={"maxFilesPerTrigger": "1"},
                           archive_trigger=once, window_trigger=once, state_trigger=once)
    for query in app.multi_query_app(spark, cfg, path=payload_dir):
        _run(query)
    write_landing(fx.expenses(spark, SF_SMALL), str(tmp_path / "landing"))
    main(["--epoch", "2024-01-01", "--day-seconds", "86400", "--root", str(root),
          "reconcile", "--landing", str(tmp_path / "landing")])

    main(["--epoch", "2024-01-01", "--day-seconds", "86400", "--root", str(root), "compact"])
    assert (root / "fleet_metrics_snapshots").exists()
    views = register_views(spark, str(root))
    assert {"rt_zone_metrics", "rt_fleet_metrics", "vehicle_state", "daily_profitability",
            "consistency_checks", "pipeline_heartbeats"} <= set(views)
    assert serving_query(spark, "fleet_latest").count() == 1
    assert serving_query(spark, "zone_latest").select("zone").distinct().count() == 5
    assert serving_query(spark, "report_days").count() == 30
    report = serving_query(spark, "profitability_report", unprofitable_only=True)
    assert report.where("NOT unprofitable").count() == 0
    assert serving_query(spark, "consistency_check", sim_day=3).count() == 1
    # Batch profitability from the streamed lake equals the direct computation.
    from mobility.operators import reconcile as rc
    direct = rc.daily_profitability(rc.trip_summary(fx.lake_events(spark, SF_SMALL).withColumn(
        "sim_day", CLOCK.day("event_ts"))), fx.expenses(spark, SF_SMALL))
    stored = spark.table("daily_profitability").select(*direct.columns)
    assert stored.exceptAll(direct).count() == 0 and direct.exceptAll(stored).count() == 0
    if "alerts" in views:
        assert serving_query(spark, "alerts", vehicle_id="V0001").where("vehicle_id <> 'V0001'").count() == 0


def test_upsert_log_compaction(spark, tmp_path):
    from mobility.sinks.upsert import compact_upsert_log, read_upsert_log, write_upsert_batch
    log, snap = str(tmp_path / "log"), str(tmp_path / "snap")
    schema = "k string, v int"
    write_upsert_batch(spark.createDataFrame([("x", 1), ("y", 1)], schema), 0, log)
    write_upsert_batch(spark.createDataFrame([("x", 2)], schema), 1, log)
    compact_upsert_log(spark, log, ["k"], snap)
    write_upsert_batch(spark.createDataFrame([("y", 3), ("z", 3)], schema), 2, log)
    want = {"x": 2, "y": 3, "z": 3}
    assert {r.k: r.v for r in read_upsert_log(spark, log, ["k"]).collect()} == want
    assert {r.k: r.v for r in read_upsert_log(spark, log, ["k"], snapshot=snap).collect()} == want
    assert compact_upsert_log(spark, log, ["k"], snap) == 2  # folds in batch 2
    assert {r.k: r.v for r in spark.read.parquet(f"{snap}/upto=2").collect()} == want
    assert {r.k: r.v for r in read_upsert_log(spark, log, ["k"], snapshot=snap).collect()} == want


def test_exact_window_stream_equals_batch(spark, payload_dir, tmp_path):
    # A last event far in the future moves the watermark past every window,
    # so append mode emits them all.
    d = tmp_path / "in"
    d.mkdir()
    for i, name in enumerate(sorted(os.listdir(payload_dir))):
        src = os.path.join(payload_dir, name)
        (d / name).write_text(open(src).read())
        os.utime(d / name, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    flush = d / "zz_flush.json"
    flush.write_text('{"vehicle_id":"VX","zone":"flush","status":"idle","trip_completed":false,'
                     '"timestamp":"2030-01-01T00:00:00+00:00"}\n')
    os.utime(flush, (1_700_001_000, 1_700_001_000))
    valid = valid_events(_stream(spark, str(d)), keep=["event_id"])
    out = str(tmp_path / "out")
    q = (app.window_stream(valid, CLOCK, by_zone=True, exact=True).writeStream.outputMode("append")
         .format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    _run(q)
    want = win.zone_window_metrics(fx.lake_events(spark, SF_SMALL), CLOCK)
    got = (spark.read.parquet(out).where("zone <> 'flush'")
           .withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).select(*want.columns))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
