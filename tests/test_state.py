import pytest
from pyspark.sql import functions as F

from mobility.functions.clock import SimClock
from mobility.operators.state import (idle_alerts, idle_episodes, state_from_latest, vehicle_latest,
                                      vehicle_state_step)
from mobility.sinks.upsert import keyed_upsert
from tests.conftest import utc

CLOCK = SimClock(epoch=utc(2024, 1, 1), day_seconds=300)
SCHEMA = "event_id long, vehicle_id string, status string, zone string, event_ts string"


def _events(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("event_ts", F.col("event_ts").cast("timestamp"))


def test_idle_trip_idle_gives_two_episodes(spark):
    ev = _events(spark, [(1, "V1", "idle", "a", "2024-01-01 00:00:00"),
                         (2, "V1", "idle", "a", "2024-01-01 00:01:00"),
                         (3, "V1", "on_trip", "a", "2024-01-01 00:02:00"),
                         (4, "V1", "idle", "a", "2024-01-01 00:03:00")])
    eps = sorted(idle_episodes(ev).collect(), key=lambda r: r.idle_since)
    assert [(str(e.idle_since), e.idle_events, str(e.ended_at)) for e in eps] == [
        ("2024-01-01 00:00:00", 2, "2024-01-01 00:02:00"), ("2024-01-01 00:03:00", 1, "None")]


def test_episodes_span_scan_buckets(spark):
    # Rows far apart fall in different hour buckets; the carry must join them.
    ev = _events(spark, [(1, "V1", "on_trip", "a", "2024-01-01 00:00:00"),
                         (2, "V1", "idle", "a", "2024-01-01 03:00:00"),
                         (3, "V1", "idle", "a", "2024-01-01 07:00:00"),
                         (4, "V1", "enroute", "a", "2024-01-01 09:00:00")])
    (e,) = idle_episodes(ev).collect()
    assert e.idle_events == 2 and str(e.idle_since) == "2024-01-01 03:00:00"
    assert str(e.ended_at) == "2024-01-01 09:00:00"


def test_silent_vehicle_alerts_at_as_of(spark):
    ev = _events(spark, [(1, "V1", "idle", "a", "2024-01-01 00:00:00")])
    eps = idle_episodes(ev)
    early = idle_alerts(eps, F.lit("2024-01-01 00:02:59").cast("timestamp"), CLOCK)
    late = idle_alerts(eps, F.lit("2024-01-01 00:03:00").cast("timestamp"), CLOCK)
    assert early.count() == 0
    (a,) = late.collect()
    assert a.message == "Vehicle V1 idle since 2024-01-01T00:00:00+00:00" and a.open
    assert a.alert_type == "VEHICLE_IDLE" and a.severity == "warning"
    assert str(a.created_at) == "2024-01-01 00:03:00"


def test_alert_message_keeps_microseconds(spark):
    ev = _events(spark, [(1, "V1", "idle", "a", "2024-01-01 00:00:00.000123")])
    (a,) = idle_alerts(idle_episodes(ev), F.lit("2024-01-02").cast("timestamp"), CLOCK).collect()
    assert a.message.endswith("2024-01-01T00:00:00.000123+00:00")


def test_latest_tie_break_by_event_id(spark):
    ev = _events(spark, [(1, "V1", "idle", "a", "2024-01-01 00:00:00"),
                         (2, "V1", "on_trip", "b", "2024-01-01 00:00:00")])
    r = vehicle_latest(ev).first()
    assert (r.status, r.zone) == ("on_trip", "b")


def test_state_step_keeps_idle_since_through_idle_run(spark):
    prev = state_from_latest(vehicle_latest(_events(spark, [(1, "V1", "idle", "a", "2024-01-01 00:00:00"),
                                                            (2, "V2", "on_trip", "a", "2024-01-01 00:00:00"),
                                                            (3, "V3", "idle", "a", "2024-01-01 00:00:00")])))
    latest = vehicle_latest(_events(spark, [(4, "V1", "idle", "b", "2024-01-01 00:05:00"),
                                            (5, "V2", "idle", "a", "2024-01-01 00:05:00")]))
    rows = {r.vehicle_id: r for r in vehicle_state_step(prev, latest).collect()}
    assert str(rows["V1"].idle_since) == "2024-01-01 00:00:00" and rows["V1"].zone == "b"
    assert str(rows["V2"].idle_since) == "2024-01-01 00:05:00"
    assert str(rows["V3"].last_event_ts) == "2024-01-01 00:00:00"  # untouched


UP = "k string, a int, b int"


def test_upsert_default_updates_all_columns(spark):
    t = spark.createDataFrame([("x", 1, 1), ("y", 2, 2)], UP)
    u = spark.createDataFrame([("x", 9, 9), ("z", 3, 3)], UP)
    rows = {r.k: (r.a, r.b) for r in keyed_upsert(t, u, ["k"]).collect()}
    assert rows == {"x": (9, 9), "y": (2, 2), "z": (3, 3)}


def test_upsert_subset_and_insert_only(spark):
    t = spark.createDataFrame([("x", 1, 1)], UP)
    u = spark.createDataFrame([("x", 9, 9), ("z", 3, 3)], UP)
    assert {r.k: (r.a, r.b) for r in keyed_upsert(t, u, ["k"], ["a"]).collect()} == {"x": (9, 1), "z": (3, 3)}
    assert {r.k: (r.a, r.b) for r in keyed_upsert(t, u, ["k"], []).collect()} == {"x": (1, 1), "z": (3, 3)}


def test_upsert_empty_updates_is_noop(spark):
    t = spark.createDataFrame([("x", 1, 1)], UP)
    assert [tuple(r) for r in keyed_upsert(t, spark.createDataFrame([], UP), ["k"]).collect()] == [("x", 1, 1)]


def test_upsert_duplicate_keys_raise(spark):
    t = spark.createDataFrame([("x", 1, 1)], UP)
    u = spark.createDataFrame([("x", 2, 2), ("x", 3, 3)], UP)
    with pytest.raises(Exception, match="duplicate key"):
        keyed_upsert(t, u, ["k"]).collect()


def test_state_step_idle_trip_idle_in_one_batch(spark, tmp_path):
    import json

    import pytest as _pytest

    from mobility.operators.ingest import valid_events
    from mobility.streaming import app
    from mobility.streaming.state import vehicle_state_stream

    with _pytest.raises(ValueError):
        vehicle_state_stream(_events(spark, [(1, "V1", "idle", "a", "2024-01-01 00:00:00")]))

    def payload(vid, status, zone, minute):
        return json.dumps({"vehicle_id": vid, "zone": zone, "status": status, "trip_completed": False,
                           "timestamp": f"2024-01-01T00:{minute:02d}:00+00:00"})
    d = tmp_path / "in"
    d.mkdir()
    (d / "one.json").write_text("\n".join([
        payload("V1", "idle", "a", 0), payload("V1", "idle", "a", 4), payload("V1", "enroute", "a", 5),
        payload("V1", "idle", "b", 6), payload("V2", "idle", "a", 0), payload("V2", "on_trip", "a", 1)]) + "\n")
    raw = app.raw_events(spark, "text", {}, str(d))
    valid = valid_events(app.decoded_stream(raw), keep=["event_id"])
    out = str(tmp_path / "out")
    q = (vehicle_state_stream(valid).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    rows = spark.read.parquet(out).collect()
    states = {r.vehicle_id: r for r in rows if r.kind == "state"}
    alerts = [(r.vehicle_id, str(r.idle_since), r.open) for r in rows if r.kind == "alert"]
    assert str(states["V1"].idle_since) == "2024-01-01 00:06:00" and states["V1"].zone == "b"
    assert states["V2"].idle_since is None and states["V2"].status == "on_trip"
    assert alerts == [("V1", "2024-01-01 00:00:00", False)]  # 5 min run closed; V2's 1 min run did not alert
