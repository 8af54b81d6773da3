from decimal import Decimal

from pyspark.sql import functions as F

from mobility.functions.clock import SimClock
from mobility.operators.windows import fleet_window_metrics, zone_window_metrics
from tests.conftest import utc

CLOCK = SimClock(epoch=utc(2024, 1, 1), day_seconds=300)
SCHEMA = "vehicle_id string, zone string, status string, trip_completed boolean, fare double, event_ts string"


def _events(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("event_ts", F.col("event_ts").cast("timestamp"))


def test_boundary_event_lands_in_five_windows(spark):
    ev = _events(spark, [("V1", "airport", "idle", False, 0.0, "2024-01-01 00:05:00")])
    starts = sorted(str(r.window_start) for r in zone_window_metrics(ev, CLOCK).collect())
    assert starts == [f"2024-01-01 00:0{m}:00" for m in range(1, 6)]


def test_idle_and_active_in_one_window_count_in_both(spark):
    ev = _events(spark, [("V1", "airport", "idle", False, 0.0, "2024-01-01 00:00:10"),
                         ("V1", "airport", "on_trip", False, 0.0, "2024-01-01 00:00:20")])
    r = zone_window_metrics(ev, CLOCK).where("window_start = '2024-01-01 00:00:00'").first()
    assert (r.active_vehicles, r.idle_vehicles, r.idle_ratio) == (1, 1, 0.5)


def test_null_fare_completions_give_zero_not_nan(spark):
    ev = _events(spark, [("V1", "airport", "idle", True, None, "2024-01-01 00:00:10")])
    r = fleet_window_metrics(ev, CLOCK).where("window_start = '2024-01-01 00:00:00'").first()
    assert r.trips_completed == 1 and r.earnings == Decimal("0.00")


def test_fleet_counts_a_vehicle_once_across_zones(spark):
    ev = _events(spark, [("V1", "airport", "enroute", False, 0.0, "2024-01-01 00:00:10"),
                         ("V1", "downtown", "enroute", False, 0.0, "2024-01-01 00:00:20")])
    r = fleet_window_metrics(ev, CLOCK).where("window_start = '2024-01-01 00:00:00'").first()
    assert r.active_vehicles == 1
    z = zone_window_metrics(ev, CLOCK).where("window_start = '2024-01-01 00:00:00'").collect()
    assert sorted(x.zone for x in z) == ["airport", "downtown"]


def test_window_day_and_hour_of_start(spark):
    ev = _events(spark, [("V1", "airport", "idle", True, 2.5, "2024-01-01 00:07:40")])
    r = fleet_window_metrics(ev, CLOCK).where("window_start = '2024-01-01 00:07:00'").first()
    assert (r.sim_day, r.sim_hour) == (1, 9)  # 120 s into a 300 s day
    assert r.earnings == Decimal("2.50") and r.idle_ratio == 1.0


def test_approx_form_runs_and_matches_small_counts(spark):
    ev = _events(spark, [(f"V{i}", "airport", "idle", False, 0.0, "2024-01-01 00:00:10") for i in range(20)])
    exact = zone_window_metrics(ev, CLOCK).orderBy("window_start").collect()
    approx = zone_window_metrics(ev, CLOCK, exact=False).orderBy("window_start").collect()
    assert len(exact) == len(approx) == 5
    assert all(abs(a.idle_vehicles - e.idle_vehicles) <= 2 for a, e in zip(approx, exact))


def test_per_step_form_equals_direct_form(spark):
    import random
    rnd = random.Random(7)
    rows = [(f"V{rnd.randint(1, 6)}", rnd.choice(["airport", "downtown"]), rnd.choice(["idle", "enroute", "on_trip"]),
             rnd.random() < 0.2, rnd.choice([None, 3.5, 12.25]),
             f"2024-01-01 00:{rnd.randint(0, 20):02d}:{rnd.randint(0, 59):02d}") for _ in range(300)]
    ev = _events(spark, rows)
    for size, slide in [("5 minutes", "1 minute"), ("10 minutes", "4 minutes")]:
        a = zone_window_metrics(ev, CLOCK, size, slide, per_step=True)
        b = zone_window_metrics(ev, CLOCK, size, slide, per_step=False)
        assert a.count() == b.count() > 0
        assert a.exceptAll(b).count() == 0
