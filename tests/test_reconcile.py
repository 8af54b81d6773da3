from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mobility.operators import reconcile as rc
from mobility.sources.expenses import expenses_scan, landing_files

TRIP_SCHEMA = "vehicle_id string, sim_day int, trips int, earnings decimal(12,2)"
EXP_SCHEMA = ("vehicle_id string, sim_day int, fuel_cost decimal(10,2), maintenance_cost decimal(10,2), "
              "distance_covered decimal(10,2), service_flag boolean")
EVENT_SCHEMA = "vehicle_id string, trip_id string, fare double, trip_completed boolean, sim_day int"


def _land(tmp_path, days):
    for d in days:
        (tmp_path / f"expenses_day_{d}.csv").write_text("vehicle_id\n")
    return str(tmp_path)


def _ledger(spark, days):
    return spark.createDataFrame([(d,) for d in days], "sim_day int")


def test_pending_days_over_a_gappy_landing_zone(spark, tmp_path):
    # Days 4, 11 and 12 landed out of order beside files of other names; 11 is
    # done, and the ledger knows a day (9) that never landed.
    (tmp_path / "expenses_day_x.csv").write_text("junk\n")
    (tmp_path / "notes.csv").write_text("junk\n")
    listing = landing_files(spark, _land(tmp_path, (12, 4, 11)))
    ledger = _ledger(spark, [11, 9, 11])
    assert sorted(r.sim_day for r in rc.pending_days(listing, ledger).collect()) == [4, 12]
    assert [r.next_day for r in rc.next_pending_day(listing, ledger).collect()] == [4]
    assert [r.next_day for r in rc.next_pending_day(listing, _ledger(spark, [4, 11, 12])).collect()] == [None]


def test_expense_files_are_read_by_their_own_headers(spark, tmp_path):
    (tmp_path / "expenses_day_6.csv").write_text(
        "vehicle_id,fuel_cost,maintenance_cost,distance_covered,service_flag\nV31,10.25,3,77.7,no\nV32,8,0,15,YES\n")
    (tmp_path / "expenses_day_7.csv").write_text(  # other order, an extra column
        "note,maintenance_cost,service_flag,vehicle_id,distance_covered,fuel_cost\nx,4.5,1,V31,12,20\ny,6,False,V33,0,9.99\n")
    (tmp_path / "expenses_day_8.csv").write_text("fuel_cost,vehicle_id\n2,V31\n")  # columns missing
    rows = {(r.sim_day, r.vehicle_id): r for r in expenses_scan(spark, str(tmp_path)).collect()}
    got = {k: (r.fuel_cost, r.maintenance_cost, r.distance_covered, r.service_flag) for k, r in rows.items()}
    assert got == {
        (6, "V31"): (Decimal("10.25"), Decimal("3"), Decimal("77.70"), False), (6, "V32"): (Decimal("8"), 0, Decimal("15"), True),
        (7, "V31"): (Decimal("20"), Decimal("4.50"), Decimal("12"), True), (7, "V33"): (Decimal("9.99"), Decimal("6"), 0, False),
        (8, "V31"): (Decimal("2"), 0, 0, False)}


def test_numbers_that_do_not_fit_are_rejected_not_fatal(spark, tmp_path):
    (tmp_path / "expenses_day_2.csv").write_text(
        "vehicle_id,fuel_cost,maintenance_cost,distance_covered,service_flag\n"
        "V1,999999999,1,1,no\nV2,1,1e400,1,no\nV3,1,1,-1e12,no\nV4,99999999.99,1,1,no\n")
    good, rejects = rc.validate_expenses(expenses_scan(spark, str(tmp_path)))
    assert [r.vehicle_id for r in good.collect()] == ["V4"]
    assert sorted((r.vehicle_id, r.reject_reason) for r in rejects.collect()) == [
        ("V1", "fuel_cost_out_of_range"), ("V2", "maintenance_cost_out_of_range"), ("V3", "distance_out_of_range")]


def test_expense_text_edge_cases(spark, tmp_path):
    (tmp_path / "expenses_day_4.csv").write_text(
        "vehicle_id,fuel_cost,maintenance_cost,distance_covered,service_flag\n"
        "V1,abc,,NA,Yes\n"
        "V2,1d,0x1p3,NaN, true \n"
        "V3, 12 ,1e1,-5,1\n"
        "NA,1,1,1,no\n")
    rows = {r.vehicle_id: r for r in expenses_scan(spark, str(tmp_path)).collect()}
    assert rows["V1"].fuel_cost == 0 and rows["V1"].maintenance_cost == 0 and rows["V1"].distance_covered == 0
    assert rows["V1"].service_flag is True
    assert rows["V2"].fuel_cost == 0 and rows["V2"].maintenance_cost == 0 and rows["V2"].distance_covered == 0
    assert rows["V2"].service_flag is False  # no trimming
    assert rows["V3"].fuel_cost == 12 and rows["V3"].maintenance_cost == 10 and rows["V3"].distance_covered == -5
    assert rows["V3"].service_flag is True
    assert None in rows  # "NA" id reads as missing


def test_wide_files_and_odd_lines_are_read_by_place_and_name(spark, tmp_path):
    names = [f"extra_{i}" for i in range(36)] + ["distance_covered", "service_flag", "vehicle_id", "fuel_cost", "maintenance_cost"]
    (tmp_path / "expenses_day_1.csv").write_text(  # the five needed columns stand beyond the thirty-second
        ",".join(names) + "\n" + ",".join(["x"] * 36) + ",12.5,yes,V1,3,4\n")
    (tmp_path / "expenses_day_2.csv").write_text(  # a note that reads like a header; quotes, a comma and an empty first cell
        "note,vehicle_id,fuel_cost,maintenance_cost,distance_covered,service_flag\n"
        "vehicle_id,V2,1,2,3,no\n\n\"a, \"\"b\"\"\",V3,5,6,7,\"Yes\"\n,V4,8,9,10,1\n")
    rows = {r.vehicle_id: (r.sim_day, float(r.fuel_cost), float(r.maintenance_cost), float(r.distance_covered), r.service_flag)
            for r in expenses_scan(spark, str(tmp_path)).collect()}
    assert rows == {"V1": (1, 3, 4, 12.5, True), "V2": (2, 1, 2, 3, False), "V3": (2, 5, 6, 7, True), "V4": (2, 8, 9, 10, True)}


def test_rows_of_files_that_lack_a_column_are_rejected_with_the_reason(spark, tmp_path):
    (tmp_path / "expenses_day_3.csv").write_text("vehicle_id,fuel_cost,distance_covered\nV1,2,3\n")
    (tmp_path / "expenses_day_4.csv").write_text("fuel_cost,maintenance_cost,distance_covered,service_flag,vehicle_id\n1,2,3,no,V1\n")
    good, rejects = rc.validate_expenses(expenses_scan(spark, str(tmp_path), missing_columns=True))
    assert [(r.sim_day, r.vehicle_id) for r in good.collect()] == [(4, "V1")]
    assert [(r.sim_day, r.reject_reason) for r in rejects.collect()] == [(3, "missing_columns:maintenance_cost,service_flag")]
    assert "missing_columns" not in good.columns


def test_header_only_file_gives_no_rows(spark, tmp_path):
    (tmp_path / "expenses_day_9.csv").write_text("vehicle_id,fuel_cost,maintenance_cost,distance_covered,service_flag\n")
    assert expenses_scan(spark, str(tmp_path)).count() == 0


def test_validate_expenses_splits_rejects(spark):
    df = spark.createDataFrame([
        ("V1", 1, Decimal("1"), Decimal("1"), Decimal("1"), False),
        ("V2", 1, Decimal("-1"), Decimal("1"), Decimal("1"), False),
        ("V3", 1, Decimal("1"), Decimal("1"), Decimal("1"), False),
        ("V3", 1, Decimal("2"), Decimal("1"), Decimal("1"), False),
        (None, 1, Decimal("1"), Decimal("1"), Decimal("1"), False),
    ], EXP_SCHEMA)
    good, rejects = rc.validate_expenses(df)
    assert [r.vehicle_id for r in good.collect()] == ["V1"]
    reasons = sorted((r.vehicle_id or "", r.reject_reason) for r in rejects.collect())
    assert reasons == [("", "missing_vehicle_id"), ("V2", "negative_fuel_cost"),
                       ("V3", "duplicate_key"), ("V3", "duplicate_key")]


def test_trip_summary_over_vehicles_and_days(spark):
    ev = spark.createDataFrame([
        ("V7", "a", 4.25, True, 2), ("V7", "a", 99.0, False, 2), ("V7", "b", 0.5, True, 2), ("V7", "c", 3.0, True, 3),
        ("V9", "d", 12.0, True, 2), ("V9", None, 1.0, True, 2), ("V9", "e", 50.0, None, 2), (None, "f", 7.0, True, 2),
    ], EVENT_SCHEMA)
    got = {(r.vehicle_id, r.sim_day): (r.trips, r.earnings) for r in rc.trip_summary(ev).collect()}
    assert got == {("V7", 2): (2, Decimal("4.75")), ("V7", 3): (1, Decimal("3.00")), ("V9", 2): (1, Decimal("13.00"))}


def test_sums_may_outgrow_a_single_fare(spark):
    ev = spark.createDataFrame([("V1", f"t{i}", 9_999_999_999.99, True, 0) for i in range(12)], EVENT_SCHEMA)
    r = rc.trip_summary(ev).first()
    assert r.trips == 12 and r.earnings == Decimal("119999999999.88")


def test_no_trips_give_no_summary(spark):
    assert rc.trip_summary(spark.createDataFrame([("V1", "t", 1.0, False, 0)], EVENT_SCHEMA)).count() == 0


def test_profitability_of_all_kinds_of_rows_at_once(spark):
    d = Decimal
    trips = spark.createDataFrame([("V5", 1, 4, d("30.50")), ("V5", 2, 1, d("2")), ("V6", 1, 2, d("9.99"))], TRIP_SCHEMA)
    exp = spark.createDataFrame([
        ("V5", 1, d("10"), d("0.25"), d("40.5"), False), ("V6", 1, d("9"), d("1.99"), d("11"), True),
        ("V8", 2, None, d("6"), d("0"), None)], EXP_SCHEMA)
    got = {(r.vehicle_id, r.sim_day): r for r in rc.daily_profitability(trips, exp).collect()}
    assert set(got) == {("V5", 1), ("V5", 2), ("V6", 1), ("V8", 2)}
    both, no_costs, loss, no_trips = got["V5", 1], got["V5", 2], got["V6", 1], got["V8", 2]
    assert both.profit == d("20.25") and not both.unprofitable and both.profit_per_km == pytest.approx(0.5)
    assert (no_costs.profit, no_costs.unprofitable, no_costs.has_expenses, no_costs.service_flag) == (None, False, False, False)
    assert loss.profit == d("-1.00") and loss.unprofitable and loss.cost_per_km == pytest.approx(10.99 / 11)
    assert no_trips.trips == 0 and no_trips.earnings == 0 and no_trips.profit == d("-6.00") and no_trips.profit_per_km is None


def test_threshold_is_strict(spark):
    trips = spark.createDataFrame([("V1", 1, 1, Decimal("10"))], TRIP_SCHEMA)
    exp = spark.createDataFrame([("V1", 1, Decimal("5"), Decimal("0"), Decimal("1"), False)], EXP_SCHEMA)
    assert rc.daily_profitability(trips, exp, threshold=5.0).first().unprofitable is False
    assert rc.daily_profitability(trips, exp, threshold=5.01).first().unprofitable is True


def test_consistency_zero_batch_and_one_sided_days(spark):
    speed = spark.createDataFrame([(1, 3, Decimal("9")), (2, 1, Decimal("5"))],
                                  "sim_day int, speed_trips bigint, speed_earnings decimal(12,2)")
    batch = spark.createDataFrame([(1, 3, Decimal("0")), (3, 2, Decimal("4"))],
                                  "sim_day int, batch_trips bigint, batch_earnings decimal(12,2)")
    rows = {r.sim_day: r for r in rc.consistency_check(speed, batch).collect()}
    assert rows[1].earnings_delta_pct is None  # batch earnings 0
    assert rows[2].batch_trips == 0 and rows[2].earnings_delta_pct is None
    assert rows[3].speed_trips == 0 and rows[3].earnings_delta_pct == pytest.approx(100.0)


def test_speed_totals_keep_only_aligned_windows(spark):
    fm = spark.createDataFrame([
        ("2024-01-01 00:00:00", "2024-01-01 00:05:00", 0, 2, Decimal("4")),
        ("2024-01-01 00:01:00", "2024-01-01 00:06:00", 0, 7, Decimal("7")),
        ("2024-01-01 00:05:00", "2024-01-01 00:10:00", 0, 1, Decimal("1")),
    ], "ws string, we string, sim_day int, trips_completed int, earnings decimal(12,2)").select(
        F.col("ws").cast("timestamp").alias("window_start"), F.col("we").cast("timestamp").alias("window_end"),
        "sim_day", "trips_completed", "earnings")
    r = rc.speed_day_totals(fm).first()
    assert r.speed_trips == 3 and r.speed_earnings == Decimal("5.00")
