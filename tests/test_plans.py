"""Plan-level checks, the batch job end to end, the report text, the registry."""
import re
from decimal import Decimal
from pathlib import Path

from pyspark.sql import functions as F

import __spark_entry__ as entry
from mobility.operators import reconcile as rc
from mobility.operators import windows as win
from mobility.plans import queries as q
from mobility.plans import reconciliation
from mobility.sinks.files import archive_by_day
from mobility.sinks.report import NO_CHECK, daily_report
from mobility.plans.oracle_sql import ORACLES
from mobility.plans.queries import REGISTRY
from mobility.sinks.upsert import write_upsert_batch
from mobility.sources import fixtures as fx
from mobility.sources.expenses import write_landing
from tests.conftest import SF_SMALL

PKG = Path(__file__).resolve().parent.parent / "mobility"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_driver_collect_in_package_code():
    pattern = re.compile(r"\.(collect|toPandas|take|head|first|toLocalIterator)\(|localCheckpoint")
    hits = [f"{p}:{i}" for p in PKG.rglob("*.py") if "llm" not in p.parts  # has its own test
            for i, line in enumerate(p.read_text().splitlines(), 1) if pattern.search(line) and "# bounded:" not in line]
    assert hits == []


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == rc.PROFIT_COLUMNS


def test_every_exact_query_has_an_oracle():
    assert set(ORACLES) == set(REGISTRY) - {"window_distinct_approx"}
    assert set(REGISTRY) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_window_plan_expands_once(spark):
    plan = _plan(win.zone_window_metrics(fx.lake_events(spark, SF_SMALL), fx.FIXTURE_CLOCK))
    assert plan.count("Expand") == 1


def test_scan_prunes_columns_and_unused_trip_numbering(spark):
    plan = _plan(q.zone_metrics(spark, SF_SMALL))
    assert "Window " not in plan  # trip_id is unused, so the per-vehicle scan is dropped
    assert "props" not in plan    # only the needed columns are read


def test_top_unprofitable_limits_before_the_shuffle(spark):
    plan = _plan(q.top_unprofitable(spark, SF_SMALL))
    assert "WindowGroupLimit" in plan


def test_report_lines(spark):
    profit = spark.createDataFrame([("V0001", 7, 0, Decimal("0"), None, None, None, None, None, None,
                                     False, False, False)],
                                   "vehicle_id string, sim_day int, trips int, earnings decimal(12,2), "
                                   "fuel_cost decimal(10,2), maintenance_cost decimal(10,2), "
                                   "distance_covered decimal(10,2), profit decimal(12,2), profit_per_km double, "
                                   "cost_per_km double, unprofitable boolean, service_flag boolean, "
                                   "has_expenses boolean")
    check = spark.createDataFrame([], "sim_day int, speed_trips bigint, batch_trips bigint, "
                                      "speed_earnings decimal(12,2), batch_earnings decimal(12,2), "
                                      "earnings_delta_pct double")
    lines = [r.line for r in daily_report(profit, check, F.lit("2024-01-01").cast("timestamp"))
             .orderBy("line_no").collect()]
    assert lines[0] == "# Daily Fleet Profitability Report -- Sim Day 7"
    assert lines[2] == "Generated: 2024-01-01T00:00:00.000000+00:00"
    assert NO_CHECK in lines
    assert "- Total earnings (batch): 0.00" in lines and "- Unprofitable vehicles: 0" in lines


def test_batch_job_end_to_end(spark, tmp_path):
    clock = fx.FIXTURE_CLOCK
    lake = fx.lake_events(spark, SF_SMALL)
    root = tmp_path
    archive_by_day(lake, str(root / "lake"), clock)
    write_landing(fx.expenses(spark, SF_SMALL), str(root / "landing"))
    write_upsert_batch(win.fleet_window_metrics(lake, clock).withColumn(
        "window_start", F.col("window_start").cast("timestamp")).withColumn(
        "window_end", F.col("window_end").cast("timestamp")), 0, str(root / "fleet"))
    cfg = reconciliation.BatchConfig(
        clock=clock, lake=str(root / "lake"), landing=str(root / "landing"), fleet_metrics=str(root / "fleet"),
        profitability=str(root / "profit"), expense_rejects=str(root / "rejects"),
        consistency=str(root / "check"), reports=str(root / "reports"), heartbeats=str(root / "beats"))
    check = reconciliation.run(spark, cfg, generated_at=F.lit("2024-02-01").cast("timestamp"))
    assert check.count() == 30
    want = q.profitability(spark, SF_SMALL)
    got = spark.read.parquet(cfg.profitability).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert spark.read.parquet(cfg.consistency).select(*q._check(spark, SF_SMALL).columns) \
        .exceptAll(q._check(spark, SF_SMALL)).count() == 0
    day0 = (root / "reports" / "sim_day=0")
    text = "".join(p.read_text() for p in sorted(day0.glob("part-*")))
    assert text.startswith("# Daily Fleet Profitability Report -- Sim Day 0\n")
    assert "## Top unprofitable vehicles" in text
    # Nothing pending any more; a second run is a no-op on the same days.
    assert reconciliation.run(spark, cfg).count() == 0


def test_rerunning_a_day_replaces_only_that_day(spark, tmp_path):
    clock = fx.FIXTURE_CLOCK
    lake = fx.lake_events(spark, SF_SMALL)
    archive_by_day(lake, str(tmp_path / "lake"), clock)
    write_landing(fx.expenses(spark, SF_SMALL), str(tmp_path / "landing"))
    write_upsert_batch(win.fleet_window_metrics(lake, clock).withColumn(
        "window_start", F.col("window_start").cast("timestamp")).withColumn(
        "window_end", F.col("window_end").cast("timestamp")), 0, str(tmp_path / "fleet"))
    names = ["profit", "rejects", "check", "reports", "beats"]
    cfg = reconciliation.BatchConfig(clock, str(tmp_path / "lake"), str(tmp_path / "landing"),
                                     str(tmp_path / "fleet"), *[str(tmp_path / n) for n in names])
    reconciliation.run(spark, cfg, days=[3, 4])
    before = spark.read.parquet(cfg.profitability)
    n3, n4 = before.where("sim_day = 3").count(), before.where("sim_day = 4").count()
    # Late data for day 3: the archive of that day is replaced and day 3 re-run.
    archive_by_day(lake.where(clock.day("event_ts") == 3).limit(5), cfg.lake, clock)
    reconciliation.run(spark, cfg, days=[3])
    after = spark.read.parquet(cfg.profitability)
    assert after.where("sim_day = 4").count() == n4          # untouched
    assert after.where("sim_day = 3").count() <= n3          # replaced, not appended
    assert after.groupBy("vehicle_id", "sim_day").count().where("count > 1").count() == 0


def test_approx_window_counts_stay_within_error_bound(spark):
    lake = fx.lake_events(spark, "/root/testdata/sf0.01")
    exact = win.zone_window_metrics(lake, fx.FIXTURE_CLOCK)
    approx = win.zone_window_metrics(lake, fx.FIXTURE_CLOCK, exact=False)
    j = exact.alias("e").join(approx.alias("a"), ["window_start", "zone"])
    err = j.select(F.abs(F.col("a.idle_vehicles") - F.col("e.idle_vehicles")).alias("d"),
                   F.col("e.idle_vehicles").alias("n"))
    stats = err.agg(F.count("*").alias("rows"), F.max(F.col("d") / F.greatest("n", F.lit(1))).alias("worst"),
                    F.sum("d").alias("abs_err"), F.sum("n").alias("total")).first()
    assert stats.rows == exact.count()
    assert stats.abs_err <= 0.05 * stats.total
    assert stats.worst <= 0.5


def test_report_with_check_leaves_the_broadcast_to_measured_sizes(spark):
    days = spark.range(3).select(F.col("id").cast("int").alias("sim_day"))
    check = days.selectExpr("sim_day", "1 AS speed_trips", "1 AS batch_trips", "1 AS speed_earnings", "1 AS batch_earnings",
                            "0d AS earnings_delta_pct")
    assert "ResolvedHint" not in rc.report_with_check(days, check)._jdf.queryExecution().analyzed().toString()


def _batch_config(root):
    names = ["lake", "landing", "fleet", "profit", "rejects", "check", "reports", "beats"]
    return reconciliation.BatchConfig(fx.FIXTURE_CLOCK, *[str(root / n) for n in names])


def test_batch_job_reads_only_the_days_asked_for(spark, tmp_path, monkeypatch):
    """One lake partition and one day's files for ``days=[3]``; the same rows as a run over all days."""
    cfg = _batch_config(tmp_path)
    lake = fx.lake_events(spark, SF_SMALL).where(fx.FIXTURE_CLOCK.day("event_ts") < 6)
    archive_by_day(lake, cfg.lake, cfg.clock)
    write_landing(fx.expenses(spark, SF_SMALL).where("sim_day < 6"), cfg.landing)
    write_upsert_batch(win.fleet_window_metrics(lake, cfg.clock).withColumn(
        "window_start", F.col("window_start").cast("timestamp")).withColumn(
        "window_end", F.col("window_end").cast("timestamp")), 0, cfg.fleet_metrics)
    read = {}
    for name in ("lake_scan", "expenses_scan"):
        def spied(*args, _name=name, _scan=getattr(reconciliation, name)):
            read[_name] = (args, _scan(*args))
            return read[_name][1]
        monkeypatch.setattr(reconciliation, name, spied)
    reconciliation.run(spark, cfg, days=[3])
    files = read["expenses_scan"][0][1]
    assert files and all("expenses_day_3.csv" in f for f in files)
    plan = _plan(read["lake_scan"][1].where(F.col("sim_day").isin([3])))
    assert "PartitionFilters: [isnotnull(sim_day" in plan and "= 3)" in plan
    alone = sorted(map(str, spark.read.parquet(cfg.profitability).drop("generated_at").collect()))
    assert alone and {r.sim_day for r in spark.read.parquet(cfg.profitability).collect()} == {3}

    check = reconciliation.run(spark, cfg)  # the pending ones: all but 3
    assert sorted(r.sim_day for r in check.collect()) == [0, 1, 2, 4, 5]
    stored = spark.read.parquet(cfg.profitability).drop("generated_at")
    assert sorted(map(str, stored.where("sim_day = 3").collect())) == alone
    assert sorted(r.sim_day for r in spark.read.parquet(cfg.ledger).collect()) == [0, 1, 2, 3, 4, 5]
    assert spark.read.parquet(cfg.expenses).count() == fx.expenses(spark, SF_SMALL).where("sim_day < 6").count()


def test_a_landed_day_without_rows_is_processed_once(spark, tmp_path):
    cfg = _batch_config(tmp_path)
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "expenses_day_2.csv").write_text(
        "vehicle_id,fuel_cost,maintenance_cost,distance_covered,service_flag\n")
    write_upsert_batch(spark.createDataFrame([], "window_start timestamp, window_end timestamp, sim_day int, "
                                                 "trips_completed int, earnings decimal(20,2)"), 0, cfg.fleet_metrics)
    assert [d for d, _ in [reconciliation._days_to_run(spark, cfg, None)]] == [[2]]
    reconciliation.run(spark, cfg)
    assert reconciliation._days_to_run(spark, cfg, None)[0] == []
    beats = spark.read.parquet(cfg.heartbeats)
    assert [r.detail for r in beats.collect()] == ["day 2"]
    from mobility.operators import quality
    for name in ("stream_sink", "batch_sim"):
        from mobility.sinks.files import heartbeat
        heartbeat(spark, cfg.heartbeats, name, "test")
    limits = quality.thresholds_frame(spark, {"stream_sink": 60, "batch_sim": 600, "batch_reconcile": 900})
    health = quality.pipeline_health(spark.read.parquet(cfg.heartbeats), limits, F.current_timestamp()).collect()
    assert {r.overall for r in health} == {"ok"} and len(health) == 3


def test_wide_vehicle_ids_stay_apart(spark, tmp_path):
    """Vehicles 999, 9999 and 14990 through the fixture: three vehicles, equal totals."""
    ids = [998, 9998, 14989]
    ev = spark.createDataFrame([(i * 100, u, "purchase", 5.0, f"2024-01-0{1 + i % 2} 10:00:00") for i, u in enumerate(ids, 1)],
                               "event_id long, user_id long, event_type string, value double, t string").select(
        "event_id", "user_id", "event_type", "value", F.col("t").cast("timestamp_ntz").alias("ts"))
    ev.write.parquet(str(tmp_path / "events.parquet"))
    li = spark.createDataFrame([(u, 10.0, "R", "1995-01-02") for u in ids * 2],
                               "l_suppkey long, l_quantity double, l_returnflag string, d string").select(
        "l_suppkey", "l_quantity", "l_returnflag", F.col("d").cast("date").alias("l_shipdate"))
    li.write.parquet(str(tmp_path / "lineitem.parquet"))
    vehicles = {r.vehicle_id for r in fx.lake_events(spark, str(tmp_path)).collect()}
    assert vehicles == {"V0999", "V9999", "V14990"}
    exp = fx.expenses(spark, str(tmp_path))
    assert exp.count() == exp.select("vehicle_id", "sim_day").distinct().count() == 3
    profit = q.profitability(spark, str(tmp_path))
    batch = rc.batch_day_totals(profit).agg(F.sum("batch_trips"), F.sum("batch_earnings")).first()
    speed = rc.speed_day_totals(q.fleet_metrics(spark, str(tmp_path))).agg(F.sum("speed_trips"), F.sum("speed_earnings")).first()
    assert tuple(batch) == tuple(speed) == (3, Decimal("15.00"))


def test_cli_reconcile_runs_pending_days(spark, tmp_path):
    from mobility.__main__ import main, parser
    args = parser().parse_args(["--epoch", "2024-01-01", "--day-seconds", "86400", "--root", str(tmp_path),
                                "reconcile", "--landing", str(tmp_path / "landing"), "--day", "2"])
    assert args.day == [2] and args.command == "reconcile"
    clock = fx.FIXTURE_CLOCK
    lake = fx.lake_events(spark, SF_SMALL)
    archive_by_day(lake, str(tmp_path / "lake"), clock)
    write_landing(fx.expenses(spark, SF_SMALL), str(tmp_path / "landing"))
    write_upsert_batch(win.fleet_window_metrics(lake, clock).withColumn(
        "window_start", F.col("window_start").cast("timestamp")).withColumn(
        "window_end", F.col("window_end").cast("timestamp")), 0, str(tmp_path / "fleet_metrics"))
    main(["--epoch", "2024-01-01", "--day-seconds", "86400", "--root", str(tmp_path),
          "reconcile", "--landing", str(tmp_path / "landing"), "--day", "2"])
    days = {r.sim_day for r in spark.read.parquet(str(tmp_path / "daily_profitability"))
            .select("sim_day").distinct().collect()}
    assert days == {2}
    assert (tmp_path / "reports" / "sim_day=2").exists()


def test_report_lines_with_check_and_table(spark):
    profit = spark.createDataFrame([
        ("V0001", 4, 2, Decimal("10.5"), Decimal("20"), Decimal("1"), Decimal("50"), Decimal("-10.5"), -0.21, 0.42,
         True, True, True),
        ("V0002", 4, 1, Decimal("3"), None, None, None, None, None, None, False, False, False)],
        "vehicle_id string, sim_day int, trips int, earnings decimal(12,2), fuel_cost decimal(10,2), "
        "maintenance_cost decimal(10,2), distance_covered decimal(10,2), profit decimal(12,2), "
        "profit_per_km double, cost_per_km double, unprofitable boolean, service_flag boolean, has_expenses boolean")
    check = spark.createDataFrame([(4, 3, 3, Decimal("14.00"), Decimal("13.50"), 3.7037037)],
                                  "sim_day int, speed_trips bigint, batch_trips bigint, speed_earnings decimal(12,2), "
                                  "batch_earnings decimal(12,2), earnings_delta_pct double")
    lines = [r.line for r in daily_report(profit, check, F.lit("2024-01-01").cast("timestamp"))
             .orderBy("line_no").collect()]
    assert "- Speed-layer trips: 3, earnings: 14.00" in lines
    assert "- Batch-layer trips: 3, earnings: 13.50" in lines
    assert "- Earnings delta: 3.70%" in lines
    assert "- Total earnings (batch): 13.50" in lines and "- Unprofitable vehicles: 1" in lines
    assert lines[-1] == "| V0001 | 2 | 10.50 | 20.00 | 1.00 | -10.50 | 0.42 | True | True |"
    assert NO_CHECK not in lines


def test_no_registered_query_plans_a_cross_join(spark):
    bad = []
    for name, query in REGISTRY.items():
        plan = _plan(query(spark, SF_SMALL))
        if "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan:
            bad.append(name)
    assert bad == []


def test_archive_spreads_a_hot_day_over_tasks(spark, tmp_path):
    from mobility.sources.lake import lake_scan
    clock = fx.FIXTURE_CLOCK
    hot = spark.range(0, 9000).select(
        F.col("id").alias("event_id"), F.lit("V1").alias("vehicle_id"),
        F.timestamp_micros(F.lit(clock.epoch_us) + F.col("id") * 1000).alias("event_ts"))
    cold = spark.range(9000, 10000).select(
        F.col("id").alias("event_id"), F.lit("V2").alias("vehicle_id"),
        F.timestamp_micros(F.lit(clock.epoch_us + 5 * clock.day_us) + F.col("id") * 1000).alias("event_ts"))
    # Small advisory size: stands for "a day is many times the target partition size".
    keys = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "8k")
    try:
        archive_by_day(hot.unionByName(cold), str(tmp_path / "lake"), clock)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    day0 = [p for p in (tmp_path / "lake" / "sim_day=0").iterdir() if p.name.endswith(".parquet")]
    assert len(day0) >= 3  # the hot day is written by several tasks, not one
    assert lake_scan(spark, str(tmp_path / "lake")).count() == 10000


def test_rerun_does_not_duplicate_rejects(spark, tmp_path):
    from decimal import Decimal as D
    clock = fx.FIXTURE_CLOCK
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "expenses_day_1.csv").write_text(
        "vehicle_id,fuel_cost,maintenance_cost,distance_covered,service_flag\nV0001,1,1,1,no\nV0001,2,2,2,no\n")
    archive_by_day(fx.lake_events(spark, SF_SMALL), str(tmp_path / "lake"), clock)
    write_upsert_batch(spark.createDataFrame([], "window_start timestamp, window_end timestamp, sim_day int, "
                                                 "trips_completed int, earnings decimal(12,2)"), 0,
                       str(tmp_path / "fleet"))
    names = ["profit", "rejects", "check", "reports", "beats"]
    cfg = reconciliation.BatchConfig(clock, str(tmp_path / "lake"), str(tmp_path / "landing"),
                                     str(tmp_path / "fleet"), *[str(tmp_path / n) for n in names])
    reconciliation.run(spark, cfg, days=[1])
    reconciliation.run(spark, cfg, days=[1])
    rejects = spark.read.parquet(cfg.expense_rejects).collect()
    assert sorted((r.vehicle_id, r.reject_reason, r.fuel_cost) for r in rejects) == [
        ("V0001", "duplicate_key", D("1.00")), ("V0001", "duplicate_key", D("2.00"))]
