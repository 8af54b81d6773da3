"""Fleet data derived from the supplied tables (see FIXTURES.md §3).

``events`` becomes vehicle telemetry and ``lineitem`` becomes daily expense
rows. Everything is a lazy DataFrame over the whole table: no ids, prefixes or
caps, so the work grows with the scale factor.
"""
from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mobility.functions.clock import SimClock, instant
from mobility.operators.dims import padded_id
from mobility.operators.scan import running_count
from mobility.plans.derived import materialized
from mobility.plans.memo import shared_plan
from mobility.schema import BUSINESS_COLUMNS, COST, TS

# Fixed values of the fixture mapping (FIXTURES.md §3.1 / §3.3).
ZONE_CYCLE = ["downtown", "airport", "suburbs_north", "suburbs_south", "industrial_park"]
EXPENSE_DAY_ORIGIN = "1995-01-02"
EXPENSE_DAYS = 30
NULL_TRIP_EVERY = 97      # completions with event_id % 97 = 0 carry no trip_id
BAD_PAYLOAD_EVERY = 50    # event_id % 50 = 7 is sent as a broken payload
BAD_PAYLOAD_AT = 7

NUMBERED = f"event_id long, user_id long, event_type string, value double, {TS} timestamp, trip_no long"

# Telemetry days start at 2024-01-01 and last a real day.
FIXTURE_CLOCK = SimClock(epoch=datetime(2024, 1, 1, tzinfo=timezone.utc), day_seconds=86_400)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vehicle_code(user_id: Column) -> Column:
    return padded_id("V", user_id + F.lit(1))


def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with ``trip_no``, the number of the vehicle's earlier completions."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", instant("ts").alias(TS))
    ev = ev.withColumn("_done", (F.col("event_type") == "purchase").cast("int"))
    return running_count(ev, "user_id", [TS, "event_id"], "_done", "trip_no", inclusive=False).drop("_done")


def numbered_root(spark: SparkSession, sf_dir: str) -> str:
    """Production telemetry carries its trip's number; here it is derived once and kept."""
    return materialized(spark, "numbered", sf_dir, ["events"],
                        lambda p: numbered_events(spark, sf_dir).write.mode("overwrite").parquet(p))


@shared_plan
def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All telemetry rows, typed, with the ``corruption`` each payload gets.

    ``event_ts`` is a session-zone timestamp (UTC), so streaming watermarks
    accept it; ``trip_no`` counts the vehicle's earlier completions.
    """
    ev = spark.read.schema(NUMBERED).parquet(numbered_root(spark, sf_dir))

    vid = vehicle_code(F.col("user_id"))
    et = F.col("event_type")
    eid = F.col("event_id")
    moving = et.isin("click", "error")
    zone = F.element_at(F.array(*[F.lit(z) for z in ZONE_CYCLE]),
                        (F.pmod(F.col("user_id") + eid, F.lit(5)) + 1).cast("int"))
    block = F.floor(eid / F.lit(BAD_PAYLOAD_EVERY)).cast("bigint")
    corruption = (F.when(F.pmod(eid, F.lit(BAD_PAYLOAD_EVERY)) != BAD_PAYLOAD_AT, "none")
                  .when(F.pmod(block, F.lit(3)) == 0, "truncated_json")
                  .when(F.pmod(block, F.lit(3)) == 1, "missing_field")
                  .otherwise("wrong_type"))
    return ev.select(
        "event_id",
        F.when(moving | ((et == "purchase") & (F.pmod(eid, F.lit(NULL_TRIP_EVERY)) != 0)),
               F.concat(vid, F.lit("-"), F.col("trip_no").cast("string"))).alias("trip_id"),
        F.concat(F.lit("D"), F.substring(vid, 2, 1 << 20)).alias("driver_id"),
        vid.alias("vehicle_id"),
        zone.alias("zone"),
        (F.lit(6.8) + F.pmod(eid, F.lit(400)).cast("double") / F.lit(1000)).alias("lat"),
        (F.lit(79.8) + F.pmod(eid, F.lit(180)).cast("double") / F.lit(1000)).alias("lon"),
        F.when(moving, F.pmod(eid * 7, F.lit(500)).cast("double") / F.lit(10)).otherwise(F.lit(0.0)).alias("speed"),
        F.when(et == "click", "enroute").when(et == "error", "on_trip").otherwise("idle").alias("status"),
        F.when(et == "purchase", F.col("value")).otherwise(F.lit(0.0)).alias("fare"),
        (et == "purchase").alias("trip_completed"),
        F.col(TS),
        corruption.alias("corruption"),
    )


@shared_plan
def lake_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archive holds: valid events only, the 11 business columns plus
    ``event_id`` (the message offset, used as a deterministic tie-break)."""
    return (telemetry(spark, sf_dir).where(F.col("corruption") == "none")
            .select("event_id", *BUSINESS_COLUMNS))


@shared_plan
def raw_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, raw_value)``: the JSON text each event is sent as, with the
    three broken forms of the reference's payload corruptor. ``ingest_ts``
    stands for the broker's record timestamp."""
    t = telemetry(spark, sf_dir)
    ts_text = F.date_format(F.col(TS), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    fields = [c for c in BUSINESS_COLUMNS if c != TS]
    full = F.to_json(F.struct(*[F.col(c) for c in fields], ts_text.alias("timestamp")))
    no_vehicle = F.to_json(F.struct(*[F.col(c) for c in fields if c != "vehicle_id"],
                                    ts_text.alias("timestamp")))
    raw = (F.when(F.col("corruption") == "truncated_json",
                  F.substring(full, 1, (F.length(full) / 2).cast("int")))
           .when(F.col("corruption") == "missing_field", no_vehicle)
           .when(F.col("corruption") == "wrong_type",
                 F.regexp_replace(full, r'"speed":[0-9.]+', '"speed":"very_fast"'))
           .otherwise(full))
    return t.select("event_id", raw.alias("raw_value"), F.col(TS).alias("ingest_ts"))


def expense_day(shipdate: Column) -> Column:
    return F.datediff(shipdate.cast("date"), F.lit(EXPENSE_DAY_ORIGIN).cast("date"))


@shared_plan
def expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One expense row per (vehicle, sim_day) folded from lineitem."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_quantity", "l_returnflag",
        F.pmod(expense_day(F.col("l_shipdate")), F.lit(EXPENSE_DAYS)).cast("int").alias("sim_day"))
    agg = li.groupBy("l_suppkey", "sim_day").agg(
        F.sum("l_quantity").alias("_qty"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(F.lit(0.0))).alias("_ret"))
    zero_km = F.pmod(F.col("l_suppkey") + F.col("sim_day"), F.lit(17)) == 0
    return agg.select(
        vehicle_code(F.col("l_suppkey")).alias("vehicle_id"),
        "sim_day",
        (F.col("_qty") * 5 / 100).cast(COST).alias("fuel_cost"),
        (F.col("_ret") * 5 / 100).cast(COST).alias("maintenance_cost"),
        F.when(zero_km, F.lit(0.0)).otherwise(F.col("_qty")).cast(COST).alias("distance_covered"),
        (F.pmod(F.col("_qty").cast("bigint"), F.lit(12)) == 0).alias("service_flag"),
    )


def expense_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unaggregated expense records, one per lineitem row: many rows share a
    (vehicle, day) key, which the load validation must reject."""
    li = table(spark, sf_dir, "lineitem")
    qty = F.col("l_quantity")
    return li.select(
        F.col("l_orderkey").alias("source_order"),
        F.col("l_linenumber").alias("source_line"),
        vehicle_code(F.col("l_suppkey")).alias("vehicle_id"),
        F.pmod(expense_day(F.col("l_shipdate")), F.lit(EXPENSE_DAYS)).cast("int").alias("sim_day"),
        (qty * 5 / 100).cast(COST).alias("fuel_cost"),
        F.when(F.col("l_returnflag") == "R", qty * 5 / 100).otherwise(F.lit(0.0)).cast(COST).alias("maintenance_cost"),
        qty.cast(COST).alias("distance_covered"),
    )


def landing_listing(spark: SparkSession, sf_dir: str, root: str = "landing") -> DataFrame:
    """A listing of the landing zone: one ``expenses_day_<N>.csv`` per ship
    day of lineitem, N counted from the first ship day (not folded)."""
    days = table(spark, sf_dir, "lineitem").select(expense_day(F.col("l_shipdate")).alias("d")).distinct()
    return days.select(F.concat(F.lit(f"{root}/expenses_day_"), F.col("d").cast("string"),
                                F.lit(".csv")).alias("path"))
