"""Declared schemas: the telemetry wire format and the result tables."""
from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The wire format of one telemetry message (JSON object). ``timestamp`` is the
# field name on the wire; decoded frames call the column ``event_ts``.
EVENT_SCHEMA = StructType([
    StructField("trip_id", StringType()),
    StructField("driver_id", StringType()),
    StructField("vehicle_id", StringType()),
    StructField("zone", StringType()),
    StructField("lat", DoubleType()),
    StructField("lon", DoubleType()),
    StructField("speed", DoubleType()),
    StructField("status", StringType()),
    StructField("fare", DoubleType()),
    StructField("trip_completed", BooleanType()),
    StructField("timestamp", TimestampType()),
    StructField("_corrupt_record", StringType()),
])

CORRUPT_COLUMN = "_corrupt_record"
TS = "event_ts"

# The 11 business columns archived to the lake (event time as ``event_ts``).
BUSINESS_COLUMNS = [
    "trip_id", "driver_id", "vehicle_id", "zone", "lat", "lon",
    "speed", "status", "fare", "trip_completed", TS,
]

# The columns of an expense file.
EXPENSE_COLUMNS = ["vehicle_id", "fuel_cost", "maintenance_cost", "distance_covered", "service_flag"]

# Money: expense inputs are decimal(10,2); a fare has at most ten digits before
# the point (larger ones are dead letters); sums are wide enough for any
# number of such fares in a day. Per-km ratios are kept as unrounded doubles.
MONEY = "decimal(20,2)"
COST = "decimal(10,2)"
MAX_FARE = 1e10

IDLE = "idle"
