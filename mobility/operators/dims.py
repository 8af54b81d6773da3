"""Dimensions: the vehicle roster and the zone dictionary."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed zone dictionary of the reference: name -> (lat_min, lat_max, lon_min, lon_max).
ZONES = {
    "downtown": (6.925, 6.945, 79.845, 79.860),
    "airport": (7.170, 7.185, 79.880, 79.895),
    "suburbs_north": (6.960, 6.985, 79.895, 79.915),
    "suburbs_south": (6.820, 6.845, 79.860, 79.880),
    "industrial_park": (6.960, 6.975, 79.960, 79.980),
}
ZONE_NAMES = list(ZONES)

# Fare model constants.
BASE_FARE = 3.5
RATE_PER_KM = 0.85


def padded_id(prefix: str, n: F.Column, width: int = 4) -> F.Column:
    """``f"{prefix}{n:0{width}d}"``: zero-padded, never truncated."""
    digits = n.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) >= width, digits)
                    .otherwise(F.lpad(digits, width, "0")))


def vehicle_dim(spark: SparkSession, n: int | None = None, count: F.Column | None = None,
                source: DataFrame | None = None) -> DataFrame:
    """Row 10: roster V0001..Vn with drivers D0001..Dn and home zone by i % 5.

    Either a fixed ``n`` or the ids ``i`` of a ``source`` frame (column ``i``)."""
    ids = spark.range(1, n + 1).withColumnRenamed("id", "i") if source is None else source.select("i")
    zones = F.array(*[F.lit(z) for z in ZONE_NAMES])
    return ids.select(
        padded_id("V", F.col("i")).alias("vehicle_id"),
        padded_id("D", F.col("i")).alias("driver_id"),
        F.element_at(zones, (F.pmod(F.col("i"), F.lit(len(ZONE_NAMES))) + 1).cast("int")).alias("home_zone"),
    )


def zone_dim(spark: SparkSession) -> DataFrame:
    """The five zones with their lat/lon boxes (a literal, always broadcast)."""
    rows = [(z, *box) for z, box in ZONES.items()]
    return F.broadcast(spark.createDataFrame(
        rows, "zone string, lat_min double, lat_max double, lon_min double, lon_max double"))
