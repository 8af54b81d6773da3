"""Decode telemetry payloads and split them into valid events and dead letters."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mobility.schema import BUSINESS_COLUMNS, CORRUPT_COLUMN, EVENT_SCHEMA, MAX_FARE, TS

JSON_OPTIONS = {"columnNameOfCorruptRecord": CORRUPT_COLUMN}


def decode_telemetry(raw: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Row 2: JSON text (or bytes) -> typed columns, keeping the payload as
    ``raw_value`` and any unparsable text in ``_corrupt_record``.

    The parsed struct is unpacked with ``inline`` of a one-element array, a
    generator: filters on the decoded fields (the validity split) then stay
    above it. Unpacked with a plain projection, the optimizer would push each
    null check below it and re-parse the payload once per checked field."""
    text = F.col(value).cast("string")
    keep = keep or []
    parsed = raw.select(*keep, text.alias("raw_value"),
                        F.inline(F.array(F.from_json(text, EVENT_SCHEMA, JSON_OPTIONS))))
    return parsed.withColumnRenamed("timestamp", TS)


def valid_condition() -> Column:
    """Never NULL, so the valid/dead-letter split is total."""
    return (F.col(CORRUPT_COLUMN).isNull()
            & F.col("vehicle_id").isNotNull()
            & F.col("status").isNotNull()
            & F.col("zone").isNotNull()
            & F.col(TS).isNotNull()
            & fare_in_range())


def fare_in_range() -> Column:
    """A fare that money columns can hold (a missing one counts as none); not NaN."""
    return F.coalesce(F.abs(F.col("fare")) < F.lit(MAX_FARE), F.lit(True))


def valid_events(decoded: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Row 7: rows that pass validation, projected to the business columns."""
    return decoded.where(valid_condition()).select(*(keep or []), *BUSINESS_COLUMNS)


def dead_letters(decoded: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Row 8: the exact complement, as the raw payload plus a reason."""
    reason = (F.when(F.col(CORRUPT_COLUMN).isNotNull(), "corrupt_payload")
              .when(F.col("vehicle_id").isNull(), "missing_vehicle_id")
              .when(F.col("status").isNull(), "missing_status")
              .when(F.col("zone").isNull(), "missing_zone")
              .when(F.col(TS).isNull(), "missing_timestamp")
              .otherwise("fare_out_of_range"))
    return decoded.where(~valid_condition()).select(
        *(keep or []), F.coalesce(F.col("raw_value"), F.lit("")).alias("raw_value"), reason.alias("reason"))
