from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from mobility.functions.clock import SimClock, with_sim_clock

EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)
CLOCK = SimClock(epoch=EPOCH, day_seconds=300)


def _clock_row(spark, ts):
    df = spark.createDataFrame([(ts.replace(tzinfo=None),)], "event_ts timestamp")
    return with_sim_clock(df, CLOCK).first()


@pytest.mark.parametrize("seconds, day, hour, left", [
    (0, 0, 0, 300.0), (12.4, 0, 0, 287.6), (12.5, 0, 1, 287.5), (287.5, 0, 23, 12.5), (1234.5, 4, 2, 265.5), (300 * 7001 + 199, 7001, 15, 101.0)])
def test_day_hour_and_countdown(spark, seconds, day, hour, left):
    r = _clock_row(spark, EPOCH + timedelta(seconds=seconds))
    assert (r.sim_day, r.sim_hour, r.seconds_until_next_day) == (day, hour, left)


def test_before_epoch_clamps_day_and_wraps_hour(spark):
    r = _clock_row(spark, EPOCH - timedelta(seconds=75))
    assert r.sim_day == 0
    assert r.sim_hour == 18  # 225 s into the previous day of 300 s


def test_exact_boundaries_and_last_microsecond(spark):
    r = _clock_row(spark, EPOCH + timedelta(seconds=600))
    assert (r.sim_day, r.sim_hour) == (2, 0)
    r = _clock_row(spark, EPOCH + timedelta(seconds=600) - timedelta(microseconds=1))
    assert (r.sim_day, r.sim_hour) == (1, 23)


def test_span_must_divide_day_and_epoch():
    CLOCK.check_span(300)
    with pytest.raises(ValueError):
        CLOCK.check_span(7)
    odd = SimClock(epoch=datetime(2024, 1, 1, 0, 0, 10, tzinfo=timezone.utc), day_seconds=300)
    with pytest.raises(ValueError):
        odd.check_span(300)


def test_naive_timestamp_is_utc(spark):
    df = spark.createDataFrame([("2024-01-01 00:05:00",)], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("event_ts"))
    assert with_sim_clock(df, CLOCK).first().sim_day == 1
