"""Simulated calendar as column expressions.

One simulated day lasts ``day_seconds`` of event time, counted from ``epoch``.
Both are explicit: a wall-clock default makes results unreproducible. All maths
is on integer microseconds, so day and hour boundaries are exact.
"""
from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(col: Column | str) -> Column:
    """Event time as a session-zone (UTC) timestamp; NTZ input is read as UTC."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("timestamp")


def ntz(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("timestamp_ntz")


def micros(col: Column | str) -> Column:
    return F.unix_micros(instant(col))


def floor_div(a: Column, b: int) -> Column:
    """Exact floor division of a bigint column by a positive integer constant."""
    return F.call_function("div", a - F.pmod(a, F.lit(b)), F.lit(b)).cast("bigint")


@dataclass(frozen=True)
class SimClock:
    epoch: datetime
    day_seconds: int = 300

    def __post_init__(self):
        if self.day_seconds <= 0:
            raise ValueError("day_seconds must be positive")
        if self.epoch.tzinfo is None:
            object.__setattr__(self, "epoch", self.epoch.replace(tzinfo=timezone.utc))

    @property
    def epoch_us(self) -> int:
        delta = self.epoch - datetime(1970, 1, 1, tzinfo=timezone.utc)
        return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds

    @property
    def day_us(self) -> int:
        return self.day_seconds * 1_000_000

    def _elapsed(self, ts: Column | str) -> Column:
        return micros(ts) - F.lit(self.epoch_us)

    def day(self, ts: Column | str) -> Column:
        """max(0, floor(elapsed / day)) as int."""
        e = self._elapsed(ts)
        return F.greatest(F.lit(0).cast("bigint"), floor_div(e, self.day_us)).cast("int")

    def hour(self, ts: Column | str) -> Column:
        """int(fraction of the day * 24) % 24; wraps for instants before the epoch."""
        rem = F.pmod(self._elapsed(ts), F.lit(self.day_us))
        return floor_div(rem * F.lit(24), self.day_us).cast("int")

    def seconds_until_next_day(self, ts: Column | str) -> Column:
        rem = F.pmod(self._elapsed(ts), F.lit(self.day_us))
        return (F.lit(self.day_us) - rem).cast("double") / F.lit(1_000_000.0)

    def check_span(self, span_seconds: int) -> None:
        """The speed-vs-batch check sums epoch-aligned windows of ``span``; that
        tiles a simulated day only if the span divides both the day length and
        the epoch offset."""
        if self.day_seconds % span_seconds:
            raise ValueError(f"window span {span_seconds}s does not divide the {self.day_seconds}s day")
        if self.epoch_us % (span_seconds * 1_000_000):
            raise ValueError(f"epoch {self.epoch.isoformat()} is not a multiple of the {span_seconds}s span")


def with_sim_clock(df, clock: SimClock, ts: str = "event_ts"):
    """Row 9: add sim_day, sim_hour and seconds_until_next_day."""
    return df.select(
        "*",
        clock.day(ts).alias("sim_day"),
        clock.hour(ts).alias("sim_hour"),
        clock.seconds_until_next_day(ts).alias("seconds_until_next_day"),
    )
