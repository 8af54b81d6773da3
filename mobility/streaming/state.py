"""Keyed vehicle state on a stream (row 27).

``groupBy(vehicle_id).transformWithStateInPandas``: state per vehicle lives in the executors'
RocksDB store, never on the driver. Rows may come in any order within the watermark, so a row
is *applied* only when the watermark has passed it; until then it waits in the vehicle's list
state (new rows are appended, nothing stored is rewritten for them). An element of the list holds up to
``CHUNK`` rows as arrays: each element and each call to the state store costs as much as many rows do. Rows leave in
one array per call for the same reason, and are unpacked by Spark. What is known of the vehicle is a
value state. An event-time timer wakes the vehicle for its next row, its next alert or its
retirement. Applied in order of (event time, offset), rows give what the batch forms give:

* idle_since - the first idle event after the last non-idle one;
* alerts - when the watermark passes idle_since + threshold, a row with ``open`` true, or with ``open`` false
  if a non-idle row that ends the run has come already (waiting or applied), so that alerts and state rows of one
  call agree. A run that alerted while open gets its closing row, ``open`` false, when it ends. Alerts are
  kept as an upsert log, the last row of an alert holds.

Rows that come when the watermark has passed them are late and never applied. Those that the watermark of the batch before
had passed too are dropped, and counted, by the engine; the others leave as rows of kind ``late`` (event time in
``last_event_ts``) and are stored.

Each call that brings rows also emits the vehicle's state as it is with the waiting
rows applied, so the state table doesn't lag behind by the watermark. A vehicle silent for
``retention_days`` of event time (no alert pending) is forgotten: its next event is its first.
"""
from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from operator import attrgetter
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from mobility.operators.state import IDLE_ALERT_MINUTES
from mobility.schema import IDLE, TS

# Instants in state are epoch microseconds (no time-zone conversion on the way
# between the state store and pandas).
VEHICLE_SCHEMA = ("status string, zone string, last_event_us long, last_event_id long, "
                  "idle_since_us long, alerted_us long, told_closed boolean, timer_ms long")
WAITING_SCHEMA = "us array<long>, event_id array<long>, status array<string>, zone array<string>"
OUTPUT_SCHEMA = ("rows array<struct<kind: string, vehicle_id: string, status: string, zone: string, "
                 "last_event_us: long, idle_since_us: long, alert_us: long, open: boolean>>")
OUTPUT_TIMES = {"last_event_us": "last_event_ts", "idle_since_us": "idle_since", "alert_us": "alert_at"}
CHUNK = 1000  # rows in an element of the list state or of the output
MESSAGE = 100  # elements in a message to the state store
ABSENT = -(1 << 63)  # instead of a null event time or offset
RETENTION_DAYS = 30.0


class Row(NamedTuple):
    """An event: time in microseconds, offset, status, zone."""
    us: int
    event_id: int
    status: str
    zone: str


class Vehicle(NamedTuple):
    """What is known of a vehicle after the rows applied so far; ``alerted`` is the idle run that
    has an alert, ``told_closed`` whether its last alert row says it ended, ``timer`` the pending timer."""
    status: str | None = None
    zone: str | None = None
    last_us: int | None = None
    last_id: int | None = None
    idle_since: int | None = None
    alerted: int | None = None
    told_closed: bool = False
    timer: int | None = None

    def after(self, row: Row) -> Vehicle:
        idle_since = None if row.status != IDLE else row.us if self.idle_since is None else self.idle_since
        return Vehicle(row.status, row.zone, row.us, row.event_id, idle_since, self.alerted, self.told_closed, self.timer)

    def after_all(self, rows: list[Row]) -> Vehicle:
        """As :meth:`after` for each of the rows, from the idle run that they end with."""
        if not rows:
            return self
        run = len(rows)
        while run and rows[run - 1].status == IDLE:
            run -= 1
        before = self if run == 0 else self._replace(idle_since=None)
        if run < len(rows):
            before = before.after(rows[run])
        return before.after(rows[-1])

    def seen(self, row: Row) -> bool:
        """Whether the row, or a later one, is applied already (a replay)."""
        return self.last_us is not None and (row.us, row.event_id) <= (self.last_us, self.last_id)

    def waits_for_alert(self) -> bool:
        return self.idle_since is not None and self.alerted != self.idle_since


def _chunks(rows: list, size: int = CHUNK) -> list[list]:
    return [rows[i:i + size] for i in range(0, len(rows), size)]


def _as_arrays(rows: list[Row]) -> list[tuple]:
    """The rows as elements of the list state."""
    return [tuple(map(list, zip(*chunk, strict=True))) for chunk in _chunks(rows)]


def _frame(out: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame({"rows": _chunks(out)})


class VehicleProcessor(StatefulProcessor):
    """Applies a vehicle's rows in order of event time behind the watermark."""

    def __init__(self, threshold_minutes: float = IDLE_ALERT_MINUTES, retention_days: float = RETENTION_DAYS):
        self.limit = int(round(threshold_minutes * 60_000_000))
        self.retention = int(round(retention_days * 86_400_000_000))

    def init(self, handle) -> None:
        self.handle = handle
        self.vehicle = handle.getValueState("vehicle", VEHICLE_SCHEMA)
        self.waiting = handle.getListState("waiting", WAITING_SCHEMA)

    def handleInputRows(self, key, rows: Iterable[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = self._now()
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        new: set[Row] = set()
        late: list[Row] = []
        for pdf in rows:
            given = zip(pdf["us"].tolist(), pdf["event_id"].tolist(), pdf["status"].tolist(), pdf["zone"].tolist(), strict=True)
            for r in map(Row._make, given):
                if r.us <= watermark:
                    late.append(r)
                elif not now.seen(r):
                    new.add(r)
        if late:
            yield _frame([("late", key[0], r.status, r.zone, None if r.us == ABSENT else r.us, None, None, None) for r in late])
        if new or not late:
            yield from self._step(key[0], now, self._held(now), new, watermark, news=True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = self._now()
        yield from self._step(key[0], now._replace(timer=None), self._held(now), set(),
                              timerValues.getCurrentWatermarkInMs() * 1000, news=False)

    def _now(self) -> Vehicle:
        stored = self.vehicle.get()
        return Vehicle(*stored) if stored else Vehicle()

    def _held(self, now: Vehicle) -> list[Row]:
        """The waiting rows; a vehicle that has any has a timer for the next one."""
        if now.timer is None:
            return []
        return [Row._make(r) for chunk in self.waiting.get() for r in zip(*chunk, strict=True)]

    def _step(self, vehicle_id: str, now: Vehicle, held: list[Row], new: set[Row], watermark: int,
              news: bool) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []

        def emit(kind: str, v: Vehicle, at: int | None, open_: bool | None) -> None:
            out.append((kind, vehicle_id, v.status, v.zone, v.last_us, v.idle_since, at, open_))

        in_order = sorted(new.union(held if now.last_us is None else [r for r in held if not now.seen(r)]))
        passed = bisect_right(in_order, watermark, key=attrgetter("us"))
        rest = in_order[passed:]
        for row in in_order[:passed]:
            if row.status != IDLE and now.idle_since is not None and row.us - now.idle_since >= self.limit \
                    and not (now.alerted == now.idle_since and now.told_closed):
                emit("alert", now._replace(status=IDLE, last_us=row.us), now.idle_since + self.limit, False)
            now = now.after(row)
        if now.waits_for_alert() and now.idle_since + self.limit <= watermark:
            ended = any(r.status != IDLE for r in rest)
            emit("alert", now, now.idle_since + self.limit, not ended)
            now = now._replace(alerted=now.idle_since, told_closed=ended)
        if news and in_order:
            emit("state", now.after_all(rest), None, None)
        if len(rest) == len(held) + len(new):
            self._store(sorted(new), self.waiting.appendList)
        elif rest:
            self._store(rest, self.waiting.put)
        else:
            self.waiting.clear()
        self._keep(now, rest, watermark)
        if out:
            yield _frame(out)

    def _store(self, rows: list[Row], first: Callable[[list[tuple]], None]) -> None:
        """Give the rows to the list state, the first message by ``first`` and any others appended."""
        for i, part in enumerate(_chunks(_as_arrays(rows), MESSAGE)):
            (self.waiting.appendList if i else first)(part)

    def _keep(self, now: Vehicle, rest: list[Row], watermark: int) -> None:
        """Store the vehicle and set its one timer; forget it after its retention."""
        due = [r.us for r in rest[:1]]
        if now.waits_for_alert():
            due.append(now.idle_since + self.limit)
        if not due and now.last_us is not None:
            if now.last_us + self.retention <= watermark:
                if now.timer is not None:
                    self.handle.deleteTimer(now.timer)
                self.vehicle.clear()
                return
            due.append(now.last_us + self.retention)
        timer = max(min(due), watermark) // 1000 + 1 if due else None
        if timer != now.timer:
            if now.timer is not None:
                self.handle.deleteTimer(now.timer)
            if timer is not None:
                self.handle.registerTimer(timer)
        self.vehicle.update(tuple(now._replace(timer=timer)))


def vehicle_state_stream(valid: DataFrame, watermark: str = "2 minutes", threshold_minutes: float = IDLE_ALERT_MINUTES,
                         retention_days: float = RETENTION_DAYS) -> DataFrame:
    """Streaming frame of state rows and alert rows (``kind``). The batch twins
    are ``vehicle_latest``, ``idle_episodes`` and ``idle_alerts``."""
    if not valid.isStreaming:
        raise ValueError("vehicle_state_stream needs a streaming frame; for batch input use "
                         "vehicle_latest / idle_episodes / idle_alerts")
    absent = F.lit(ABSENT)
    rows = (valid.select("vehicle_id", "status", "zone", TS, F.coalesce("event_id", absent).alias("event_id"),
                         F.coalesce(F.unix_micros(TS), absent).alias("us")).where("vehicle_id IS NOT NULL")
            .withWatermark(TS, watermark))
    out = rows.groupBy("vehicle_id").transformWithStateInPandas(
        VehicleProcessor(threshold_minutes, retention_days), OUTPUT_SCHEMA, "append", "EventTime").select(F.inline("rows"))
    return out.select(*[F.timestamp_micros(c).alias(OUTPUT_TIMES[c]) if c in OUTPUT_TIMES else c for c in out.columns])
