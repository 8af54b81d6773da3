"""Stored ingest counters: what a streaming query observed, batch by batch.

``IngestMetrics`` listens to the progress of the streams and stores, per query and batch, the
valid and invalid records that ``observe_ingest`` counted and the rows that the watermark dropped (of
all stateful operators). The alert rules read this table in production
(:func:`mobility.operators.quality.metrics_steps`).

A batch that is run again after a restart reports again under the same (query, batch) and replaces
its row. Rows are a few numbers a batch; they are written by a thread of their own, so
that the streams' event bus never waits for a job.
"""
from __future__ import annotations

import queue
import threading
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from mobility.sinks.files import append_once, read_appended

SCHEMA = ("query string, batch_id long, at timestamp, input_rows long, valid_records long, invalid_records long, "
          "dropped_rows long")


class IngestMetrics(StreamingQueryListener):
    """Stores each batch's counters under ``path``; ``close`` waits until all are written."""

    def __init__(self, spark: SparkSession, path: str, name: str = "ingest"):
        self.spark, self.path, self.name = spark, path, name
        self.pending: queue.Queue = queue.Queue()
        self.errors: list[Exception] = []
        self.ended: dict[str, threading.Event] = {}
        self.names: dict[str | None, str] = {}
        self.thread = threading.Thread(target=self._write, daemon=True)
        self.thread.start()

    def onQueryStarted(self, event) -> None:
        self.ended[str(event.runId)] = threading.Event()
        self.names[event.name] = str(event.runId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if (ended := self.ended.get(str(event.runId))) is not None:
            ended.set()

    def wait_for(self, name: str, seconds: float = 60.0) -> None:
        """Wait until the end of the query of this name has been heard of: all its progress has come then."""
        if (run := self.names.get(name)) is not None:
            self.ended[run].wait(seconds)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(self.name)
        at = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        dropped = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        self.pending.put((p.name or str(p.id), int(p.batchId), at, int(p.numInputRows),
                          int(seen["valid_records"] or 0) if seen else 0, int(seen["invalid_records"] or 0) if seen else 0, int(dropped)))

    def _write(self) -> None:
        while (row := self.pending.get()) is not None:
            try:
                # A batch without input reports under the id of the one to come: its drops are kept apart.
                token = f"{row[0]}-{row[1]}" + ("" if row[3] else "-idle")
                append_once(self.spark.createDataFrame([row], SCHEMA).coalesce(1), self.path, token)
            except Exception as error:  # noqa: BLE001 - reported by close; the stream itself goes on
                self.errors.append(error)
            finally:
                self.pending.task_done()
        self.pending.task_done()

    def close(self) -> None:
        """Wait for the rows that have come; raise what went wrong with one."""
        self.pending.join()
        self.pending.put(None)
        self.thread.join()
        if self.errors:
            raise self.errors[0]


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The stored counters, a row per query and batch."""
    return read_appended(spark, path, SCHEMA)
