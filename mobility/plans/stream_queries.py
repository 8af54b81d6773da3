"""Registered queries that run the speed layer over the supplied events and read its tables back.

Each call starts an ``availableNow`` run of the production query (same function, same sink) from
a log of payloads derived from ``events``, waits for it, and returns what it stored, so that the stream rows of
the inventory are checked by SQL like the batch ones.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mobility.functions.clock import ntz
from mobility.operators.ingest import dead_letters, valid_events
from mobility.plans.derived import materialized
from mobility.plans.queries import CLOCK, register
from mobility.session import shared_path
from mobility.sinks.files import append_once, read_appended
from mobility.sinks.upsert import read_upsert_log
from mobility.sources import fixtures as fx
from mobility.streaming import app
from mobility.streaming.metrics import IngestMetrics, read_metrics

NOW = {"availableNow": True}
#: Keyed state of this kind lives in RocksDB; a session made elsewhere may not say so.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PAYLOADS = "value string, ingest_ts timestamp, event_id long"


def payload_log(spark: SparkSession, sf_dir: str) -> str:
    """The payloads as a folder that a stream reads, written once."""
    return materialized(spark, "payloads", sf_dir, ["events"], lambda p: fx.raw_payloads(spark, sf_dir).select(
        F.col("raw_value").alias("value"), "ingest_ts", "event_id").write.mode("overwrite").parquet(p))


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return app.decoded_stream(spark.readStream.schema(PAYLOADS).parquet(payload_log(spark, sf_dir)))


def _config(spark: SparkSession, **kw) -> app.StreamConfig:
    root = shared_path(spark, "mobility-streams", uuid.uuid4().hex)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    names = ["lake", "dead_letters", "zone_metrics", "fleet_metrics", "vehicle_state", "alerts", "checkpoints"]
    return app.StreamConfig(clock=CLOCK, **{n: f"{root}/{n}" for n in names}, metrics=f"{root}/ingest_metrics",
                            archive_trigger=NOW, window_trigger=NOW, state_trigger=NOW, **kw)


def _finished(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


@register
def stream_zone_windows(spark, sf_dir):
    """Row 26: exact windows, each emitted once when the watermark has passed it."""
    cfg = _config(spark, exact_windows=True)
    _finished(app.window_query(valid_events(_decoded(spark, sf_dir), keep=["event_id"]), cfg, by_zone=True))
    return read_upsert_log(spark, cfg.zone_metrics, ["window_start", "zone"]).drop("updated_at")


@register
def stream_vehicle_state(spark, sf_dir):
    """Row 27: the stored state of each vehicle."""
    cfg = _config(spark)
    _finished(app.vehicle_state_query(valid_events(_decoded(spark, sf_dir), keep=["event_id"]), cfg))
    state = read_upsert_log(spark, cfg.vehicle_state, ["vehicle_id"])
    return state.select("vehicle_id", "status", "zone", ntz("last_event_ts").alias("last_event_ts"), ntz("idle_since").alias("idle_since"))


@register
def stream_dead_letters(spark, sf_dir):
    """Row 33: the dead-letter table."""
    cfg = _config(spark)
    _finished(app.dead_letter_query(dead_letters(_decoded(spark, sf_dir), keep=["event_id", "ingest_ts"]), cfg))
    return spark.read.parquet(cfg.dead_letters).select("event_id", "raw_value", "reason")


@register
def stream_ingest_counters(spark, sf_dir):
    """Rows 20 and 31: what the listener stored of an archive run, added up."""
    cfg = _config(spark)
    listener = IngestMetrics(spark, cfg.metrics)
    spark.streams.addListener(listener)
    try:
        _finished(app.archive_query(valid_events(app.observe_ingest(_decoded(spark, sf_dir)), keep=["event_id"]), cfg))
        listener.wait_for("archive")
    finally:
        spark.streams.removeListener(listener)
        listener.close()
    return read_metrics(spark, cfg.metrics).agg(
        F.sum("valid_records").alias("valid_records"), F.sum("invalid_records").alias("invalid_records"),
        F.sum("dropped_rows").alias("dropped_rows"))


@register
def appended_once(spark, sf_dir):
    """Row 35: two appends of the lake's events, the first one repeated as a retry would."""
    path = shared_path(spark, "mobility-streams", uuid.uuid4().hex)
    events = fx.lake_events(spark, sf_dir).select("event_id", "vehicle_id", "status")
    for token, half in (("even", 0), ("even", 0), ("odd", 1)):
        append_once(events.where(F.pmod("event_id", F.lit(2)) == half), path, token)
    return read_appended(spark, path, "event_id long, vehicle_id string, status string")
