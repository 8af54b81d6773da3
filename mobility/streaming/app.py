"""Structured Streaming wiring of the speed layer.

Four queries over one telemetry source, each with its own checkpoint:

1. archive + dead letters - valid events to the day-partitioned Parquet lake
   through the file sink (exactly-once via its ``_spark_metadata`` log), and
   rejected payloads to a dead-letter sink;
2. zone windows and 3. fleet windows - 5 min / 1 min sliding windows with a
   2 min watermark in update mode, written as an upsert log;
4. vehicle state - keyed state with idle alerts, written as two upsert logs.

The queries that write tables leave a ``stream_sink`` heartbeat per micro-batch.

Every transform is the same function the batch layer uses; only the edges
(source, watermark, sink) are streaming-specific. No micro-batch is collected
to the driver: ``foreachBatch`` only issues distributed writes.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mobility.functions.clock import SimClock
from mobility.operators import windows as win
from mobility.operators.ingest import dead_letters, decode_telemetry, valid_condition, valid_events
from mobility.operators.state import ALERT_SEVERITY, ALERT_TYPE, IDLE_ALERT_MINUTES, iso_text
from mobility.schema import TS
from mobility.sinks.files import append_once, heartbeat
from mobility.sinks.upsert import write_upsert_batch
from mobility.streaming.metrics import IngestMetrics
from mobility.streaming.state import vehicle_state_stream

WATERMARK = "2 minutes"


@dataclass
class StreamConfig:
    """Where the speed layer reads from and writes to."""
    clock: SimClock
    lake: str
    dead_letters: str
    zone_metrics: str
    fleet_metrics: str
    vehicle_state: str
    alerts: str
    checkpoints: str
    source_format: str = "kafka"
    source_options: dict = field(default_factory=dict)
    archive_trigger: dict = field(default_factory=lambda: {"processingTime": "10 seconds"})
    window_trigger: dict = field(default_factory=lambda: {"processingTime": "15 seconds"})
    state_trigger: dict = field(default_factory=lambda: {"processingTime": "10 seconds"})
    dead_letter_format: str = "parquet"
    dead_letter_options: dict = field(default_factory=dict)
    exact_windows: bool = False  # exact counts, each window emitted once when final
    idle_minutes: float = IDLE_ALERT_MINUTES
    heartbeats: str | None = None
    metrics: str | None = None  # table of the counters that each batch observed


def kafka_options(bootstrap: str, topic: str, max_offsets_per_trigger: int | None = None) -> dict:
    """Source options of the reference deployment (connector jar required).
    ``max_offsets_per_trigger`` bounds a micro-batch, and with it the rows one
    vehicle can bring to the keyed state step at once."""
    options = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
               "startingOffsets": "latest", "failOnDataLoss": "false"}
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def raw_events(spark: SparkSession, fmt: str = "kafka", options: dict | None = None,
               path: str | None = None) -> DataFrame:
    """Row 1: unbounded payload stream as ``(value, ingest_ts, event_id)``.

    From Kafka the record timestamp is the ingest time and (partition, offset)
    gives a stable per-message id; a text file source (tests) has one JSON
    payload per line, timestamped with the file's modification time; equal lines of a
    file count as one message sent twice."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    raw = reader.load(path) if path else reader.load()
    if fmt == "kafka":
        return raw.select(F.col("value").cast("string").alias("value"),
                          F.col("timestamp").alias("ingest_ts"),
                          (F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset")).alias("event_id"))
    return raw.select(F.col("value"), F.col("_metadata.file_modification_time").alias("ingest_ts"),
                      F.xxhash64("value", F.col("_metadata.file_path")).alias("event_id"))


def decoded_stream(raw: DataFrame) -> DataFrame:
    return decode_telemetry(raw, value="value", keep=["event_id", "ingest_ts"])


def observe_ingest(decoded: DataFrame, name: str = "ingest") -> DataFrame:
    """Row 20, in-stream form: valid / invalid record counts per micro-batch,
    reported in the query progress (``observedMetrics[name]``) - the record
    counters the reference exported to its metrics server."""
    ok = valid_condition()
    return decoded.observe(name, F.sum(ok.cast("long")).alias("valid_records"),
                           F.sum((~ok).cast("long")).alias("invalid_records"))


def archive_query(valid: DataFrame, cfg: StreamConfig) -> StreamingQuery:
    """Row 32: append-only file sink partitioned by simulated day."""
    out = valid.withColumn("sim_day", cfg.clock.day(TS))
    return (out.writeStream.format("parquet").partitionBy("sim_day")
            .option("checkpointLocation", f"{cfg.checkpoints}/archive")
            .trigger(**cfg.archive_trigger).queryName("archive").start(cfg.lake))


def dead_letter_query(dead: DataFrame, cfg: StreamConfig) -> StreamingQuery:
    """Row 33: rejected payloads to a DLQ (Kafka topic or Parquet table)."""
    out = dead
    if cfg.dead_letter_format == "kafka":
        out = dead.select(F.col("raw_value").alias("value"))
    w = (out.writeStream.format(cfg.dead_letter_format).options(**cfg.dead_letter_options)
         .option("checkpointLocation", f"{cfg.checkpoints}/dead_letters")
         .trigger(**cfg.archive_trigger).queryName("dead_letters"))
    return w.start() if cfg.dead_letter_format == "kafka" else w.start(cfg.dead_letters)


def window_stream(valid: DataFrame, clock: SimClock, by_zone: bool,
                  watermark: str = WATERMARK, exact: bool = False) -> DataFrame:
    """Row 26: the window metrics on a stream.

    Default (the reference's form): one aggregation with approximate distinct
    counts, run in update mode - a window's row is refreshed as data arrives.
    ``exact=True``: the batch form's two chained aggregations (per vehicle,
    then per window), which a stream runs in append mode only - each window is
    emitted once, exact, when the watermark passes its end."""
    keys = ["zone"] if by_zone else []
    agg = win.window_aggregate(valid.withWatermark(TS, watermark), keys, exact=exact, per_step=False)
    return win.finish_window_metrics(agg, clock, keys)


def _beat(batch: DataFrame, cfg: StreamConfig, detail: str, batch_id: int) -> None:
    if cfg.heartbeats:
        heartbeat(batch.sparkSession, cfg.heartbeats, "stream_sink", detail, token=f"{detail}-{batch_id}")


def _upsert_log_writer(path: str, cfg: StreamConfig | None = None):
    def write(batch: DataFrame, batch_id: int) -> None:
        write_upsert_batch(batch, batch_id, path)
        if cfg is not None:
            _beat(batch, cfg, path.rstrip("/").rpartition("/")[2], batch_id)
    return write


def window_query(valid: DataFrame, cfg: StreamConfig, by_zone: bool) -> StreamingQuery:
    name = "zone_metrics" if by_zone else "fleet_metrics"
    path = cfg.zone_metrics if by_zone else cfg.fleet_metrics
    mode = "append" if cfg.exact_windows else "update"
    return (window_stream(valid, cfg.clock, by_zone, exact=cfg.exact_windows).writeStream.outputMode(mode)
            .foreachBatch(_upsert_log_writer(path, cfg))
            .option("checkpointLocation", f"{cfg.checkpoints}/{name}")
            .trigger(**cfg.window_trigger).queryName(name).start())


def alert_table(rows: DataFrame, clock: SimClock) -> DataFrame:
    """Alert rows of the state operator in the alerts-table shape (the same
    as the batch ``idle_alerts``), one per alert: closed if any of its rows is."""
    alerts = rows.where(F.col("kind") == "alert").select(
        F.lit(ALERT_TYPE).alias("alert_type"), "vehicle_id", F.lit(ALERT_SEVERITY).alias("severity"),
        F.concat(F.lit("Vehicle "), F.col("vehicle_id"), F.lit(" idle since "),
                 iso_text(F.col("idle_since"))).alias("message"),
        clock.day(F.col("alert_at")).alias("sim_day"), F.col("alert_at").alias("created_at"), "open")
    keys = [c for c in alerts.columns if c != "open"]
    return alerts.groupBy(*keys).agg(F.min("open").alias("open"))


LATE_SCHEMA = "vehicle_id string, status string, zone string, event_ts timestamp"


def late_table(rows: DataFrame) -> DataFrame:
    """Row 31: the events that the watermark had passed when they came."""
    return rows.where(F.col("kind") == "late").select("vehicle_id", "status", "zone", F.col("last_event_ts").alias(TS))


def late_path(cfg: StreamConfig) -> str:
    return f"{cfg.vehicle_state.rstrip('/')}_late"


def vehicle_state_query(valid: DataFrame, cfg: StreamConfig) -> StreamingQuery:
    """Row 27 on a stream: state rows and alerts, each to an upsert log."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_upsert_batch(batch.where(F.col("kind") == "state").drop("kind", "alert_at", "open"),
                               batch_id, cfg.vehicle_state)
            write_upsert_batch(alert_table(batch, cfg.clock), batch_id, cfg.alerts)
            append_once(late_table(batch), late_path(cfg), f"vehicle_state-{batch_id}")
            _beat(batch, cfg, "vehicle_state", batch_id)
        finally:
            batch.unpersist()

    return (vehicle_state_stream(valid, threshold_minutes=cfg.idle_minutes).writeStream.outputMode("append").foreachBatch(write)
            .option("checkpointLocation", f"{cfg.checkpoints}/vehicle_state")
            .trigger(**cfg.state_trigger).queryName("vehicle_state").start())


def multi_query_app(spark: SparkSession, cfg: StreamConfig, path: str | None = None) -> list[StreamingQuery]:
    """Row 30: start the speed layer; callers wait with
    ``spark.streams.awaitAnyTermination()``. Each query builds its own source,
    as each needs its own offsets and checkpoint."""
    def decoded() -> DataFrame:
        return decoded_stream(raw_events(spark, cfg.source_format, cfg.source_options, path))

    def valid() -> DataFrame:
        return valid_events(decoded(), keep=["event_id"])

    if cfg.metrics:
        spark.streams.addListener(IngestMetrics(spark, cfg.metrics))
    dead = dead_letters(decoded(), keep=["event_id", "ingest_ts"])
    return [
        archive_query(valid_events(observe_ingest(decoded()), keep=["event_id"]), cfg),
        dead_letter_query(dead, cfg),
        window_query(valid(), cfg, by_zone=True),
        window_query(valid(), cfg, by_zone=False),
        vehicle_state_query(valid(), cfg),
    ]
