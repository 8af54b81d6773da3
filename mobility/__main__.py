"""Command line: ``python -m mobility reconcile ...`` / ``python -m mobility stream ...``.

``reconcile`` runs the daily batch job for every pending day (or the days
given); ``stream`` starts the speed layer and waits; ``rules`` evaluates the alert rules
and the components' health over the stored tables; ``compact`` folds the
speed layer's upsert logs into snapshots (run it periodically). Storage locations are
folders or URIs under one ``--root``; the simulated calendar is explicit.
"""
from __future__ import annotations

import argparse
from datetime import datetime, timezone

from mobility.functions.clock import SimClock
from mobility.session import build_session


def _clock(args) -> SimClock:
    epoch = datetime.fromisoformat(args.epoch)
    epoch = epoch if epoch.tzinfo else epoch.replace(tzinfo=timezone.utc)
    return SimClock(epoch=epoch, day_seconds=args.day_seconds)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="mobility")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    p.add_argument("--epoch", required=True, help="simulated day 0 start, ISO date/time (UTC)")
    p.add_argument("--day-seconds", type=int, default=300)
    p.add_argument("--root", required=True, help="folder or URI holding lake, tables and checkpoints")
    sub = p.add_subparsers(dest="command", required=True)

    r = sub.add_parser("reconcile", help="daily batch job: profitability, consistency check, report")
    r.add_argument("--landing", required=True, help="folder of expenses_day_<N>.csv files")
    r.add_argument("--day", type=int, action="append", help="day to (re)run; default: all pending")
    r.add_argument("--threshold", type=float, default=0.0)

    s = sub.add_parser("stream", help="speed layer: archive, dead letters, windows, vehicle state")
    s.add_argument("--format", default="kafka", help="source format (kafka, or text for files)")
    s.add_argument("--bootstrap", help="Kafka bootstrap servers (required for kafka)")
    s.add_argument("--topic", help="telemetry topic (required for kafka)")
    s.add_argument("--path", default=None, help="input folder for file sources")
    s.add_argument("--dead-letter-topic", default=None, help="send dead letters to this Kafka topic")
    s.add_argument("--max-offsets-per-trigger", type=int, default=None, help="bound each micro-batch")
    s.add_argument("--idle-minutes", type=float, default=None, help="idle time before an alert")
    s.add_argument("--exact-windows", action="store_true",
                   help="exact distinct counts, each window emitted once when final (append mode)")

    m = sub.add_parser("rules", help="evaluate the alert rules and the components' health over the stored tables")
    m.add_argument("--until", default=None, help="ISO date/time (UTC) to evaluate up to; default: now")

    c = sub.add_parser("compact", help="fold the speed layer's upsert logs into snapshots")
    c.add_argument("--expire", action="store_true",
                   help="then delete the folded batches and older snapshots (when no reader is at them)")
    return p


# Upsert logs of the speed layer and their keys.
UPSERT_LOGS = {"zone_metrics": ["window_start", "zone"], "fleet_metrics": ["window_start"],
               "vehicle_state": ["vehicle_id"], "alerts": ["alert_type", "vehicle_id", "message"]}


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(args.master, app=f"mobility-{args.command}")
    root = args.root.rstrip("/")
    clock = _clock(args)
    if args.command == "compact":
        from mobility.sinks.upsert import compact_upsert_log, expire_upsert_log
        from mobility.sources.lake import path_exists

        for folder, keys in UPSERT_LOGS.items():
            if path_exists(spark, f"{root}/{folder}"):
                compact_upsert_log(spark, f"{root}/{folder}", keys, f"{root}/{folder}_snapshots")
                if args.expire:
                    expire_upsert_log(spark, f"{root}/{folder}", f"{root}/{folder}_snapshots")
    elif args.command == "rules":
        from mobility.plans import monitoring

        until = datetime.fromisoformat(args.until) if args.until else datetime.now(timezone.utc)
        monitoring.run(spark, root, clock, until if until.tzinfo else until.replace(tzinfo=timezone.utc))
    elif args.command == "reconcile":
        from mobility.plans import reconciliation

        cfg = reconciliation.BatchConfig(
            clock=clock, lake=f"{root}/lake", landing=args.landing, fleet_metrics=f"{root}/fleet_metrics",
            profitability=f"{root}/daily_profitability", expense_rejects=f"{root}/expense_rejects",
            consistency=f"{root}/consistency_checks", reports=f"{root}/reports",
            heartbeats=f"{root}/heartbeats", threshold=args.threshold)
        reconciliation.run(spark, cfg, days=args.day)
    else:
        from mobility.streaming import app

        if args.format == "kafka" and not (args.bootstrap and args.topic):
            raise SystemExit("--bootstrap and --topic are required with --format kafka")
        options = (app.kafka_options(args.bootstrap, args.topic, args.max_offsets_per_trigger)
                   if args.format == "kafka" else {})
        dlq_format, dlq_options = "parquet", {}
        if args.dead_letter_topic:
            dlq_format = "kafka"
            dlq_options = {"kafka.bootstrap.servers": args.bootstrap, "topic": args.dead_letter_topic}
        cfg = app.StreamConfig(
            clock=clock, lake=f"{root}/lake", dead_letters=f"{root}/dead_letters",
            zone_metrics=f"{root}/zone_metrics", fleet_metrics=f"{root}/fleet_metrics",
            vehicle_state=f"{root}/vehicle_state", alerts=f"{root}/alerts",
            checkpoints=f"{root}/checkpoints", source_format=args.format, source_options=options,
            dead_letter_format=dlq_format, dead_letter_options=dlq_options, exact_windows=args.exact_windows, heartbeats=f"{root}/heartbeats",
            metrics=f"{root}/ingest_metrics",
            **({"idle_minutes": args.idle_minutes} if args.idle_minutes is not None else {}))
        app.multi_query_app(spark, cfg, path=args.path)
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
