"""SQL access to the stored results.

``register_views`` exposes the tables the speed layer and the batch job
write under one root as temporary views with the serving-table names, so
users can keep querying them with SQL. The upsert logs are exposed through
their current-state view (newest batch per key). ``SERVING_SQL`` holds the
serving statements in Spark SQL; their parameters are bound, never rendered as text.
"""
from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from mobility.sinks.upsert import read_upsert_log
from mobility.sources.lake import path_exists

# view name -> (folder under the root, key columns of an upsert log or None)
TABLES = {
    "rt_zone_metrics": ("zone_metrics", ["window_start", "zone"]),
    "rt_fleet_metrics": ("fleet_metrics", ["window_start"]),
    "vehicle_state": ("vehicle_state", ["vehicle_id"]),
    "alerts": ("alerts", ["alert_type", "vehicle_id", "message"]),
    "daily_profitability": ("daily_profitability", None),
    "consistency_checks": ("consistency_checks", None),
    "expenses": ("expenses", None),
    "expense_rejects": ("expense_rejects", None),
    "processed_days": ("processed_days", None),
    "pipeline_heartbeats": ("heartbeats", None),
    "ingest_metrics": ("ingest_metrics", None),
    "rule_breaches": ("rule_breaches", None),
    "component_health": ("component_health", None),
}

SERVING_SQL = {
    "fleet_latest": "SELECT * FROM rt_fleet_metrics ORDER BY window_start DESC LIMIT 1",
    "zone_latest": """
        SELECT z.* FROM rt_zone_metrics z
        JOIN (SELECT zone, max(window_start) AS window_start FROM rt_zone_metrics GROUP BY zone) n
          ON z.zone = n.zone AND z.window_start = n.window_start""",
    "alerts": """
        SELECT * FROM alerts WHERE :vehicle_id IS NULL OR vehicle_id = :vehicle_id
        ORDER BY created_at DESC, vehicle_id, message LIMIT :limit""",
    "report_days": "SELECT DISTINCT sim_day FROM daily_profitability ORDER BY sim_day DESC",
    "profitability_report": """
        SELECT * FROM daily_profitability
        WHERE sim_day = coalesce(:sim_day, (SELECT max(sim_day) FROM daily_profitability))
          AND (NOT :unprofitable_only OR unprofitable)
        ORDER BY profit ASC NULLS LAST, vehicle_id""",
    "consistency_check": "SELECT * FROM consistency_checks WHERE sim_day = :sim_day",
    "pipeline_last_success": """
        SELECT component, max(at) AS last_success_at FROM pipeline_heartbeats GROUP BY component""",
}


def _table(spark: SparkSession, path: str, keys: list[str] | None) -> DataFrame:
    # Upsert logs are read with their compacted snapshots (``<folder>_snapshots``) when present.
    return read_upsert_log(spark, path, keys, snapshot=f"{path}_snapshots") if keys else spark.read.parquet(path)


def register_views(spark: SparkSession, root: str) -> list[str]:
    """Create a temporary view per stored table found under ``root``."""
    made = []
    for view, (folder, keys) in TABLES.items():
        path = f"{root.rstrip('/')}/{folder}"
        if not path_exists(spark, path):
            continue
        try:
            table = _table(spark, path, keys)
        except AnalysisException:  # written but still without data files (e.g. no rejects yet)
            continue
        table.createOrReplaceTempView(view)
        made.append(view)
    return made


#: SQL table functions of the serving reads: name -> (parameters, statement over the views).
SERVING_FUNCTIONS = {
    "fleet_now": ("", SERVING_SQL["fleet_latest"]),
    "zones_now": ("", SERVING_SQL["zone_latest"]),
    "alerts_of": ("vehicle STRING DEFAULT NULL, most INT DEFAULT 50", """
        SELECT * EXCEPT (place) FROM (
          SELECT *, row_number() OVER (ORDER BY created_at DESC, vehicle_id, message) AS place FROM alerts
          WHERE alerts_of.vehicle IS NULL OR vehicle_id = alerts_of.vehicle)
        WHERE place <= alerts_of.most"""),
    "reported_days": ("", SERVING_SQL["report_days"]),
    "profitability_of": ("day INT DEFAULT NULL, losses_only BOOLEAN DEFAULT false", """
        SELECT * FROM daily_profitability
        WHERE sim_day = coalesce(profitability_of.day, (SELECT max(sim_day) FROM daily_profitability))
          AND (NOT profitability_of.losses_only OR unprofitable)"""),
    "consistency_of": ("day INT", "SELECT * FROM consistency_checks WHERE sim_day = consistency_of.day"),
    "last_success": ("", SERVING_SQL["pipeline_last_success"]),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Row 6: create a temporary SQL table function for each serving read whose views are registered,
    so that ``SELECT * FROM profitability_of(15, true)`` works in any SQL of the session."""
    made = []
    for name, (parameters, statement) in SERVING_FUNCTIONS.items():
        needed = [v for v in TABLES if re.search(rf"\b{v}\b", statement)]
        if all(spark.catalog.tableExists(v) for v in needed):
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE RETURN {statement}")
            made.append(name)
    return made


DEFAULTS = {"vehicle_id": None, "limit": 50, "sim_day": None, "unprofitable_only": False}


def serving_query(spark: SparkSession, name: str, **params) -> DataFrame:
    """Run a serving statement with bound parameters."""
    if unknown := set(params) - set(DEFAULTS):
        raise ValueError(f"unknown parameters {sorted(unknown)}")
    text = SERVING_SQL[name]
    values = {k: v for k, v in {**DEFAULTS, **params}.items() if f":{k}" in text}
    return spark.sql(text, args=values)
