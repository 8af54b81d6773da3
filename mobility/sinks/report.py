"""Daily markdown report, built as text rows in Spark and written per day.

The report is a DataFrame of ``(sim_day, line_no, line)``: summary counts and
the consistency lines come from aggregates, the top-10 table from a per-day
``row_number() <= 10`` (a group limit applied before the shuffle). Nothing is
collected; each day's lines go to one task and one file, and dynamic partition
overwrite replaces a day's report in one commit.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mobility.operators.serve import report_summary, top_unprofitable

# Fixed report texts.
TITLE = "# Daily Fleet Profitability Report -- Sim Day "
TABLE_HEADER = ("| vehicle_id | trips | earnings | fuel_cost | maintenance_cost | profit | "
                "cost_per_km | service_flag | has_expenses |")
TABLE_RULE = "|---|---|---|---|---|---|---|---|---|"
NO_CHECK = "- Consistency check not yet computed."


def fmt2(c: Column) -> Column:
    """``f"{x:.2f}"``, or ``n/a`` for NULL."""
    # format_string writes a NULL as text of its own
    return F.when(c.isNotNull(), F.format_string("%.2f", c.cast("double"))).otherwise(F.lit("n/a"))


def pybool(c: Column) -> Column:
    return F.when(c, "True").otherwise("False")


def iso_now(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def daily_report(profit: DataFrame, check: DataFrame, generated_at: Column | None = None,
                 top_n: int = 10) -> DataFrame:
    """Report lines for every day present in ``profit``."""
    generated_at = generated_at if generated_at is not None else F.current_timestamp()
    s = report_summary(profit)
    c = check.select("sim_day", "speed_trips", "batch_trips", "speed_earnings",
                     "batch_earnings", "earnings_delta_pct", F.lit(True).alias("_has_check"))
    head = s.join(c, "sim_day", "left")
    has_check = F.col("_has_check").isNotNull()
    delta = F.when(F.col("earnings_delta_pct").isNotNull(),
                   F.concat(F.lit("- Earnings delta: "), fmt2(F.col("earnings_delta_pct")), F.lit("%"))
                   ).otherwise(F.lit("- Earnings delta: n/a"))
    lines = [
        F.concat(F.lit(TITLE), F.col("sim_day").cast("string")),
        F.lit(""),
        F.concat(F.lit("Generated: "), iso_now(generated_at)),
        F.lit(""),
        F.lit("## Summary"),
        F.concat(F.lit("- Vehicles reporting trips or expenses: "), F.col("vehicles").cast("string")),
        F.concat(F.lit("- Unprofitable vehicles: "), F.col("unprofitable_vehicles").cast("string")),
        F.concat(F.lit("- Total earnings (batch): "), fmt2(F.col("total_earnings"))),
        F.lit(""),
        F.lit("## Lambda consistency check (speed layer vs. batch layer)"),
        F.when(has_check, F.concat(F.lit("- Speed-layer trips: "), F.col("speed_trips").cast("string"),
                                   F.lit(", earnings: "), fmt2(F.col("speed_earnings")))).otherwise(F.lit(NO_CHECK)),
        F.when(has_check, F.concat(F.lit("- Batch-layer trips: "), F.col("batch_trips").cast("string"),
                                   F.lit(", earnings: "), fmt2(F.col("batch_earnings")))),
        F.when(has_check, delta),
        F.lit(""),
        F.lit("## Top unprofitable vehicles"),
        F.lit(""),
        F.lit(TABLE_HEADER),
        F.lit(TABLE_RULE),
    ]
    numbered = F.array(*[F.struct(F.lit(i).alias("line_no"), ln.alias("line")) for i, ln in enumerate(lines)])
    header_rows = (head.select("sim_day", F.explode(numbered).alias("l"))
                   .select("sim_day", "l.line_no", "l.line").where(F.col("line").isNotNull()))
    top = top_unprofitable(profit, top_n)
    row = F.concat_ws(" | ", F.col("vehicle_id"), F.col("trips").cast("string"), fmt2(F.col("earnings")),
                      fmt2(F.col("fuel_cost")), fmt2(F.col("maintenance_cost")), fmt2(F.col("profit")),
                      fmt2(F.col("cost_per_km")), pybool(F.col("service_flag")), pybool(F.col("has_expenses")))
    table_rows = top.select("sim_day", (F.lit(len(lines)) + F.col("rank")).alias("line_no"),
                            F.concat(F.lit("| "), row, F.lit(" |")).alias("line"))
    return header_rows.unionByName(table_rows)


def write_reports(report: DataFrame, root: str) -> None:
    """One text file per day under ``sim_day=<N>``; re-running a day replaces it."""
    (report.repartition("sim_day").sortWithinPartitions("sim_day", "line_no")
     .select("sim_day", "line").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("sim_day").text(root))
