"""Landing zone of daily expense CSV files: listing and typed scan."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mobility.operators.reconcile import EXPENSE_FILE_PATTERN
from mobility.schema import COST, EXPENSE_COLUMNS

#: A cell of a CSV line, after its comma.
CELL = r',("(?:[^"]|"")*"|[^,]*)'

# Fixed value lists matching the pandas CSV reader the reference uses: texts it
# reads as missing, and the texts that mean a true service flag.
MISSING_TEXTS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
                 "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
TRUE_TEXTS = ["true", "1", "yes"]

# Plain decimal numbers only: Spark's cast would also take "1d", "1f" or "0x1p3".
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def landing_files(spark: SparkSession, landing: str, glob: str = "*.csv") -> DataFrame:
    """Row 5 input: the landing zone's file paths (``binaryFile`` with only the
    path selected, so file contents are never read)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(landing).select("path"))


def to_number(text: Column) -> Column:
    """Numeric coercion: unparsable or missing text -> 0.0."""
    parsed = F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))
    return F.coalesce(parsed, F.lit(0.0))


def to_flag(text: Column) -> Column:
    return F.coalesce(F.lower(text).isin(*TRUE_TEXTS), F.lit(False))


def _cells(line: Column) -> Column:
    """The cells of a CSV line, however many: plain, or in quotes with a quote doubled inside."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(CELL), F.lit(1))
    return F.transform(cells, lambda c: F.when(
        c.startswith('"'), F.regexp_replace(c.substr(F.lit(2), F.length(c) - 2), '""', '"')).otherwise(c))


def expenses_scan(spark: SparkSession, landing: str | list[str], pattern: str = EXPENSE_FILE_PATTERN,
                  missing_columns: bool = False) -> DataFrame:
    """Row 4: landed expense files (a folder, or a list of files), typed, with
    ``sim_day`` from the file's name.

    A file's header is its first line, by place, whatever other lines hold. Columns are found by the names in
    it, in any order and number. Values are read as text and coerced here, so a bad one never fails the
    read: costs and distances that are not numbers become 0.0, numbers that don't fit their type NULL (the load
    rejects them). A column that a file doesn't have reads as missing; with ``missing_columns`` a column of that
    name lists those of each row (NULL: none), and the load rejects such rows by it."""
    lines = (spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").text(landing)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
             .where(F.trim("value") != ""))
    # Ids rise in the order of a split's lines, so the least one of a file's first block is its first line.
    header = (lines.where("block = 0").withColumn("at", F.monotonically_increasing_id())
              .groupBy("file").agg(F.min_by("value", "at").alias("header")))
    # A data row never equals the header: it would hold the columns' names as values.
    named = lines.join(header, "file").where("value <> header or block <> 0")
    cells = named.select("file", _cells(F.col("value")).alias("cells"),
                         F.transform(_cells(F.regexp_replace("header", "^\ufeff", "")), lambda c: F.trim(c)).alias("header"))

    def column(name: str) -> Column:
        at = F.array_position("header", name).cast("int")
        return F.when(at > 0, F.try_element_at("cells", F.nullif(at, F.lit(0)))).alias(name)

    lacks = F.array_join(F.array_except(F.array(*[F.lit(c) for c in EXPENSE_COLUMNS]), F.col("header")), ",")
    raw = cells.select("file", *[column(c) for c in EXPENSE_COLUMNS], F.nullif(lacks, F.lit("")).alias("missing_columns"))
    missing = F.col("vehicle_id").isin(*MISSING_TEXTS)
    return raw.select(
        F.when(~missing, F.col("vehicle_id")).alias("vehicle_id"),
        F.regexp_extract(F.col("file"), pattern, 1).try_cast("int").alias("sim_day"),
        to_number(F.col("fuel_cost")).try_cast(COST).alias("fuel_cost"),
        to_number(F.col("maintenance_cost")).try_cast(COST).alias("maintenance_cost"),
        to_number(F.col("distance_covered")).try_cast(COST).alias("distance_covered"),
        to_flag(F.col("service_flag")).alias("service_flag"),
        *(["missing_columns"] if missing_columns else []),
    )


def write_landing(expenses: DataFrame, landing: str) -> None:
    """Land expense rows as CSV, one folder ``expenses_day_<N>.csv`` per day."""
    out = expenses.select(F.concat(F.lit("expenses_day_"), F.col("sim_day").cast("string"),
                                   F.lit(".csv")).alias("_file"), *EXPENSE_COLUMNS)
    (out.repartitionByRange("_file", "vehicle_id").write.mode("overwrite").partitionBy("_file")
     .option("header", True).csv(landing))
