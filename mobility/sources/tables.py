"""Reading the result tables back (row 6): by catalog name, by path, or
through any Spark data source (e.g. ``jdbc`` with its options)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def serving_read(spark: SparkSession, table: str, fmt: str | None = None,
                 options: dict | None = None) -> DataFrame:
    """``table`` is a catalog name when no format is given, else a path (or,
    for sources such as ``jdbc``, the ``dbtable`` option)."""
    if fmt is None:
        return spark.table(table)
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt == "jdbc":
        return reader.option("dbtable", table).load()
    return reader.load(table)
