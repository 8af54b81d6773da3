"""Helpers shared by the training-data operators."""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from mobility.session import shared_path

T = TypeVar("T")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written to a fresh folder of the shared checkpoint directory and
    read back: later uses neither recompute it nor depend on its lineage, and
    the copy survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, "mobility-llm", f"{name}-{uuid.uuid4().hex}")
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name like ``base`` that no column of ``df`` has (any case)."""
    taken = {c.lower() for c in df.columns}
    name, n = base, 0
    while name.lower() in taken:
        n += 1
        name = f"{base}_{n}"
    return name


def with_replaced(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator is about to add (any case):
    an input column of an output's name gives way to the output."""
    drop = {n.lower() for n in names}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in drop])


def binary_values(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    if pa.types.is_large_string(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    if pa.types.is_string(column.type):
        return column.cast(pa.binary()).to_pylist()
    return column.to_pylist()


_HELD: list = [None, None]


def held(key: object, make: Callable[[], T]) -> T:
    """What ``make`` gives, kept in this Python worker for the next task that
    asks for the same key. A worker keeps one such object: that of another operator
    goes, so that a chain of operators doesn't fill the workers' memory."""
    if _HELD[0] != key:
        _HELD[:] = [None, None]
        _HELD[:] = [key, make()]
    return _HELD[1]


def slices(batch: pa.RecordBatch, limit: int, column: str) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that one piece's ``column`` holds about ``limit`` bytes
    (one row at least): what is made from a piece stays small in memory."""
    arr = batch.column(column)
    sizes = pc.binary_length(arr).fill_null(0).to_pylist() if batch.num_rows else []
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)
    pa.default_memory_pool().release_unused()
