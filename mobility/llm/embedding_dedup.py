"""Embedding near-duplicates by Euclidean p-stable hashing.

Vectors are normalised; a cosine of at least ``cosine`` is then a distance of at most
``sqrt(2 - 2 * cosine)``. A hash is ``floor((a . v + b) / width)`` with Gaussian ``a``
and uniform ``b``; ``k`` of them together are a vector's bucket in one
table, and there are as many tables as make a pair at just that distance meet
in one with probability ``recall`` (closer pairs more often). ``k`` grows with the
logarithm of the number of vectors, so that vectors far apart seldom meet. Pairs
that meet are compared by exact cosine in double precision.

Equal vectors are folded into one class before hashing, so copies cost nothing.
A bucket of more than ``block_rows`` classes is cut into blocks, and every two blocks
of it are compared in a task of their own: no bucket meets in one task, none is
capped. A pair counts in the first table where it meets, so numbers of links
are exact for the pairs found. Of the pairs only the sums per vector and
the links that join two groups leave a task.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components
link with nothing; so do vectors of different lengths, and rows with a null id
(component null, not kept). A row that repeats an id and a vector is the same vector;
rows of one id with different vectors are different vectors, with a result each. An empty
table gives no rows. Other columns (labels) have no influence and are not returned.
"""
from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mobility.llm.common import written
from mobility.llm.components import connected_components

COSINE = 0.95
RECALL = 0.97
#: Width of a hash's cells. At cosine 0.95 two vectors share a cell with
#: probability 0.83, orthogonal ones with 0.39.
WIDTH = 1.5
SEED = 20_011
#: Classes of a bucket that are compared in one go.
BLOCK_ROWS = 2048
#: Vectors far apart that a bucket may hold by chance, about.
CHANCE_ROWS = 32


def collision(distance: float, width: float = WIDTH) -> float:
    """Probability that vectors at a distance share a cell."""
    r = width / distance
    return 1 - math.erfc(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def shape(n: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(hashes of a bucket, tables) for ``n`` vectors."""
    near, far = collision(math.sqrt(2 - 2 * cosine)), collision(math.sqrt(2))
    k = max(4, math.ceil(math.log(max(n, 1) / CHANCE_ROWS + 1) / -math.log(far)))
    return k, max(1, math.ceil(math.log(1 - recall) / math.log(1 - near**k)))


def buckets(x: np.ndarray, k: int, tables: int, width: float = WIDTH, seed: int = SEED) -> np.ndarray:
    """Bucket (64 bits) of each normalised row of ``x`` in each table."""
    rng = np.random.default_rng([seed, x.shape[1], k, tables])
    a = rng.standard_normal((x.shape[1], tables * k))
    b = rng.uniform(0, width, tables * k)
    mix = rng.integers(1, 1 << 62, tables * k, dtype=np.int64) * 2 + 1
    cells = np.floor((x @ a + b) / width).astype(np.int64)
    with np.errstate(over="ignore"):
        return (cells * mix).reshape(len(x), tables, k).sum(axis=2)


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def classes_of(df: DataFrame, id_col: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """(a row per input row: ``vec_id, h1, h2``; a row per class: ``h1, h2, d, rep, n, v``).

    Rows that can't link have null hashes.
    """
    v = F.col("v")
    kind = df.schema[vector].dataType.elementType
    if not isinstance(kind, T.FloatType):
        kind = T.DoubleType()
    raw = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                    F.col(f"`{vector}`").cast(T.ArrayType(kind)).alias("v"))
    fine = (F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
            & F.exists(v, lambda x: x != 0))
    hashed = raw.select("vec_id", "v", F.when(fine, F.xxhash64("v")).alias("h1"), F.when(fine, F.hash("v", F.lit(7))).alias("h2"))
    classes = (hashed.where("h1 is not null").groupBy("h1", "h2", F.size("v").alias("d"))
               .agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("n"), F.first("v").alias("v")))
    return hashed.select("vec_id", "h1", "h2"), classes


def signatures(classes: DataFrame, k: int, tables: int) -> DataFrame:
    """``classes`` with ``sig``, the bucket in each table."""
    schema = T.StructType([*classes.schema.fields, T.StructField("sig", T.ArrayType(T.LongType()))])
    names = [*classes.columns, "sig"]
    d_at, v_at = names.index("d"), names.index("v")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = whole.column(d_at).to_numpy()
            for d in np.unique(sizes).tolist():
                batch = whole.filter(pa.array(sizes == d))
                sig = buckets(_unit(_matrix(batch.column(v_at), batch.num_rows)), k, tables)
                flat = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, sig.size + 1, tables, dtype=np.int32)), pa.array(sig.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, flat], names=names)

    return classes.mapInArrow(run, schema)


def _compare(rep, n, x, sig, block, t, same_block, cosine, sums, roots) -> list[tuple[int, int]]:
    """Compare the rows of a bucket (of one block, or those of two blocks across).

    Adds to ``sums`` (links by row); returns the pairs that join two groups.
    """
    links = []
    left = np.arange(len(rep)) if same_block else np.flatnonzero(block == block.min())
    right = left if same_block else np.flatnonzero(block != block.min())
    for s in range(0, len(left), 256):
        mine = left[s: s + 256]
        i, j = np.nonzero(x[mine] @ x[right].T >= cosine)
        i, j = mine[i], right[j]
        if same_block:
            i, j = i[i < j], j[i < j]
        if t and len(i):
            new = ~(sig[i, :t] == sig[j, :t]).any(axis=1)  # met in no table before
            i, j = i[new], j[new]
        np.add.at(sums, i, n[j])
        np.add.at(sums, j, n[i])
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            while roots[a] != a:
                roots[a] = a = roots[roots[a]]
            while roots[b] != b:
                roots[b] = b = roots[roots[b]]
            if a != b:
                roots[a] = b
                links.append((int(rep[a]), int(rep[b])))
    return links


def compare_buckets(signed: DataFrame, cosine: float = COSINE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``a, b, links``: with ``b`` a link between classes, without it ``links`` more vectors linked to ``a``."""
    placed = signed.select("d", "rep", "n", "v", "sig", F.posexplode("sig").alias("t", "h"))
    large = (signed.select("d", F.posexplode("sig").alias("t", "h")).groupBy("d", "t", "h").agg(F.count(F.lit(1)).alias("rows"))
             .where(F.col("rows") > block_rows)
             .select("d", "t", "h", F.ceil(F.col("rows") / block_rows).cast("int").alias("blocks")))
    cut = placed.join(large, ["d", "t", "h"], "left").withColumn(
        "block", F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")))
    other = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0)))
                      .otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = ["d", "t", "h", "i", "j"]
    rows = (cut.select("*", other.alias("o"))
            .select("d", "t", "h", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"),
                    "block", "rep", "n", "v", "sig")
            .repartition(*keys).sortWithinPartitions(*keys, "rep"))
    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])

    def group(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        m = batch.num_rows
        t, i, j = (batch.column(c)[0].as_py() for c in ("t", "i", "j"))
        rep, n, block = (batch.column(c).to_numpy() for c in ("rep", "n", "block"))
        x = _unit(_matrix(batch.column("v"), m))
        sig = batch.column("sig").flatten().to_numpy().reshape(m, -1)
        if i != j and (block == block[0]).all():
            return
        sums = np.zeros(m, dtype=np.int64)
        links = _compare(rep, n, x, sig, block, t, i == j, cosine, sums, list(range(m)))
        some = np.flatnonzero(sums)
        if len(some):
            yield pa.RecordBatch.from_arrays(
                [pa.array([*rep[some].tolist(), *(a for a, _ in links)], type=pa.int64()),
                 pa.array([None] * len(some) + [b for _, b in links], type=pa.int64()),
                 pa.array([*sums[some].tolist(), *[0] * len(links)], type=pa.int64())], schema=out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the rows so far of a group that may go on

        def close() -> Iterator[pa.RecordBatch]:
            if held and sum(b.num_rows for b in held) > 1:
                yield from group(pa.concat_batches(held))
            held.clear()

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy() for c in keys]
            change = np.zeros(batch.num_rows, dtype=bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            first = tuple(c[0] for c in columns)
            if last is not None and first != last:
                yield from close()
            starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                if a:
                    yield from close()
                held.append(batch.slice(a, b - a))
            last = tuple(c[-1] for c in columns)
        yield from close()

    return rows.mapInArrow(run, "a long, b long, links long")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", cosine: float = COSINE,
                    recall: float = RECALL, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    members, grouped = classes_of(df, id_col, vector)
    classes = written(grouped, "embedding-classes")
    k, tables = shape(classes.count(), cosine, recall)
    signed = written(signatures(classes, k, tables), "embedding-signatures")
    found = written(compare_buckets(signed, cosine, block_rows), "embedding-links")
    sums = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    # A class of several ids holds one of them; the others follow it by their hashes.
    parts = connected_components(found.where("b is not null").select("a", "b"))
    result = written(
        classes.select("h1", "h2", "rep", "n")
        .join(sums, F.col("rep") == F.col("a"), "left").join(parts, F.col("rep") == F.col("node"), "left")
        .select("h1", "h2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
                F.coalesce("component", "rep").alias("component")), "embedding-components")
    out = members.join(result, ["h1", "h2"], "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"))
    return out.select(F.col("vec_id").alias(id_col), "n_links", "component_id",
                      F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
