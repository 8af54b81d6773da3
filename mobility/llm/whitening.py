"""Whitening of embeddings by the eigenvectors of their covariance.

Entries become fixed-point integers ``x = floor(scale * c) + offset``, so counts and
sums are exact. The fit takes every usable vector:

1. the number of vectors and each dimension's sum, exact, from partial sums a task;
2. the covariance, centred before multiplying: a task adds up the products of its centred
   vectors, a row of the matrix is added up over the tasks;
3. on the driver (the matrix is dimensions squared, whatever the number of vectors): Householder
   reflections to a tridiagonal matrix, bisection by Sturm counts for the leading eigenvalues,
   inverse iteration for their vectors, those of close eigenvalues made orthogonal again;
4. the covariance of the projected and scaled vectors against the identity, like step 2;
5. the projection itself, from broadcast components (dimensions x components), no shuffle.

A centred entry is ``x - S // n``, an exact integer, less ``(S mod n) / n`` in [0, 1): one rounding.

Defined cases. Not usable, and left out: vectors that are null, empty, hold null or
non-finite entries, or entries of which ``scale * c`` is no exact integer after ``floor`` (2**53 and more).
The dimension is the commonest length of usable vectors (the longest of ties); others have no
covariance with them and are left out. Components of no variance (to rounding) have no whitened
value and no rows: equal vectors only, one vector, fewer vectors than components. ``deviation`` is null
where it is beyond a long. Rows that repeat an id or a vector each count and get results; a null id stays null; an
empty table gives no rows. Other columns have no influence and are not returned.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE = 1024.0
OFFSET = 100_000
COMPONENTS = 8
#: Vectors in one matrix product.
BLOCK_ROWS = 4096
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


# --- eigenvectors of a symmetric matrix -------------------------------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """(diagonal, off-diagonal, reflections) of a symmetric matrix by Householder's method."""
    a = np.array(a, dtype=np.float64)
    d = len(a)
    reflections = []
    for k in range(d - 2):
        x = a[k + 1:, k]
        rest = np.linalg.norm(x[1:])
        if rest == 0.0:
            continue
        v = x.copy()
        v[0] += math.copysign(math.hypot(x[0], rest), x[0])
        v /= np.linalg.norm(v)
        # both sides of the trailing block at once: a - v w' - w v'
        block = a[k + 1:, k + 1:]
        p = block @ v
        w = 2 * (p - (v @ p) * v)
        block -= np.outer(v, w)
        block -= np.outer(w, v)
        column = a[k + 1:, k] - 2 * v * (v @ a[k + 1:, k])
        a[k + 1:, k] = column
        a[k, k + 1:] = column
        reflections.append((k, v))
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix are below each value of ``at``."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    squares = off * off
    floor = max(tiny, np.finfo(float).eps ** 2 * float(squares.max(initial=0.0)))
    count = np.zeros(len(at), dtype=np.int64)
    q = np.ones(len(at))
    for i in range(len(diagonal)):
        q = diagonal[i] - at - (squares[i - 1] / q if i else 0.0)
        q = np.where(np.abs(q) < floor, -floor, q)
        count += q < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` greatest eigenvalues, falling, by bisection down to neighbouring doubles."""
    d = len(diagonal)
    radius = np.zeros(d)
    radius[:-1] += np.abs(off)
    radius[1:] += np.abs(off)
    low = np.full(k, (diagonal - radius).min())
    high = np.full(k, (diagonal + radius).max())
    pad = np.finfo(float).eps * max(abs(low[0]), abs(high[0])) * d + np.finfo(float).tiny
    low, high = low - pad, high + pad
    rank = d - np.arange(k)  # the i-th greatest has d - i - 1 below it
    for _ in range(200):
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        above = sturm_counts(diagonal, off, middle) >= rank
        high = np.where(above, middle, high)
        low = np.where(above, low, middle)
    return low + (high - low) / 2


def _solver(diagonal: np.ndarray, off: np.ndarray, at: float) -> Callable[[np.ndarray], np.ndarray]:
    """Solves (matrix - at) x = b by elimination with partial pivoting."""
    d = len(diagonal)
    scale = max(float(np.abs(diagonal).max(initial=0.0)), float(np.abs(off).max(initial=0.0)), np.finfo(float).tiny)
    least = np.finfo(float).eps * scale
    main = (diagonal - at).tolist()
    up, up2, steps = [*off.tolist(), 0.0], [0.0] * d, []
    for i in range(d - 1):
        below = float(off[i])
        swap = abs(below) > abs(main[i])
        if swap:
            main[i], below = below, main[i]
            up[i], main[i + 1] = main[i + 1], up[i]
            up2[i], up[i + 1] = up[i + 1], 0.0
        if main[i] == 0.0:
            main[i] = least
        f = below / main[i]
        main[i + 1] -= f * up[i]
        up[i + 1] -= f * up2[i]
        steps.append((swap, f))
    if abs(main[-1]) < least:
        main[-1] = least

    def solve(b: np.ndarray) -> np.ndarray:
        x = b.tolist()
        for i, (swap, f) in enumerate(steps):
            if swap:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= f * x[i]
        for i in range(d - 1, -1, -1):
            s = x[i]
            if i + 1 < d:
                s -= up[i] * x[i + 1]
            if i + 2 < d:
                s -= up2[i] * x[i + 2]
            x[i] = s / main[i]
        out = np.array(x)
        return out / np.abs(out).max()

    return solve


def leading_eigenvectors(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as rows) of a symmetric matrix, the ``k`` greatest."""
    d = len(a)
    k = min(k, d)
    top = float(np.abs(a).max(initial=0.0))
    if top == 0.0:
        return np.zeros(k), np.eye(k, d)
    unit = 2.0 ** math.frexp(top)[1]  # exact scaling, away from overflow
    diagonal, off, reflections = tridiagonal(a / unit)
    norm = float(np.abs(diagonal).max()) + 2 * float(np.abs(off).max(initial=0.0))
    values = leading_eigenvalues(diagonal, off, k)
    vectors = np.zeros((k, d))
    rng = np.random.default_rng(11)
    cluster = 0
    for i in range(k):
        if i and values[i - 1] - values[i] > 1e-3 * norm:
            cluster = i  # far enough from the one before: orthogonal by itself
        solve = _solver(diagonal, off, float(values[i]) - 4 * (i - cluster) * np.finfo(float).eps * norm)
        x = rng.standard_normal(d)
        for _ in range(5):
            x = solve(x)
            for _ in range(2):
                x -= vectors[cluster:i].T @ (vectors[cluster:i] @ x)
            x /= np.linalg.norm(x)
        vectors[i] = x
    for step, v in reversed(reflections):
        part = vectors[:, step + 1:]
        part -= 2 * np.outer(part @ v, v)
    return values * unit, vectors


# --- the distributed steps --------------------------------------------------------------

class Fit(NamedTuple):
    """``n`` vectors with exact ``sums``; the leading eigenvalues and vectors (rows) of
    their covariance, its trace, and the whitened vectors' distance from unit covariance."""
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def _usable(df: DataFrame, id_col: str, vector: str, scale: float) -> DataFrame:
    """``id, v``: rows whose entries are all exact after scaling."""
    raw = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector}`").cast(T.ArrayType(T.DoubleType())).alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * F.lit(scale)) < _EXACT))
    return raw.where(F.col("v").isNotNull() & (F.size("v") > 0) & fine)


def _integers(column: pa.Array, rows: int, scale: float, offset: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat * scale).astype(np.int64).reshape(rows, -1) + offset


def _blocks(batches: Iterable[pa.RecordBatch], name: str = "v") -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(at, BLOCK_ROWS)


def exact_sums(usable: DataFrame, d: int, scale: float, offset: int) -> list[int]:
    """The sum of each dimension's integers."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * d
        for b in _blocks(batches):
            x = _integers(b.column("v"), b.num_rows, scale, offset)
            # in two halves, as a block's sum may be beyond 64 bits
            high, low = (x >> 26).sum(axis=0), (x & ((1 << 26) - 1)).sum(axis=0)
            total = [t + (h << 26) + s for t, h, s in zip(total, high.tolist(), low.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), type=pa.int32()), pa.array([str(t) for t in total])], names=["i", "s"])

    parts = usable.select("v").mapInArrow(run, "i int, s string")
    rows = parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    return [int(r["s"]) for r in sorted(rows, key=lambda r: r["i"])]


def _centred(x: np.ndarray, whole: np.ndarray, part: np.ndarray) -> np.ndarray:
    return (x - whole) - part


def products(usable: DataFrame, d: int, vectors_of: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """Sum of the outer products of ``vectors_of`` each block's rows (``d`` wide).

    A task sends ``d`` rows; each row of the matrix is added up by one task, a
    running sum over as many rows as there are tasks.
    """
    schema = "i int, row array<double>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for b in _blocks(batches):
            z = vectors_of(b)
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(list(total))], names=["i", "row"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            block = b.column(1).flatten().to_numpy().reshape(b.num_rows, d)
            for i, row in zip(b.column(0).to_pylist(), block, strict=True):
                sums[i] = sums[i] + row if i in sums else row.copy()
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), type=pa.int32()), pa.array(list(sums.values()))], names=["i", "row"])

    out = np.zeros((d, d))
    for r in usable.select("v").mapInArrow(run, schema).repartition("i").mapInArrow(add, schema).collect():
        out[r["i"]] = r["row"]
    return (out + out.T) / 2


def _projector(n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, scale: float, offset: int):
    """(integers of a block, their whitened components) of a block of rows."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    part = np.array([(s % n) / n for s in sums])
    basis = vectors.T / np.sqrt(values)

    def project(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        x = _integers(b.column("v"), b.num_rows, scale, offset)
        return x, _centred(x, whole, part) @ basis

    return project


def _with_dimension(df: DataFrame, id_col: str, vector: str, scale: float) -> tuple[DataFrame, int, int]:
    """(usable rows of the commonest length, that length, their number)"""
    usable = _usable(df, id_col, vector, scale)
    top = (usable.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), F.desc("d")).limit(1).collect())
    if not top:
        return usable, 0, 0
    return usable.where(F.size("v") == top[0]["d"]), top[0]["d"], top[0]["n"]


def fit(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
        scale: float = SCALE, offset: int = OFFSET) -> Fit:
    """Fit over every usable vector of ``df``."""
    usable, d, n = _with_dimension(df, id_col, vector, scale)
    if not n:
        return Fit(0, [], np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    sums = exact_sums(usable, d, scale, offset)
    whole = np.array([s // n for s in sums], dtype=np.int64)
    part = np.array([(s % n) / n for s in sums])
    covariance = products(
        usable, d, lambda b: _centred(_integers(b.column("v"), b.num_rows, scale, offset), whole, part)) / n
    values, vectors = leading_eigenvectors(covariance, components)
    trace = float(np.trace(covariance))
    real = values > max(d, 16) * np.finfo(float).eps * max(trace, np.finfo(float).tiny)
    values, vectors = values[real], vectors[real]
    error = 0.0
    if len(values):
        project = _projector(n, sums, values, vectors, scale, offset)
        # The whitened vectors' sums come with their products, as one more column of ones.
        both = products(usable, len(values) + 1, lambda b: np.column_stack([project(b)[1], np.ones(b.num_rows)]))
        mean = both[-1, :-1] / n
        error = float(np.abs(both[:-1, :-1] / n - np.outer(mean, mean) - np.eye(len(values))).max())
    return Fit(n, sums, values, vectors, trace, error)


def _deviations(x: np.ndarray, n: int, sums: list[int], whole: np.ndarray, rest: np.ndarray) -> list[int | None]:
    """Sum over the dimensions of ``(n * x - S)**2``, exact; None beyond a long."""
    y = x - whole
    bound = n * (int(np.abs(y).max(initial=0)) + 1)
    if bound * bound * max(x.shape[1], 1) <= _LONG:
        z = y * n - rest
        return (z * z).sum(axis=1).tolist()
    out = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [v if v <= _LONG else None for v in out]


def whiten(df: DataFrame, model: Fit, id_col: str = "vec_id", vector: str = "embedding", scale: float = SCALE,
           offset: int = OFFSET) -> DataFrame:
    """``vec_id, whitened`` (its components), ``deviation`` of each usable row of the fit's length."""
    d, n, sums = len(model.sums), model.n, model.sums
    usable = _usable(df, id_col, vector, scale).where(F.size("v") == d)
    shared = df.sparkSession.sparkContext.broadcast((model.values, model.vectors))
    id_type = usable.schema["id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not n:
            return
        project = _projector(n, sums, *shared.value, scale, offset)
        whole = np.array([s // n for s in sums], dtype=np.int64)
        rest = np.array([s % n for s in sums], dtype=np.int64)
        for b in _blocks(batches):
            x, w = project(b)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(list(w), type=pa.list_(pa.float64())),
                 pa.array(_deviations(x, n, sums, whole, rest), type=pa.int64())], names=[id_col, "whitened", "deviation"])

    return usable.mapInArrow(run, f"`{id_col}` {id_type}, whitened array<double>, deviation long")


def components(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """A row per usable vector and component: ``vec_id, component, n, deviation, whitened,
    explained, identity_error``."""
    model = fit(df, id_col, vector, k)
    wide = whiten(df, model, id_col, vector)
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values]) if len(model.values) else F.array(F.lit(0.0))
    return wide.select(f"`{id_col}`", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        f"`{id_col}`", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(model.identity_error).alias("identity_error"))
