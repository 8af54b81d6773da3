import math

import numpy as np
import pytest

from mobility.llm import queries
from mobility.llm import whitening as op


def spectrum_matrix(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))
    return (q * np.asarray(values)) @ q.T


@pytest.mark.parametrize("values", [
    np.linspace(1, 9, 20), [5.0] * 12, [3, 3, 3, 2, 2, 1e-9, 0, 0, 0, 0], [1e12, 1e12 * (1 - 1e-13), 1, 1, 1, 1e-6], [0.0] * 6,
    [7.0], [2.0, 1.0], [1.0] * 3 + [1 - 1e-12] * 3 + [0.5] * 30])
def test_eigenvectors_to_double_precision(values):
    a = spectrum_matrix(values)
    a = (a + a.T) / 2
    want = np.sort(np.linalg.eigvalsh(a))[::-1][:8]
    got, vectors = op.leading_eigenvectors(a, 8)
    norm = max(np.abs(a).max(), 1e-300) * len(a)
    assert np.abs(got - want).max() <= 1e-14 * norm
    assert np.abs(vectors @ vectors.T - np.eye(len(got))).max() < 1e-13
    assert np.abs(a @ vectors.T - vectors.T * got).max() <= 1e-14 * norm


def test_diagonal_and_split_matrices():
    a = np.diag([4.0, 1.0, 4.0, 2.0, 4.0])
    got, vectors = op.leading_eigenvectors(a, 4)
    assert np.allclose(got, [4, 4, 4, 2], atol=1e-14)
    assert np.abs(a @ vectors.T - vectors.T * got).max() < 1e-13 and np.abs(vectors @ vectors.T - np.eye(4)).max() < 1e-13


def test_sturm_counts():
    d, e = np.array([2.0, -1.0, 0.5, 3.0]), np.array([0.3, 0.0, 1.5])
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.linspace(-3, 5, 41)
    assert op.sturm_counts(d, e, at).tolist() == [(values < x).sum() for x in at]


def expected(rows, k=8):
    """{id: [(component, deviation, |whitened|, explained)]} by whole integers and the library's solver."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    z = np.array([[r[j] * n - s[j] for j in range(d)] for r in x], dtype=object)
    cov = (z.T @ z).astype(float) / n**3
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    white = (z.astype(float) / n) @ vectors[:, :k] / np.sqrt(values[:k])
    return z, values, white, cov


def test_query_against_whole_integers(spark, tmp_path):
    rng = np.random.default_rng(4)
    # entries are small beside the offset, far from centred, and of falling spread
    x = (rng.normal(size=(700, 24)) * np.linspace(2, 0.1, 24) + 300) @ spectrum_matrix(np.linspace(1, 3, 24))
    rows = [(i, [float(np.float32(c)) for c in r]) for i, r in enumerate(x)]
    rows += [(5, rows[5][1]), (700, rows[9][1])]
    nan, inf = float("nan"), float("inf")
    bad = [(801, None), (802, []), (803, [nan] * 24), (804, [inf] + [0.0] * 23), (805, [None] + [0.0] * 23), (806, [1.0, 2.0])]
    spark.createDataFrame([(i, v, 1, "x") for i, v in rows + bad], "vec_id long, embedding array<float>, n int, deviation string") \
        .repartition(5).write.parquet(str(tmp_path / "embeddings.parquet"))
    out = queries.REGISTRY["op11_whitening"](spark, str(tmp_path))
    assert dict(out.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                                "explained": "double", "identity_error": "double"}
    got = out.collect()
    z, values, white, cov = expected(rows)
    assert len(got) == 8 * len(rows) and {r.n for r in got} == {len(rows)} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-9
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
    signs = {}
    for i, (key, _) in enumerate(rows):
        for c in range(1, 9):
            r = by[key, c][0]
            assert r.deviation == sum(int(v) ** 2 for v in z[i])
            assert abs(r.explained - values[c - 1] / np.trace(cov)) < 1e-12
            sign = signs.setdefault(c, 1 if r.whitened * white[i, c - 1] > 0 else -1)
            assert abs(sign * r.whitened - white[i, c - 1]) < 1e-8
    assert len(by[5, 1]) == 2


def test_real_vectors_are_white(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = op.components(df)
    rows = got.collect()
    ids = sorted({r.vec_id for r in rows})
    w = np.zeros((len(ids), 8))
    for r in rows:
        w[ids.index(r.vec_id), r.component - 1] = r.whitened
    cov = (w - w.mean(axis=0)).T @ (w - w.mean(axis=0)) / len(w)
    assert np.abs(cov - np.eye(8)).max() < 1e-10 and rows[0].identity_error < 1e-10


def test_defined_cases(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert op.components(one).count() == 0  # no variance
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert op.components(none).count() == 0 and op.components(none).columns[0] == "vec_id"
    bad = spark.createDataFrame([(1, None), (2, [None])], "vec_id long, embedding array<float>")
    assert op.components(bad).count() == 0
    line = spark.createDataFrame([(None, [0.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [1e300, 1.0]), (4, [1e18, 1.0])],
                                 "vec_id long, embedding array<double>")
    got = op.components(line).collect()
    # one direction of variance: one component; the entries out of range are left out
    assert sorted((r.vec_id is None, r.component, r.n, r.deviation) for r in got) == [
        (False, 1, 3, 1024**2), (False, 1, 3, 1024**2), (True, 1, 3, 2048**2)]
    assert all(abs(r.explained - 1) < 1e-12 for r in got)
    wide = spark.createDataFrame([(1, [4e12, 0.0]), (2, [-4e12, 1.0]), (3, [0.0, 5.0])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.deviation for r in op.components(wide).where("component = 1").collect()}
    assert got[1] is None and got[2] is None and got[3] is not None and got[3] > 0
