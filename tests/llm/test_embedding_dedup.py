import numpy as np
import pytest
from tests.llm.brute import components

from mobility.llm import embedding_dedup as op


def _vectors(seed=0, d=32):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, d))
    rows = [c + rng.normal(scale=s, size=d) * np.linalg.norm(c) / np.sqrt(d) for c in centres for s in (0.05, 0.1, 0.2, 0.25)]
    rows += [centres[0] + rng.normal(scale=0.15, size=d) for _ in range(120)] + [rows[1]] * 30 + [2 * rows[2]]
    return [r.astype(np.float32) for r in rows]


def _truth(rows):
    x = np.array(rows, dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T >= op.COSINE
    np.fill_diagonal(s, False)
    return s


@pytest.mark.parametrize("block_rows", [16, 2048])
def test_links_against_brute_force(spark, block_rows):
    rows = _vectors()
    df = spark.createDataFrame([(i, r.tolist(), 1) for i, r in enumerate(rows)], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in op.near_duplicates(df, block_rows=block_rows).collect()}
    s = _truth(rows)
    found = sum(r.n_links for r in got.values())
    assert len(got) == len(rows)
    assert all(got[i].n_links <= s[i].sum() for i in range(len(rows)))  # none below the limit, none twice
    assert found >= 0.9 * s.sum()                                       # recall
    want = components(range(len(rows)), [(int(a), int(b)) for a, b in zip(*np.nonzero(s), strict=True)])
    assert sum(got[i].component_id == want[i] for i in range(len(rows))) >= 0.97 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_blocks_change_nothing(spark):
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(_vectors(3))], "vec_id long, embedding array<float>")
    a, b = (sorted(map(tuple, op.near_duplicates(df, block_rows=n).collect())) for n in (8, 5000))
    assert a == b


def test_every_size_reaches_the_recall():
    near = op.collision(np.sqrt(2 - 2 * op.COSINE))
    for n in (0, 1, 10**3, 10**6, 10**9):
        k, tables = op.shape(n)
        assert 1 - (1 - near**k) ** tables >= op.RECALL


def test_collision_probability_is_that_of_the_hashes():
    rng = np.random.default_rng(1)
    for distance in (0.2, 0.6, 1.4):
        p, q = rng.normal(0, 1, 200_000) * distance, rng.uniform(0, op.WIDTH, 200_000)
        assert abs((np.floor((p + q) / op.WIDTH) == 0).mean() - op.collision(distance)) < 0.01


def test_defined_cases(spark):
    v = [1.0, 2.0, 3.0]
    nan, inf = float("nan"), float("inf")
    rows = [(1, v), (2, v), (2, v), (3, None), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 2.0]), (6, [nan, 1.0, 1.0]), (7, [inf, 0.0, 0.0]),
            (None, v), (8, [1.0, 2.0]), (9, []), (10, [2.0, 4.0, 6.0])]
    got = op.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == len(rows)
    by_id = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    assert by_id[1] == (2, 1, True) and by_id[2] == (2, 1, False) and by_id[10] == (2, 1, False)
    assert by_id[None] == (0, None, False)
    assert all(by_id[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9))
    assert op.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
