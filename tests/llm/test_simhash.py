import random

import pytest
from tests.llm.brute import components, simhash

from mobility.llm import simhash as op


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "a B", "x y z", "É a é a é a", "to be or not to be or not to be", "a\x0bb\x0cc d"])
def test_fingerprint(text):
    assert op.fingerprint(text.encode() if text is not None else None) == simhash(text)


def _near(value, bits, rng):
    for b in rng.sample(range(64), bits):
        value ^= 1 << b
    return value


@pytest.mark.parametrize("bucket_rows", [2, 1024])
def test_links_lose_no_pair(spark, bucket_rows):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    values = list({*base, 0, *(_near(b, k, rng) for b in base for k in (1, 2, 3, 4)),
                   *(_near(base[0], 2, rng) for _ in range(150))})
    reps = spark.createDataFrame([(i, op._signed(v)) for i, v in enumerate(values)], "rep long, fp long")
    links = [tuple(r) for r in op.fingerprint_links(reps, bucket_rows=bucket_rows).collect()]
    assert all((values[a] ^ values[b]).bit_count() <= 2 for a, b in links)
    every = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 2]
    assert components(range(len(values)), links) == components(range(len(values)), every)


def test_bk_tree_finds_all_within_the_radius():
    rng = random.Random(8)
    tree, values = op.BKTree(2), []
    for _ in range(300):
        v = _near(rng.choice(values), rng.randint(1, 3), rng) if values and rng.random() < 0.8 else rng.getrandbits(64)
        assert {tree.values[i] for i in tree.within(v)} == {x for x in tree.values if (x ^ v).bit_count() <= 2}
        if v not in values:
            values.append(v)
            tree.add(v)


def test_table_and_defined_cases(spark):
    rng = random.Random(2)
    long = " ".join(rng.choices(["ab", "cd", "ef", "gh", "ij", "kl"], k=3000))
    rows = [(9, "one two three four"), (4, "One two THREE four"), (7, None), (5, ""), (3, "  "), (None, "one two three four"),
            (8, long), (2, long + " zz"), (8, long), (11, "q"), (11, "one two three four"), (12, "Q")]
    df = spark.createDataFrame([(*r, "e") for r in rows], "doc_id long, text string, component_id string")
    got = op.near_duplicates(df)
    known = [(i, simhash(t)) for i, t in rows if i is not None]
    links = [(a, b) for a, x in known for b, y in known if (x ^ y).bit_count() <= 2]
    want = components({i for i, _ in known}, links)
    result = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()), key=str)
    assert result == sorted(((i, f"{simhash(t):016x}", want[i] if i is not None else None) for i, t in rows), key=str)
    kept = op.one_of_each(df.drop("component_id"))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([*set(want.values()), None], key=str)
    assert op.near_duplicates(df.limit(0)).count() == 0
