import random

from tests.llm.brute import tiling

from mobility.llm import decontaminate as op

ITEM = "The quick brown fox jumps over the lazy dog. Then seven wizards quietly drank their tea. Nobody saw the old river rise."


def test_tiles_equal_brute_force():
    rng = random.Random(1)
    for _ in range(800):
        v = rng.choice([2, 3, 6, 20])
        p = [rng.randrange(v) for _ in range(rng.randint(1, 25))]
        t = [rng.randrange(-1, v) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.5:
            i = rng.randrange(len(p))
            t += p[i:] + [-1] + p[:i]
        got = op.tiles(p, t, 3)
        assert sum(n for _, _, n in got) == tiling(p, t, 3)
        for i, j, n in got:
            assert p[i: i + n] == t[j: j + n] and n >= 3


def _rows(spark, docs, items, **kw):
    got = op.contaminations(spark.createDataFrame(docs, "doc_id long, text string"),
                            spark.createDataFrame(items, "item_id long, text string"), **kw)
    return sorted(((r.doc_id, r.item_id, round(r.coverage, 3)) for r in got.collect()), key=str)


def test_copies_and_reordered_passages_are_caught_and_others_left(spark):
    a, b, c = (s.strip() + "." for s in ITEM.rstrip(".").split("."))
    filler = "some other words that have nothing to do with it "
    docs = [(1, filler * 50 + ITEM), (2, f"{c} {filler} {a.upper()} -- {b}!"), (3, filler * 5 + a), (4, filler),
            (5, "the old the lazy their tea over the"), (6, ITEM.replace("wizards", "witches"))]
    assert _rows(spark, docs, [(7, ITEM)]) == [(1, 7, 1.0), (2, 7, 1.0), (6, 7, 0.955)]


def test_blocks_of_items_change_nothing(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(words, k=30))) for i in range(25)]
    docs = [(i, " ".join(rng.choices(words, k=40)) + " " + items[i % 25][1]) for i in range(30)]
    one = _rows(spark, docs, items)
    assert _rows(spark, docs, items, block_bytes=700) == one
    assert {(d, i) for d, i, _ in one} >= {(i, i % 25) for i in range(30)}
    df = spark.createDataFrame([(*d, "x") for d in docs + [(99, "clean")]], "doc_id long, text string, t string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = op.without_contaminated(df, bench, block_bytes=700)
    assert [r.doc_id for r in kept.collect()] == [99] and kept.columns == df.columns


def test_defined_cases(spark):
    docs = [(None, ITEM), (1, None), (2, ""), (3, "?!"), (4, ITEM), (4, ITEM), (5, "only four words here"), (6, "ok " * 30_000)]
    items = [(7, ITEM), (7, ITEM), (8, None), (9, ""), (10, "..."), (None, "only four words here")]
    assert _rows(spark, docs, items) == sorted([(None, 7, 1.0), (4, 7, 1.0), (4, 7, 1.0), (5, None, 1.0)], key=str)
    assert _rows(spark, docs, []) == [] and _rows(spark, [], items) == []


def test_short_common_runs_are_found(spark):
    words = [f"w{i}" for i in range(20)]
    threes = [words[i: i + 3] for i in range(0, 18, 3)] + [words[18:]]
    fours = [words[i: i + 4] for i in range(0, 20, 4)]
    docs = [(1, " x ".join(" ".join(p) for p in reversed(fours))), (2, " ".join("y" if i % 5 == 4 else w for i, w in enumerate(words))),
            (3, " ".join(" ".join(p) for p in reversed(threes))), (4, " ".join("y" if i % 4 == 3 else w for i, w in enumerate(words)))]
    # the two tokens at the end of document 3 are under a tile's length; document 4 keeps 15 of 20 tokens
    assert _rows(spark, docs, [(7, " ".join(words))]) == [(1, 7, 1.0), (2, 7, 0.8), (3, 7, 0.9)]


def test_all_pairs_equal_brute_force(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(40)]
    items = [rng.choices(words, k=rng.choice([1, 2, 3, 4, 5, 8, 12, 20])) for _ in range(25)]
    docs = []
    for item in items * 3:
        n = rng.choice([2, 3, 4, 5])
        parts = [item[i: i + n] for i in range(0, len(item), n)]
        rng.shuffle(parts)
        docs.append([w for p in parts for w in [*p, *rng.choices(words, k=rng.choice([0, 0, 1]))]])
    number = {w: i for i, w in enumerate(words)}
    want = []
    for d, doc in enumerate(docs):
        for k, item in enumerate(items):
            got = tiling([number[w] for w in item], [number[w] for w in doc], min(3, len(item)))
            if got >= 0.8 * len(item):
                want.append((d, k, round(got / len(item), 3)))
    assert _rows(spark, [(d, " ".join(x)) for d, x in enumerate(docs)], [(k, " ".join(x)) for k, x in enumerate(items)]) == sorted(want, key=str)
