import random
import re

import pytest

from mobility.llm import substring_dedup as op


def plain(rows, span):
    """[(id, n_words, n_removed, kept)] by looking every window up."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for i, ws in split:
        for a in range(len(ws) - span + 1):
            w = tuple(ws[a: a + span])
            if i is not None:
                least[w] = min(i, least.get(w, i))
    out = []
    for i, ws in split:
        gone = set()
        for a in range(len(ws) - span + 1):
            if i is not None and least[tuple(ws[a: a + span])] < i:
                gone |= set(range(a, a + span))
        out.append((i, len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return sorted(out, key=repr)


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows, passages = [], [[rng.choice(words) for _ in range(rng.randint(10, 60))] for _ in range(6)]
    for i in range(n):
        ws = []
        for _ in range(rng.randint(0, 5)):
            ws += [rng.choice(words) for _ in range(rng.randint(0, 40))]
            kind = rng.random()
            p = rng.choice(passages)
            if kind < 0.4:
                a = rng.randrange(len(p))
                ws += p[a: a + rng.randint(8, 40)]
            elif kind < 0.5:
                ws += ["again"] * rng.randint(5, 60)
            elif kind < 0.6:
                ws += p[:3] * rng.randint(3, 15)
        rows.append((rng.randint(0, n), rng.choice([" ", "\n", "\t "]).join(ws)))
    return rows + rows[:7] + [(n + 5, rows[3][1]), (n + 6, rows[3][1] + " tail")]


@pytest.mark.parametrize(("span", "shard"), [(13, 16_384), (13, 20), (5, 30), (3, 10_000), (20, 10_000)])
def test_against_every_window_looked_up(spark, span, shard):
    rows = corpus(span + shard)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(map(tuple, op.remove_repeats(df, span=span, shard_segments=shard).collect()), key=repr)
    assert got == plain(rows, span)
    assert sum(r[2] for r in got) > 200


def test_small_pieces_change_nothing(spark, monkeypatch):
    rows = corpus(99)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(op, "PIECE_BYTES", 500)
    assert sorted(map(tuple, op.remove_repeats(df).collect()), key=repr) == plain(rows, 13)


def test_matching_statistics_against_search():
    rng = random.Random(5)
    for _ in range(60):
        texts = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 25))] for _ in range(rng.randint(1, 5))]
        sam = op.SuffixAutomaton()
        for t in texts:
            sam.add(t)
        probe = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(30)]
        held = {tuple(t[a:b]) for t in texts for a in range(len(t)) for b in range(a + 1, len(t) + 1)}
        want = [max([n for n in range(1, e + 2) if tuple(probe[e + 1 - n: e + 1]) in held], default=0) for e in range(30)]
        assert sam.statistics(probe) == want


def test_defined_cases(spark):
    p = " ".join(f"p{i}" for i in range(13))
    long = "x" * 300_000
    rows = [(1, p), (2, p), (2, p), (None, p), (3, None), (4, ""), (5, " \n"), (6, p.replace(" ", "\t\n")), (7, "p0 p1"),
            (8, " ".join(["same"] * 40_000)), (9, " ".join(["same"] * 13)), (10, long), (11, "é " + p + " é"), (1, p + " own"), (1, p)]
    df = spark.createDataFrame([(i, t, 0, "z") for i, t in rows], "doc_id long, text string, n_words int, r string")
    got = sorted(map(tuple, op.remove_repeats(df).collect()), key=repr)
    assert got == plain(rows, 13)
    empty = op.remove_repeats(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.columns == ["doc_id", "n_words", "n_removed", "kept"] and empty.count() == 0


def test_a_passage_in_a_third_of_the_rows(spark):
    p = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"a{i} b{i} " + (p if i % 3 == 0 else f"c{i}") + f" d{i}") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert sorted(map(tuple, op.remove_repeats(df, shard_segments=50).collect()), key=repr) == plain(rows, 13)
