import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest

from mobility.llm import periodic_runs as op
from mobility.llm import queries
from mobility.llm.words import Words


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(ws, least=6):
    """{(start, length, period)}: every period, every stretch, smallest periods only."""
    n, out = len(ws), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if ws[i] != ws[i + q]:
                i += 1
                continue
            x = i
            while i + q < n and ws[i] == ws[i + q]:
                i += 1
            if i + q - x >= max(least, 4 * q) and not any(
                    q % p == 0 and a <= x and i + q <= a + m for (a, m), p in out.items()):
                out[x, i + q - x] = q
    return sorted((a, m, q) for (a, m), q in out.items())


def collapsed(ws, runs):
    gone = {k for a, m, q in runs for k in range(a + q, a + m)}
    return " ".join(w for k, w in enumerate(ws) if k not in gone)


def found(texts):
    w = Words(pa.array(texts, type=pa.string()))
    return [sorted((x - int(w.first[i]), y - x, q) for q, x, y in runs) for i, runs in enumerate(op.runs_of(w))]


def periodic_text(rng):
    ws = []
    for _ in range(rng.randint(0, 6)):
        kind = rng.random()
        alphabet = [f"w{k}" for k in range(rng.choice([2, 3, 5, 50]))]
        block = [rng.choice(alphabet) for _ in range(rng.randint(1, 12))]
        if kind < 0.5:
            ws += (block * rng.randint(1, 12))[: rng.randint(1, 90)]
        elif kind < 0.7:
            ws += ((block * 4 + ["x"]) * rng.randint(1, 6))
        else:
            ws += [rng.choice(alphabet) for _ in range(rng.randint(0, 40))]
    return " ".join(ws)


@pytest.mark.parametrize("seed", range(6))
def test_runs_against_every_period(seed):
    rng = random.Random(seed)
    texts = [periodic_text(rng) for _ in range(150)]
    assert found(texts) == [plain(words_of(t)) for t in texts]


def test_short_alphabets_against_every_period():
    rng = random.Random(77)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += [" ".join(rng.choice("aaab") for _ in range(rng.randint(0, 200))) for _ in range(60)]
    a, b = ["a"], ["a", "b"]
    for _ in range(10):
        a, b = b, b + a  # Fibonacci words hold many overlapping squares
    texts.append(" ".join(b))
    assert found(texts) == [plain(words_of(t)) for t in texts]


def test_grammar_gives_back_its_words_and_no_pair_twice():
    rng = random.Random(3)
    for _ in range(40):
        w = Words(pa.array([periodic_text(rng) for _ in range(4)]))
        ids = op.word_ids(w)
        g = op.Grammar(ids)

        def expand(s, g=g):
            return [s] if s < g.terminals else expand(int(g.left[s - g.terminals])) + expand(int(g.right[s - g.terminals]))

        got = [expand(int(s)) for s in g.symbols]
        assert [x for part in got for x in part] == ids.tolist()
        for r in range(len(g.left)):
            assert expand(g.terminals + r) == ids[g.start[r]: g.end[r]].tolist()
            assert expand(int(g.left[r])) == ids[g.start[r]: g.middle[r]].tolist()
        seen, last = set(), None
        for i in range(len(g.symbols) - 1):
            pair = (g.symbols[i], g.symbols[i + 1])
            if pair == last:
                last = None  # overlaps itself
                continue
            assert pair not in seen
            seen.add(pair)
            last = pair


def test_rules_are_few_for_long_repetition():
    g = op.Grammar(op.word_ids(Words(pa.array([" ".join(["a"] * 100_000)]))))
    assert len(g.left) < 40 and len(g.symbols) < 40


def test_long_texts():
    rng = random.Random(9)
    block = [f"w{rng.randrange(1000)}" for _ in range(5000)]
    texts = [" ".join(["a"] * 200_000), " ".join(block * 9), " ".join(["a", "b"] * 50_000 + ["c"]), "x" * 2_000_000]
    assert found(texts) == [[(0, 200_000, 1)], [(0, 45_000, 5000)], [(0, 100_000, 2)], []]


def expected(doc_id, text):
    ws = words_of(text)
    n = len(ws)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]
    runs = plain(ws)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    sha = [hashlib.sha256(s.encode()).hexdigest() for s in ("".join(f"{a},{m},{q}\n" for a, m, q in runs), collapsed(ws, runs))]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *sha)


def test_query_against_every_period(spark, tmp_path):
    rng = random.Random(21)
    rows = [(i, periodic_text(rng) if i % 2 else " \n".join(f"u{rng.randrange(60)}" for _ in range(rng.randint(0, 80)))) for i in range(400)]
    rows += [(7, rows[7][1]), (None, "a a a a a a"), (1000, None), (1001, ""), (1002, " \t\r\n\x0b\x0c"), (1003, "  " * 9)]
    spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, runs int, t string") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.REGISTRY["op13_periodic_runs"](spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = sorted(map(tuple, out.collect()), key=repr)
    assert got == sorted((expected(*r) for r in rows), key=repr)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 20


def test_empty_table(spark):
    assert op.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
