import random

from tests.llm.brute import dedup_lines

from mobility.llm import line_dedup as op

SCHEMA = "doc_id long, text string"


def test_equals_brute_force(spark):
    rng = random.Random(6)
    lines = [f"line {i}" for i in range(12)] + ["", "  "]
    docs = [(i, "\n".join(rng.choices(lines, k=rng.randint(1, 25)))) for i in range(60)]
    docs += [(100 + i, "a\nb\nc\n" + str(i)) for i in range(40)] + [(200, "\n".join(["x"] * 20_000))]
    got = {r.doc_id: r for r in op.dedup_lines(spark.createDataFrame(docs, SCHEMA).repartition(5)).collect()}
    want = dedup_lines(docs)
    assert {k: r.text for k, r in got.items()} == want
    for k, text in docs:
        n = len(text.split("\n"))
        assert got[k].n_removed + got[k].n_left == n


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, "a\nb"), (4, "p\nq\nr"), (4, "p\nq\nr"), (None, "p\nq\nr\ns"), (6, "\n\n\n\n"), (7, "\n\n\n\n"),
            (8, "k\np\nq\nr")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA + ", n_left string")
    got = op.dedup_lines(df)
    assert got.columns == ["doc_id", "text", "n_removed", "n_left"]
    result = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    # the null id comes first and keeps the passage; repeated rows lose it alike
    want = [(1, None), (2, ""), (3, "a\nb"), (4, ""), (4, ""), (None, "p\nq\nr\ns"), (6, "\n\n\n\n"), (7, "\n\n\n\n"), (8, "k")]
    assert result == sorted(want, key=str)
    assert op.dedup_lines(df.limit(0)).count() == 0


def _passages(docs, words):
    """{id: text}: windows of three lines, and of one or two lines with more than so many words."""
    seen, out = set(), {}
    for key, text in sorted(docs):
        lines = text.split("\n")
        gone = set()
        for n in (1, 2, 3):
            for i in range(len(lines) - n + 1):
                w = tuple(lines[i: i + n])
                if any(x.strip(" ") for x in w) if n == 3 else sum(len(x.split()) for x in w) > words:
                    if w in seen:
                        gone |= set(range(i, i + n))
                    seen.add(w)
        out[key] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def test_passages_on_one_or_two_lines_go(spark):
    long = " ".join(f"w{i}" for i in range(51))
    half = [" ".join(f"{c}{i}" for i in range(26)) for c in "ab"]
    docs = [(1, long), (2, f"head\n{long}\ntail"), (3, long + " more"), (4, "\n".join(half)), (5, "x\n" + "\n".join(half) + "\ny"),
            (6, half[0]), (7, "\n".join(half[::-1])), (8, " ".join(long.split()[:50])), (9, " ".join(long.split()[:50])), (10, long)]
    rng = random.Random(8)
    lines = [" ".join(rng.choices("abc", k=n)) for n in (1, 10, 26, 40, 51, 60)] + ["", "\t" + long]
    docs += [(20 + i, "\n".join(rng.choices(lines, k=rng.randint(1, 6)))) for i in range(80)]
    df = spark.createDataFrame(docs, SCHEMA).repartition(5)
    got = {r.doc_id: r for r in op.dedup_lines(df, passage_words=op.PASSAGE_WORDS).collect()}
    assert {k: r.text for k, r in got.items()} == _passages(docs, 50)
    assert [got[k].text for k in (2, 5, 10)] == ["head\ntail", "x\ny", ""] and got[8].text == got[9].text != ""
    for k, text in docs:
        assert got[k].n_removed + got[k].n_left == len(text.split("\n"))
