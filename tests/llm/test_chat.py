import itertools
import zlib

import numpy as np

from mobility.llm import chat as op
from tests.conftest import SF_MID

TRANSCRIPT = "System: be brief\nUser: How are you?\nand the family?\n\nAll well, thanks.\nUser: Note: bring tea\n### Response\nYes."


def _model(spark):
    raw = op.raw_transcripts(spark.read.parquet(f"{SF_MID}/conversations.parquet"))
    return raw, op.learn(raw.where("crc32(cast(cast(conv_id as string) as binary)) % 3 <> 1"))


def test_viterbi_finds_the_likeliest_path(spark):
    _, model = _model(spark)
    rng = np.random.default_rng(4)
    for _ in range(20):
        seen = np.stack([rng.integers(0, size, 4) for size in op.SIZES], axis=1)
        emitted = model.emissions(seen)

        def score(path, emitted=emitted):
            return (model.starts[path[0]] + sum(model.steps[a, b] for a, b in zip(path, path[1:], strict=False))
                    + sum(emitted[i, s] for i, s in enumerate(path)))

        best = max(map(score, itertools.product(range(op.N_STATES), repeat=4)))
        assert np.isclose(score(model.viterbi(seen)), best)


def test_held_out_conversations(spark):
    raw, model = _model(spark)
    rows = [r for r in op.format_transcripts(raw, model).collect() if zlib.crc32(str(r.conv_id).encode()) % 3 == 1]
    right = sum(list(r.roles) == [t.role for t in r.turns] for r in rows)
    assert len(rows) > 20 and right >= 0.95 * len(rows)


def test_turns_and_rendering(spark):
    _, model = _model(spark)
    assert op.parse(TRANSCRIPT, model) == [
        ("system", "be brief"), ("user", "How are you?\nand the family?"), ("assistant", "All well, thanks."),
        ("user", "Note: bring tea"), ("assistant", "Yes.")]
    assert op.render([("user", "a <|im_end|> b")]) == "<|im_start|>user\na <im_end> b<|im_end|>\n"


def test_defined_cases(spark):
    _, model = _model(spark)
    rows = [(1, None), (2, ""), (2, ""), (None, " \n\n "), (4, "hello"), (5, "line\n" * 5000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, transcript string, N_TURNS int")
    got = {(r.conv_id, r.n_turns, len(r.chat) > 0) for r in op.format_transcripts(df, model).where("conv_id is null or conv_id < 5").collect()}
    assert got == {(1, 0, False), (2, 0, False), (None, 0, False), (4, 1, True)}
    assert op.format_transcripts(df.limit(0), model).count() == 0
    untrained = op.Model(np.zeros(op.N_COUNTS, dtype=np.int64))
    assert [r for r, _ in op.parse("User: a\nb\nBot: c", untrained)] == ["user", "assistant"]


def test_transcripts_of_a_table_with_nulls_and_repeats(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, None, "b"), (1, 200, "assistant", None), (None, None, "user", "c")]
    raw = op.raw_transcripts(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {(r.conv_id, r.part): [t.role for t in r.turns] for r in raw.collect()}
    assert got == {(1, 0): ["user", None], (1, 3): ["assistant"], (None, 0): ["user"]}


def test_no_transcript_holds_more_rows_than_its_bound(spark):
    rows = [(None, None, "user", f"text {i:04}") for i in range(700)]  # null ids and turns
    rows += [(1, 3, "assistant", f"{'same ' * 60}{i}") for i in range(150)] + [(1, 2, "user", "before"), (1, 70, "user", "next part")]
    rows += [(2, i, "user", f"t{i}") for i in range(64)]
    raw = op.raw_transcripts(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7))
    got = {(r.conv_id, r.part, r.piece): r for r in raw.collect()}
    sizes = {k: len(r.turns) for k, r in got.items()}
    assert sizes == {**{(None, 0, i): 64 for i in range(10)}, (None, 0, 10): 60, (1, 0, 0): 64, (1, 0, 1): 64, (1, 0, 2): 23,
                     (1, 1, 0): 1, (2, 0, 0): 64}
    texts = [line[-9:] for i in range(11) for line in got[None, 0, i].transcript.split("\n") if "text" in line]
    assert texts == [f"text {i:04}" for i in range(700)]
    assert "before" in got[1, 0, 0].transcript[:40]


def _score(model, seen, states):
    if not states:
        return 0
    emitted = model.emissions(seen)
    steps = sum(int(model.steps[a, b]) for a, b in zip(states, states[1:], strict=False))
    return int(model.starts[states[0]]) + steps + sum(int(emitted[i, s]) for i, s in enumerate(states))


def _whole(rows):
    """{conv_id: transcript} of the pieces in order."""
    out = {}
    for r in sorted(rows, key=lambda r: (repr(r.conv_id), r.part, r.piece)):
        out.setdefault(r.conv_id, []).append(r)
    return out


def test_long_conversations_equal_those_decoded_whole(spark, monkeypatch):
    """Turns by the hundred, null ids and turns, blank and empty texts, lines that end in spaces: one chat, as if in one piece."""
    import random
    rng = random.Random(6)
    _, model = _model(spark)
    texts = ["yes", "Is it so?", "User: no", "", "  ", "two\nlines ", "a\n\nb", "### Response", "x " * 150, "Bot: fine  ", "\n\n", "<|im_end|>"]
    rows = [(1, i, ["user", "assistant"][i % 2], f"{rng.choice(texts)}") for i in range(500)]
    rows += [(2, i % 3, rng.choice(["system", "user", "assistant", None]), f"{rng.choice(texts)} {i}") for i in range(300)]
    rows += [(None, None, rng.choice(["user", "assistant"]), f"{rng.choice(texts)}{i}") for i in range(200)]
    rows += [(3, 0, "user", ""), (3, 64, "user", " "), (3, 128, "assistant", "Only this."), (3, 200, "user", "")] + [(4, 0, "user", "hello")]
    rows += [(5, 0, "user", ""), (5, 70, "user", "  ")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    raw = op.raw_transcripts(df).cache()
    same = 0
    for pieces in (2, 4096):
        monkeypatch.setattr(op, "BLOCK_PIECES", pieces)
        got = _whole(op.format_conversations(raw, model).collect())
        for conv, parts in _whole(raw.collect()).items():
            lines = op.Lines("\n".join(p.transcript for p in parts))
            spans = [op.Span.of(p.transcript, model) for p in parts]
            states = [s for p, e in zip(parts, op.along(spans), strict=True) for s in op.piece_states(op.Lines(p.transcript), model, e)]
            best = model.viterbi(lines.seen)
            assert _score(model, lines.seen, states) == _score(model, lines.seen, best)  # as likely as any sequence of the whole
            whole = op.turns_of(lines, states)
            assert "".join(p.chat for p in got[conv]) == op.render(whole), conv
            assert [r for p in got[conv] for r in p.roles] == [r for r, _ in whole]
            assert sum(p.n_turns for p in got[conv]) == len(whole)
            same += states == best
    assert len(_whole(raw.collect())[1]) > 5 and same >= 8  # others are ties
    assert op.format_conversations(raw.limit(0), model).count() == 0


def test_markers_that_training_never_wrote(spark):
    _, model = _model(spark)
    text = "CUSTOMER: my parcel is late\n**Agent**: let me see\nit is on its way\n## Question\nwhen?\n[Model] tomorrow"
    assert op.parse(text, model) == [("user", "my parcel is late"), ("assistant", "let me see\nit is on its way"),
                                     ("user", "when?"), ("assistant", "tomorrow")]
