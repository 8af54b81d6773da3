"""Chat formatting: a hidden Markov model recovers the turns of a transcript.

A transcript is a text of lines. Hidden states are the roles (system, user,
assistant), each as a turn's first line and as its later lines. What is seen of a
line is its speaker marker (``User:``, ``### Response``, ``<|assistant|>``, ``[Bot]``, an
unknown name, none), what stands before it (nothing, a line, a blank line), its
length, and whether it ends as a question. The model's probabilities are counts
of labelled transcripts with one added to each. The likeliest sequence of states (Viterbi)
cuts the transcript into turns; each is rendered as
``<|im_start|>role\\ncontent<|im_end|>\\n``. The marker of a turn's first line is not
part of its content if its name is known; those two marks inside a content lose their bars.

Counting is a pass over all labelled transcripts with partial sums per batch; parsing
is a pass over rows. A model is a few hundred numbers; log probabilities are whole numbers (in units of 2**-20), so sums
don't depend on their order.

A conversation of any length is decoded as one sequence, though it lies in pieces of bounded size: a piece is summed up by
the best score from every state before it to every state at its end (max-plus matrices), which combine like
products; folded along the conversation, block by block, they give each piece the scores it begins with and the state it
ends in, and each piece is then traced by itself. A piece's fragment begins and ends within a turn where the
turn does, so that the fragments in order are the conversation's one chat.

Defined cases: null, empty and blank transcripts have no turn; a conversation's
first line begins a turn whatever it looks like; ties take the first state in order;
a very long transcript is decoded whole (in pieces, see above; of equally likely sequences
it may then be another one); turns of unknown roles are learned from by nobody and written without a marker; without labelled
transcripts all sequences that alternate from a user's turn at
each marker or blank line are what the markers say, all else being alike; repeated rows give repeated
rows; other columns pass through, and columns named like an output give way to it.
"""
from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mobility.llm.common import with_replaced, written

ROLES = ("system", "user", "assistant")
N_STATES = 2 * len(ROLES)  # 2 * role: first line of a turn, 2 * role + 1: a later one

# Names that speakers go by.
NAMES = {
    "system": 0, "context": 0, "setup": 0,
    "user": 1, "human": 1, "customer": 1, "prompt": 1, "instruction": 1, "question": 1, "q": 1,
    "assistant": 2, "ai": 2, "bot": 2, "agent": 2, "model": 2, "response": 2, "answer": 2, "a": 2,
}
MARKER = re.compile(
    r"\s*(?:\*{0,2}([A-Za-z]{1,12})\*{0,2}\s*:\*{0,2}(?:\s+|$)|#{1,4}\s*([A-Za-z]{1,12})\s*:?\s*$"
    r"|<\|([A-Za-z]{1,12})\|>\s*|\[([A-Za-z]{1,12})\]\s*:?\s*)")
NO_MARKER, UNKNOWN = len(ROLES), len(ROLES) + 1
#: Values of each feature: marker, what stands before, length, question.
SIZES = (len(ROLES) + 2, 3, 5, 2)
LENGTHS = (20, 80, 200, 600)
BEGIN, END = "<|im_start|>", "<|im_end|>"
#: Log probabilities are multiples of this; what can't be.
UNIT = 1 << 20
NEVER = -(1 << 55)


def marker(line: str) -> tuple[int, int]:
    """(marker, where the rest begins) of a line."""
    m = MARKER.match(line)
    if not m:
        return NO_MARKER, 0
    role = NAMES.get(next(g for g in m.groups() if g).lower())
    return (UNKNOWN, 0) if role is None else (role, m.end())


class Lines:
    """The lines of a transcript that aren't blank, and what is seen of them."""

    def __init__(self, text: str | None):
        self.lines: list[str] = []
        self.blank_before: list[int] = []
        self.blank_first = 0
        rows, blank, first = [], 0, True
        for line in (text or "").split("\n"):
            if not line.strip():
                blank += 1
                continue
            kind, _ = marker(line)
            before = 0 if first else 2 if blank else 1
            rows.append((kind, before, sum(len(line) >= n for n in LENGTHS), int(line.rstrip().endswith("?"))))
            self.lines.append(line)
            self.blank_before.append(0 if first else blank)
            if first:
                self.blank_first = blank
            blank, first = 0, False
        self.blank_after = blank
        self.seen = np.array(rows, dtype=np.int64).reshape(-1, len(SIZES))

    def following(self, blank: int) -> np.ndarray:
        """What is seen of the lines if others come before them, and then ``blank`` blank lines."""
        seen = self.seen.copy()
        if len(seen):
            seen[0, 1] = 2 if blank else 1
        return seen


def _scores(log_probabilities: np.ndarray) -> np.ndarray:
    with np.errstate(invalid="ignore"):
        return np.where(np.isneginf(log_probabilities), NEVER, np.rint(log_probabilities * UNIT)).astype(np.int64)


class Model:
    """Log probabilities of starts, steps and features by state."""

    def __init__(self, counts: np.ndarray):
        """``counts``: starts, steps and features, flat (see ``count``)."""
        n = N_STATES
        starts, steps = counts[:n].astype(float), counts[n: n + n * n].reshape(n, n).astype(float)
        if not counts.any():
            starts[2] += 3
            for r in range(len(ROLES)):
                steps[2 * r: 2 * r + 2, [2 * r + 1, 4 if r != 2 else 2]] += 3
        possible = np.ones((n, n), dtype=bool)
        for s in range(n):  # a later line belongs to the turn before it
            for t in range(1, n, 2):
                possible[s, t] = s // 2 == t // 2
        self.starts = _scores(np.where(np.arange(n) % 2 == 0, np.log(starts + 1) - np.log((starts + 1)[::2].sum()), -np.inf))
        weight = np.where(possible, steps + 1, 0)
        with np.errstate(divide="ignore"):
            self.steps = _scores(np.log(weight / weight.sum(axis=1, keepdims=True)))
        self.seen, at = [], n + n * n
        for k, size in enumerate(SIZES):
            c = counts[at: at + n * size].reshape(n, size).astype(float)
            if k == 0 and not counts.any():
                for r in range(len(ROLES)):
                    c[2 * r, r] += 9
                    c[2 * r + 1, NO_MARKER] += 9
            self.seen.append(_scores(np.log((c + 1) / (c + 1).sum(axis=1, keepdims=True))))
            at += n * size

    def emissions(self, seen: np.ndarray) -> np.ndarray:
        return sum(table[:, seen[:, k]].T for k, table in enumerate(self.seen))

    def viterbi(self, seen: np.ndarray, entered: np.ndarray | None = None, last: int | None = None) -> list[int]:
        """The likeliest states of a transcript's lines; of a piece's, from the scores of the states before it
        (``entered``; None: it begins the conversation), ending in ``last``."""
        if not len(seen):
            return []
        emitted = self.emissions(seen)
        best = (self.starts if entered is None else (entered[:, None] + self.steps).max(axis=0)) + emitted[0]
        back = np.zeros(emitted.shape, dtype=np.int8)
        for i in range(1, len(emitted)):
            via = best[:, None] + self.steps
            back[i] = via.argmax(axis=0)
            best = via[back[i], np.arange(N_STATES)] + emitted[i]
        path = [int(best.argmax()) if last is None else last]
        for i in range(len(emitted) - 1, 0, -1):
            path.append(int(back[i][path[-1]]))
        return path[::-1]

    def across(self, seen: np.ndarray) -> np.ndarray:
        """Best score from each state before the lines to each state at the last of them."""
        emitted = self.emissions(seen)
        best = self.steps + emitted[0]
        for line in emitted[1:]:
            best = np.maximum(_product(best, self.steps) + line, NEVER)
        return best

    def begun(self, seen: np.ndarray) -> np.ndarray:
        """Best score of each state at the last of the lines that begin a conversation."""
        emitted = self.emissions(seen)
        best = self.starts + emitted[0]
        for line in emitted[1:]:
            best = np.maximum((best[:, None] + self.steps).max(axis=0) + line, NEVER)
        return best


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of matrices (or of a row and a matrix)."""
    return np.maximum((a[..., :, None] + b).max(axis=-2), NEVER)


def _level(x: np.ndarray) -> np.ndarray:
    """Scores from the best one down: what is likeliest doesn't change, and sums stay small."""
    return np.maximum(x - x.max(), NEVER)


N_COUNTS = N_STATES + N_STATES * N_STATES + N_STATES * sum(SIZES)


def count(seen: np.ndarray, states: list[int]) -> np.ndarray:
    """Counts of one labelled transcript: starts, steps, features by state."""
    n = N_STATES
    out = [np.zeros(n), np.zeros((n, n)), *(np.zeros((n, size)) for size in SIZES)]
    if len(states):
        s = np.array(states)
        out[0][s[0]] = 1
        np.add.at(out[1], (s[:-1], s[1:]), 1)
        for k in range(len(SIZES)):
            np.add.at(out[2 + k], (s, seen[:, k]), 1)
    return np.concatenate([x.ravel() for x in out]).astype(np.int64)


def states_of(roles: list[str | None], lines: list[int]) -> list[int] | None:
    """States of a transcript whose turns have these roles and numbers of lines."""
    out = []
    for role, n in zip(roles, lines, strict=True):
        if n and role not in ROLES:
            return None
        if n:
            r = ROLES.index(role)
            out += [2 * r] + [2 * r + 1] * (n - 1)
    return out


def learn(labelled: DataFrame, text: str = "transcript", turns: str = "turns") -> Model:
    """Count over all rows of ``labelled``; ``turns`` is an array of (role, n_lines)
    structs, lines that aren't blank. Rows whose turns don't match their lines are left out."""
    src = labelled.select(F.col(f"`{text}`").cast("string").alias("t"), F.col(f"{turns}.role").alias("r"),
                          F.col(f"{turns}.n_lines").alias("n"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(N_COUNTS, dtype=np.int64)
        for batch in batches:
            for t, r, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if t is None or r is None or n is None:
                    continue
                lines = Lines(t)
                states = states_of(r, n)
                if states is not None and len(states) == len(lines.lines):
                    total += count(lines.seen, states)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["i", "n"])

    counts = np.zeros(N_COUNTS, dtype=np.int64)
    for row in src.mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():  # N_COUNTS rows at most
        counts[row["i"]] = row["n"]
    return Model(counts)


def parse(text: str | None, model: Model) -> list[tuple[str, str]]:
    """The (role, content) turns of a transcript."""
    lines = Lines(text)
    return turns_of(lines, model.viterbi(lines.seen))


def turns_of(lines: Lines, states: list[int]) -> list[tuple[str, str]]:
    """The (role, content) turns of lines with these states."""
    turns: list[tuple[str, list[str]]] = []
    for line, state, blank in zip(lines.lines, states, lines.blank_before, strict=True):
        if state % 2 == 0:
            kind, at = marker(line)
            rest = line[at:] if kind < len(ROLES) else line
            turns.append((ROLES[state // 2], [rest]))
        else:
            turns[-1][1].extend([""] * blank + [line])
    return [(role, "\n".join(content).strip()) for role, content in turns]


def render(turns: list[tuple[str, str]]) -> str:
    plain = [(r, c.replace(BEGIN, "<im_start>").replace(END, "<im_end>")) for r, c in turns]
    return "".join(f"{BEGIN}{r}\n{c}{END}\n" for r, c in plain)


def format_transcripts(df: DataFrame, model: Model, text: str = "transcript", out: str = "chat",
                       roles: str = "roles", n_turns: str = "n_turns") -> DataFrame:
    """``df`` with the rendered chat, the roles of its turns and their number."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    src = with_replaced(df, out, roles, n_turns)
    names = [*src.columns, out, roles, n_turns]
    schema = T.StructType([*src.schema.fields, T.StructField(out, T.StringType(), False),
                           T.StructField(roles, T.ArrayType(T.StringType(), False), False), T.StructField(n_turns, T.LongType(), False)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parsed = [parse(t, shared.value) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([render(p) for p in parsed], type=pa.string()),
                 pa.array([[r for r, _ in p] for p in parsed], type=pa.list_(pa.string())),
                 pa.array([len(p) for p in parsed], type=pa.int64())], names=names)

    return src.mapInArrow(run, schema)


#: Turn numbers of a part, and rows of a transcript at most.
PART_TURNS = 64
#: Characters of a text by which rows are dealt out in order; what the driver sees of a text.
ORDER_CHARS = 256
#: Ways to write a turn's beginning: for (system, user, assistant).
STYLES = [
    ("System: ", "User: ", "Assistant: "),
    ("**Context**: ", "**Human**: ", "**AI**: "),
    ("### Setup\n", "### Instruction\n", "### Response\n"),
    ("<|system|> ", "<|user|> ", "<|assistant|> "),
    ("[Context] ", "Q: ", "A: "),
]


def _order_of(text: str) -> list[F.Column]:
    """The order of rows of one turn number, the same in parts of all sizes."""
    return [F.coalesce("role", F.lit("")), F.substring(text, 1, ORDER_CHARS), F.xxhash64(text)]


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (of parts of over ``PART_TURNS`` rows) with ``rank``, the place from 0 in its part.

    The rows are sorted over all tasks and written with their place, so a part of any
    size lies in several tasks; a part's rows in the tasks before are added.
    """
    order = ["conv_id", "part", "turn", *_order_of("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    placed = written(dealt.withColumn("task", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "turns")
    whole = Window.partitionBy("conv_id", "part")
    pieces = placed.groupBy("conv_id", "part", "task").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    starts = (pieces.withColumn("before", F.sum("n").over(whole.orderBy("task").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
              .select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), F.col("task").alias("_task"), "first", "before"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")) & (F.col("task") == F.col("_task"))
    return placed.join(starts, same).select(*rows.columns, (F.col("before") + F.col("at") - F.col("first")).alias("rank"))


def _written_turn(x: F.Column) -> F.Column:
    """``role, w``: a turn with its beginning in its conversation's style."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    marked = F.lit("")
    for s, markers in enumerate(STYLES):
        for r, m in zip(ROLES, markers, strict=True):
            marked = F.when((style == s) & (x["role"] == r), m).otherwise(marked)
    bare = (F.pmod(F.xxhash64("conv_id", x["turn"]), F.lit(5)) == 0) & (x["turn"] != 0)
    w = F.when(bare, F.concat(F.lit("\n"), x["text"])).otherwise(F.concat(marked, x["text"]))
    return F.struct(x["role"].alias("role"), w.alias("w"))


def raw_transcripts(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                    text: str = "text") -> DataFrame:
    """Transcripts of a table of turns: ``conv_id, part, piece, transcript, turns``.

    Each conversation is written in one of five styles (by a hash of its
    id), and every fifth turn but those of number 0 has no marker, only a
    blank line before it. Long conversations lie in parts of ``PART_TURNS``
    turn numbers, and a part of more rows (null turns are turn 0) in pieces of
    ``PART_TURNS`` rows, so that no row grows without bound; :func:`format_conversations` reads the pieces as
    one transcript. Rows that repeat are one turn; turns of one number follow in order of role, of
    their first ``ORDER_CHARS`` characters and of their hash.
    """
    turns = conversations.select(
        F.col(conv_id).alias("conv_id"), F.coalesce(F.col(turn).cast("long"), F.lit(0)).alias("turn"), F.col(role).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("part", F.floor(F.col("turn") / PART_TURNS))
    large = (turns.groupBy(F.col("conv_id").alias("_conv"), F.col("part").alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
             .where(F.col("_n") > PART_TURNS))
    here = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))
    keys = ["conv_id", "part", "piece"]

    def entry(rank: F.Column) -> F.Column:
        first, prefix, digest = _order_of("text")
        return F.struct(rank.alias("rank"), "turn", first.alias("r"), prefix.alias("p"), digest.alias("h"), "text", "role").alias("x")

    few = turns.join(large, here, "left_anti").select(
        "conv_id", "part", F.lit(0).cast("long").alias("piece"), entry(F.lit(0).cast("long")))
    # what these parts hold bounds the set; equal rows meet in it
    small = few.groupBy(*keys).agg(F.array_sort(F.collect_set("x")).alias("xs"))
    many = _numbered(turns.join(large, here, "left_semi").distinct())
    big = (many.select("conv_id", "part", F.floor(F.col("rank") / PART_TURNS).alias("piece"), entry(F.col("rank")))
           .groupBy(*keys).agg(F.array_sort(F.collect_list("x")).alias("xs")))
    said = small.unionByName(big).select(*keys, F.transform("xs", _written_turn).alias("ys"))
    return said.select(
        *keys, F.array_join(F.transform("ys", lambda y: y["w"]), "\n").alias("transcript"),
        F.transform("ys", lambda y: F.struct(
            y["role"].alias("role"),
            F.size(F.filter(F.split(y["w"], "\n"), lambda z: F.trim(z) != "")).cast("int").alias("n_lines"))).alias("turns"))


#: Pieces that are folded into one summary before a conversation's are.
BLOCK_PIECES = 4096
_N = N_STATES


class Span:
    """What a stretch of a conversation does to the scores of states: ``begun`` (if it begins the conversation), ``after[0]``
    and ``after[1]`` (if no blank line, or one, stands before it), and its blank lines and lines."""

    WIDTH = _N + 2 * _N * _N + 3

    def __init__(self, begun: np.ndarray, after: np.ndarray, lead: int, trail: int, lines: int):
        self.begun, self.after, self.lead, self.trail, self.lines = begun, after, lead, trail, lines

    @classmethod
    def of(cls, text: str | None, model: Model) -> Span:
        found = Lines(text)
        if not len(found.seen):
            return cls(np.zeros(_N, dtype=np.int64), np.zeros((2, _N, _N), dtype=np.int64), found.blank_after, 0, 0)
        after = np.stack([_level(model.across(found.following(k))) for k in (0, 1)])
        return cls(_level(model.begun(found.seen)), after, found.blank_first, found.blank_after, len(found.seen))

    def then(self, other: Span) -> Span:
        if not other.lines:
            if not self.lines:
                return Span(self.begun, self.after, self.lead + other.lead, 0, 0)
            return Span(self.begun, self.after, self.lead, self.trail + other.lead, self.lines)
        if not self.lines:
            return Span(other.begun, other.after, self.lead + other.lead, other.trail, other.lines)
        step = other.after[1 if self.trail + other.lead else 0]
        return Span(_level(_product(self.begun, step)), np.stack([_level(_product(m, step)) for m in self.after]), self.lead,
                    other.trail, self.lines + other.lines)

    def bytes(self) -> bytes:
        return np.concatenate([self.begun, self.after.ravel(), [self.lead, self.trail, self.lines]]).astype("<i8").tobytes()

    @classmethod
    def read(cls, raw: bytes) -> Span:
        x = np.frombuffer(raw, dtype="<i8")
        return cls(x[:_N], x[_N: _N + 2 * _N * _N].reshape(2, _N, _N), int(x[-3]), int(x[-2]), int(x[-1]))


class Entry(tuple):
    """(the state before a stretch, None where it begins the conversation; blank lines just before it; the state it ends in)"""

    def bytes(self) -> bytes:
        state, blank, last = self
        return np.array([-1 if state is None else state, blank, last], dtype="<i8").tobytes()

    @classmethod
    def read(cls, raw: bytes) -> Entry:
        state, blank, last = np.frombuffer(raw, dtype="<i8").tolist()
        return cls((None if state < 0 else state, blank, last))


def _only(state: int | None) -> np.ndarray | None:
    """Scores by which this state is certain."""
    return None if state is None else np.where(np.arange(_N) == state, 0, NEVER).astype(np.int64)


def along(spans: list[Span], entry: Entry | None = None) -> list[Entry]:
    """The entry of each of the stretches in a row; ``entry`` is that of all together (None: a whole conversation)."""
    scores, blank = (_only(entry[0]), entry[1]) if entry is not None else (None, 0)
    before = []
    for s in spans:
        before.append((scores, blank))
        if s.lines:
            scores = s.begun if scores is None else _level(_product(scores, s.after[1 if blank + s.lead else 0]))
            blank = s.trail
        elif scores is not None:
            blank += s.lead
    last = entry[2] if entry is not None else int(scores.argmax()) if scores is not None else 0
    out = []
    for s, (entered, gap) in zip(reversed(spans), reversed(before), strict=True):
        end = last
        if s.lines and entered is not None:
            last = int((entered + s.after[1 if gap + s.lead else 0][:, last]).argmax())
        out.append(Entry((None if entered is None else last, gap, end)))
    return out[::-1]


def _grouped(batches: Iterable[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """(key, rows without it) of each group of sorted rows."""
    held, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:n_keys] != held:
                if rows:
                    yield held, rows
                held, rows = row[:n_keys], []
            rows.append(row[n_keys:])
    if rows:
        yield held, rows


def _table(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)],
                                         schema=schema)


def piece_states(lines: Lines, model: Model, entry: Entry) -> list[int]:
    """The states of a piece's lines within its conversation."""
    entered, gap, last = entry
    seen = lines.seen if entered is None else lines.following(gap + lines.blank_first)
    return model.viterbi(seen, _only(entered), last)


def fragment(text: str | None, model: Model, entry: Entry, ended: str | None, more: bool) -> tuple[str, list[str]]:
    """(a piece's part of the rendered chat, the roles of the turns that begin in it).

    ``ended``: the last line with text before it (None: none), ``more``: whether lines with text follow.
    """
    lines = Lines(text)
    entered, gap, last = entry
    states = piece_states(lines, model, entry)
    out, roles = [], []

    def said(line: str) -> str:
        return line.replace(BEGIN, "<im_start>").replace(END, "<im_end>")

    open_ = entered is not None
    # white space that ends a line belongs to its turn only if the turn goes on; a marker alone is no content
    held, empty = "", False
    if open_:
        kind, at = marker(ended)
        held = ended[len(ended.rstrip()):]
        empty = kind < len(ROLES) and not ended[at:].strip()
    for i, (line, state) in enumerate(zip(lines.lines, states, strict=True)):
        blank = lines.blank_before[i] if i else gap + lines.blank_first
        if state % 2 == 0:
            if open_:
                out.append(f"{END}\n")
            kind, at = marker(line)
            rest = (line[at:] if kind < len(ROLES) else line).lstrip()
            roles.append(ROLES[state // 2])
            out.append(f"{BEGIN}{roles[-1]}\n{said(rest.rstrip())}")
            empty = not rest
            held = rest[len(rest.rstrip()):] if rest else ""
            open_ = True
        else:
            body = line.lstrip() if empty else line
            out.append(("" if empty else held + "\n" * (blank + 1)) + said(body.rstrip()))
            held, empty = body[len(body.rstrip()):], False
    if open_ and not more and lines.lines:
        out.append(f"{END}\n")
    return "".join(out), roles


def format_conversations(pieces: DataFrame, model: Model) -> DataFrame:
    """``conv_id, part, piece, chat, roles, n_turns`` of pieces (``conv_id, part, piece, transcript``): each conversation decoded
    as one transcript. A conversation's chats, in order of part and piece, are its one chat; ``roles`` and ``n_turns`` are of the turns
    that begin in the piece."""
    spark = pieces.sparkSession
    shared = spark.sparkContext.broadcast(model)
    id_type = pieces.schema["conv_id"].dataType
    named = pieces.select("conv_id", "part", "piece", "transcript")
    several = named.groupBy(F.col("conv_id").alias("_conv")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    alone = format_transcripts(named.join(several, same, "left_anti"), model)
    # the id as text, so that a null id is a key like any other
    key = F.concat(F.when(F.col("conv_id").isNull(), F.lit("-")).otherwise(F.lit("+")), F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    long = named.join(several, same, "left_semi").select(
        key.alias("key"), "part", F.floor(F.col("piece") / BLOCK_PIECES).alias("block"), "piece", "transcript")

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("transcript").to_pylist()
            last = [next((x for x in reversed((t or "").split("\n")) if x.strip()), None) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("key", "part", "block", "piece")),
                 pa.array([Span.of(t, shared.value).bytes() for t in texts], type=pa.binary()), pa.array(last, type=pa.string())],
                names=["key", "part", "block", "piece", "span", "last"])

    spans = written(long.mapInArrow(summed, "key string, part long, block long, piece long, span binary, last string"), "chat-spans")
    by_block = spans.repartition("key", "part", "block").sortWithinPartitions("key", "part", "block", "piece")
    blocks_schema = pa.schema([("key", pa.string()), ("part", pa.int64()), ("block", pa.int64()), ("span", pa.binary()), ("last", pa.string())])

    def folded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, rows in _grouped(batches, 3):
            whole, last = Span.read(rows[0][1]), rows[0][2]
            for _, raw, line in rows[1:]:
                whole, last = whole.then(Span.read(raw)), line if line is not None else last
            yield from _table([(*at, whole.bytes(), last)], blocks_schema)

    blocks = by_block.mapInArrow(folded, "key string, part long, block long, span binary, last string")
    in_order = blocks.repartition("key").sortWithinPartitions("key", "part", "block")
    entries_schema = pa.schema([("key", pa.string()), ("part", pa.int64()), ("block", pa.int64()), ("entry", pa.binary()),
                                ("ended", pa.string()), ("more", pa.bool_())])

    def entered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (name,), rows in _grouped(batches, 1):
            held = [Span.read(r[2]) for r in rows]
            yield from _table([(name, part, block, e.bytes(), ended, more) for (part, block, _, _), e, (ended, more) in zip(
                rows, along(held), _neighbours([r[3] for r in rows]), strict=True)], entries_schema)

    entries = in_order.mapInArrow(entered, "key string, part long, block long, entry binary, ended string, more boolean")
    inner = (spans.withColumnRenamed("last", "line").join(entries, ["key", "part", "block"])
             .select("key", "part", "block", "piece", "span", "line", "entry", "ended", "more")
             .repartition("key", "part", "block").sortWithinPartitions("key", "part", "block", "piece"))
    context_schema = pa.schema([("key", pa.string()), ("part", pa.int64()), ("piece", pa.int64()), ("entry", pa.binary()),
                                ("ended", pa.string()), ("more", pa.bool_())])

    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (name, part, _), rows in _grouped(batches, 3):
            _, _, _, raw, before, after = rows[0]
            found = along([Span.read(r[1]) for r in rows], Entry.read(raw))
            around = _neighbours([r[2] for r in rows], before, after)
            yield from _table([(name, part, r[0], e.bytes(), ended, more) for r, e, (ended, more) in zip(
                rows, found, around, strict=True)], context_schema)

    context = inner.mapInArrow(placed, "key string, part long, piece long, entry binary, ended string, more boolean")
    joined = long.drop("block").join(context, ["key", "part", "piece"]).select(
        "key", "part", "piece", "transcript", "entry", "ended", "more")

    def rendered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("transcript", "entry", "ended", "more")), strict=True)
            done = [fragment(t, shared.value, Entry.read(e), ended, more) for t, e, ended, more in rows]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("key", "part", "piece")), pa.array([c for c, _ in done], type=pa.string()),
                 pa.array([r for _, r in done], type=pa.list_(pa.string())), pa.array([len(r) for _, r in done], type=pa.int64())],
                names=["key", "part", "piece", "chat", "roles", "n_turns"])

    out = joined.mapInArrow(rendered, "key string, part long, piece long, chat string, roles array<string>, n_turns long")
    named_id = F.when(F.col("key") != "-", F.expr("substr(key, 2)").cast(id_type)).alias("conv_id")
    columns = ["conv_id", "part", "piece", "chat", "roles", "n_turns"]
    return alone.select(*columns).unionByName(out.select(named_id, *columns[1:]))


def _neighbours(lines: list[str | None], before: str | None = None, after: bool = False) -> list[tuple[str | None, bool]]:
    """(the last line with text before, whether one follows) of each of the stretches that end in these lines."""
    ended, more = [], []
    for line in lines:
        ended.append(before)
        before = line if line is not None else before
    for line in reversed(lines):
        more.append(after)
        after = after or line is not None
    return list(zip(ended, reversed(more), strict=True))
