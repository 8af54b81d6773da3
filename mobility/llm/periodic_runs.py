"""Periodic runs of words, by grammar-compressed detection.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart
are equal) of at least ``max(least, 4 * q)`` words that no neighbouring word
extends. A run's words after its first ``q`` are repetition; ``collapsed`` is a text
without them.

Method. Re-Pair over each document's word ids: a round replaces the pairs that are
more frequent than the pairs they overlap (of equal pairs in a row every other one) by
a nonterminal, until no pair occurs twice; what is left is the document's start
rule. Every run crosses a boundary: that of the lowest nonterminal whose expansion
holds it, or one of the start rule. Runs that cross a nonterminal's boundary are computed
once, inside its expansion, at its first occurrence; they are translated to all its
derivation positions by adding up the rules' lengths, and intervals that a longer one of
their period holds are merged into it.

Crossing runs. A run of period ``q`` has ``2 * q`` of its words on one side of the
boundary, so the ``q + 1`` words at the boundary come again ``q`` words on (or back).
Runs of ``k = 2, 4, 8, ...`` words have ids wherever they occur twice in the document, so
the periods ``k - 1 .. 2 * k - 2`` are distances between equal ids, and two pairs of equal ids
prove the square. Where a run is found, its multiples are skipped (by Fine and
Wilf they can't be smallest periods); so few candidates stay, however periodic the text.

Texts are handled a piece of ``PIECE_BYTES`` at a time, all documents of it at once;
no row leaves its task and nothing is shuffled.

Defined cases: null text has no words and no runs (collapsed text empty); a very long text is one piece, computed
whole; runs of different periods may overlap and all count; rows that repeat an id or a text get a result each; a null id stays
null; an empty table gives no rows. Other columns have no influence and are not returned.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobility.llm.common import slices
from mobility.llm.words import Words, mix

LEAST = 6
EXPONENT = 4
#: Words of a stretch up to which its equals are looked for at every distance.
NEAR = 8
#: A piece whose arrays stay in the processor cache takes a quarter less time than one of 2 MB.
PIECE_BYTES = 384 << 10

Interval = tuple[int, int, int]  # period, start, end


def word_ids(words: Words) -> np.ndarray:
    """Ids of the words, equal for equal words of one text only."""
    of = words.text_of.astype(np.uint64)
    return pd.factorize((words.hashes() ^ mix(of + np.uint64(1))).view(np.int64))[0].astype(np.int64)


class Grammar:
    """Re-Pair rules and what is left. Symbols below ``terminals`` are word ids; symbol
    ``terminals + i`` is rule ``i``: ``left``, ``right``, and its first occurrence in
    the text, words ``start``, ``middle`` (where the right part begins), ``end``.
    ``symbols`` and ``places``: the start rules, and the first word of each symbol.
    ``rounds``: the number of rules after each round."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        self.terminals = int(ids.max()) + 1 if n else 0
        # symbols stay at the place of their first word; ``after`` and ``before`` name the next and the last one's
        symbols, total = np.append(ids, -1), self.terminals
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        gone = np.zeros(n, dtype=bool)
        parts: list[tuple[np.ndarray, ...]] = []
        self.rounds = [0]
        live = np.arange(max(n - 1, 0))  # places of pairs that may occur twice
        while len(live) > 1:
            code = pd.factorize(symbols[live] * (2 * n + 1) + symbols[after[live]])[0]
            beside = after[live[:-1]] == live[1:]
            # stretches of one pair overlapping itself: every other place counts
            head = np.ones(len(live), dtype=bool)
            head[1:] = ~beside | (code[1:] != code[:-1])
            starts = np.flatnonzero(head)
            sizes = np.diff(np.append(starts, len(live)))
            even = (np.arange(len(live)) - np.repeat(starts, sizes)) % 2 == 0
            count = np.bincount(code[even], minlength=len(code))
            twice = count[code] > 1
            rank = np.where(twice, count[code] * len(code) + code, -1)[starts]
            touch = beside[starts[1:] - 1]
            ahead = np.append(np.where(touch, rank[1:], -1), -1)
            behind = np.concatenate([[-1], np.where(touch, rank[:-1], -1)])
            chosen = np.repeat((rank >= 0) & (rank > behind) & (rank > ahead), sizes) & even
            chosen &= np.bincount(code[chosen], minlength=len(code))[code] > 1
            at = live[chosen]
            if not len(at):
                break
            _, first, new = np.unique(code[chosen], return_index=True, return_inverse=True)
            right = after[at]
            end = after[right]
            parts.append((symbols[at][first], symbols[right][first], at[first], right[first], end[first]))
            symbols[at] = total + new
            gone[right] = True
            after[at] = end
            before[end] = at
            total += len(first)
            self.rounds.append(total - self.terminals)
            # what may occur twice from now on: pairs that did and still stand, and those of new symbols
            rest = live[twice & ~chosen]
            rest = np.concatenate([rest[~gone[rest]], at, before[at]])
            rest = rest[(rest >= 0)]
            live = np.unique(rest[after[rest] < n])
        self.places = np.flatnonzero(~gone)
        self.symbols = symbols[self.places]
        empty = np.zeros(0, dtype=np.int64)
        self.left, self.right, self.start, self.middle, self.end = (
            (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (empty,) * 5)


class _Equal:
    """Ids of the stretches of ``k`` words that occur twice in a text; -1 for the others."""

    def __init__(self, ids: np.ndarray):
        self.k = 1
        self.code = ids
        self.n = len(ids)

    def double(self) -> bool:
        """Go on to stretches twice as long; False if none occurs twice."""
        k, code = self.k, self.code
        at = np.flatnonzero((code[: max(self.n - k, 0)] >= 0) & (code[k:] >= 0))
        pairs = pd.factorize(code[at] * (self.n + 1) + code[at + k])[0]
        twice = np.bincount(pairs)[pairs] > 1 if len(pairs) else np.zeros(0, dtype=bool)
        at, pairs = at[twice], pairs[twice].astype(np.int64)
        self.code = np.full(self.n, -1, dtype=np.int64)
        self.code[at] = pairs
        self.k = 2 * k
        self.sorted = np.sort(pairs * self.n + at)  # by id, then place
        return bool(len(at))


def crossing_runs(ids: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray,
                  least: int = LEAST) -> dict[int, set[Interval]]:
    """The runs of the words ``start .. end`` that cross the boundary ``middle``, by the boundary's place.

    ``low`` and ``high`` bound the boundary's text.
    """
    found: dict[int, set[Interval]] = {}
    differ: dict[tuple[int, int], np.ndarray] = {}

    def extent(b: int, q: int, place: int) -> Interval | None:
        """The stretch of period ``q`` around ``place`` inside the boundary's words."""
        key = (int(low[b]), q)
        if key not in differ:
            text = ids[low[b]: high[b]]
            differ[key] = np.flatnonzero(text[:-q] != text[q:]) + low[b]
        d = differ[key]
        j = int(np.searchsorted(d, place))
        x = max(int(d[j - 1]) + 1 if j else int(low[b]), int(start[b]))
        y = min(int(d[j]) + q if j < len(d) else int(high[b]), int(end[b]))
        return (q, x, y) if y - x >= max(least, EXPONENT * q) and x < middle[b] < y else None

    equal = _Equal(ids)
    n = len(ids)
    sizes = end - start
    skip = np.zeros((2, len(middle)), dtype=np.int64)

    def possible(back: int, b: np.ndarray, q: np.ndarray | int) -> np.ndarray:
        """Whether the boundary's words have room for a run of period ``q`` on that side."""
        inside = middle[b] - 2 * q >= start[b] if back else middle[b] + 2 * q <= end[b]
        return inside & (EXPONENT * q <= sizes[b]) & (q > skip[back][b])

    def squares(back: int, b: np.ndarray, q: np.ndarray) -> None:
        """Find the runs of the boundaries whose words at the boundary come again ``q`` words on (or back)."""
        k, code, m = equal.k, equal.code, middle[b]
        far, near = (m - q, m - 2 * q) if back else (m + 2 * q - k, m + q - k)
        for j in np.flatnonzero((code[near] >= 0) & (code[near] == code[far])).tolist():
            at, place = int(b[j]), int(m[j])
            run = extent(at, int(q[j]), place - int(q[j]) if back else place - 1)
            if run is not None:
                found.setdefault(at, set()).add(run)
                reach = place - run[1] if back else run[2] - place
                skip[back][at] = max(skip[back][at], reach // 2)

    while equal.double():
        k, code, occur = equal.k, equal.code, equal.sorted
        fits = np.flatnonzero(sizes >= max(least, EXPONENT * (k - 1)))
        if not len(fits):
            break
        for back in (0, 1):
            # the k words at the boundary, if they occur twice
            anchor = middle[fits] - k + 1 if back else middle[fits] - 1
            use = code[np.maximum(anchor, 0)] >= 0
            use &= anchor >= 0
            b, a = fits[use], anchor[use]
            own = code[a]
            if k <= NEAR:
                for q in range(k - 1, 2 * k - 1):
                    other = np.maximum(a - q, 0) if back else np.minimum(a + q, n - 1)
                    same = np.flatnonzero(code[other] == own)
                    same = same[possible(back, b[same], q)]
                    squares(back, b[same], np.full(len(same), q))
                continue
            q = np.maximum(skip[back][b] + 1, k - 1)
            while len(b):
                # the next place of these k words that is q words on (back) or more
                if back:
                    i = np.searchsorted(occur, own * n + np.maximum(a - q, -1), side="right") - 1
                else:
                    i = np.searchsorted(occur, own * n + a + q)
                value = occur[np.clip(i, 0, len(occur) - 1)]
                q = a - value % n if back else value % n - a
                on = (i >= 0) & (i < len(occur)) & (value // n == own) & (q >= k - 1) & (q <= 2 * k - 2)
                on &= possible(back, b, q)
                b, a, own, q = b[on], a[on], own[on], q[on]
                squares(back, b, q)
                q = np.maximum(q, skip[back][b]) + 1
    return found


def merged(runs: Iterable[Interval]) -> list[Interval]:
    """The intervals that no other one of their period holds."""
    out: list[Interval] = []
    for q, x, y in sorted(set(runs), key=lambda r: (r[0], r[1], -r[2])):
        if not out or out[-1][0] != q or y > out[-1][2]:
            out.append((q, x, y))
    return out


def runs_of(words: Words, least: int = LEAST) -> list[list[Interval]]:
    """The runs (period, first word, end; words of the piece) of each text."""
    texts = len(words.first) - 1
    out: list[list[Interval]] = [[] for _ in range(texts)]
    ids = word_ids(words)
    if len(ids) < least:
        return out
    g = Grammar(ids)
    rules = np.flatnonzero(g.end - g.start >= least)
    place = g.places
    text = words.text_of[place]
    tops = np.flatnonzero((text[1:] == text[:-1])) + 1
    tops = tops[np.diff(words.first)[text[tops]] >= least]
    low, high = words.first[:-1], words.first[1:]
    of = np.concatenate([words.text_of[g.start[rules]], text[tops]])
    found = crossing_runs(
        ids, np.concatenate([g.start[rules], low[text[tops]]]), np.concatenate([g.middle[rules], place[tops]]),
        np.concatenate([g.end[rules], high[text[tops]]]), low[of], high[of], least)
    # runs of each rule's whole expansion, from its start: its own and those of its parts
    has = np.zeros(g.terminals + len(g.left), dtype=bool)
    own = {int(rules[j]): runs for j, runs in found.items() if j < len(rules)}
    has[[g.terminals + r for r in own]] = True
    inside: dict[int, list[Interval]] = {}
    for a, b in zip(g.rounds[:-1], g.rounds[1:], strict=True):
        mine = g.terminals + np.arange(a, b)
        has[mine] |= has[g.left[a:b]] | has[g.right[a:b]]
        for r in (np.flatnonzero(has[mine]) + a).tolist():
            s, shift = int(g.start[r]), int(g.middle[r] - g.start[r])
            inside[g.terminals + r] = merged(
                [(q, x - s, y - s) for q, x, y in own.get(r, ())] + inside.get(int(g.left[r]), [])
                + [(q, x + shift, y + shift) for q, x, y in inside.get(int(g.right[r]), [])])
    for j, runs in found.items():
        if j >= len(rules):
            out[int(text[tops[j - len(rules)]])].extend(runs)
    for j in np.flatnonzero(has[g.symbols]).tolist():
        out[int(text[j])].extend((q, x + int(place[j]), y + int(place[j])) for q, x, y in inside[int(g.symbols[j])])
    return [merged(runs) if runs else runs for runs in out]


RUN = "struct<start: bigint, length: bigint, period: bigint>"


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``doc_id, runs, strongest, collapsed`` of every row: runs by start, then period, and the
    one of greatest length by period (ties: the first of them; null without runs)."""
    src = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("string").alias("t"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_type = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
        for whole in batches:
            for batch in slices(whole, PIECE_BYTES, "t"):
                w = Words(batch.column(1))
                runs, best, texts = [], [], []
                for i, found in enumerate(runs_of(w, least)):
                    base = int(w.first[i])
                    keep, top, rows = None, None, []
                    if found:
                        keep = np.ones(int(w.first[i + 1]) - base, dtype=bool)
                    for x, q, y in sorted((x - base, q, y - base) for q, x, y in found):
                        keep[x + q: y] = False
                        row = {"start": x, "length": y - x, "period": q}
                        rows.append(row)
                        if top is None or row["length"] * top["period"] > top["length"] * q:
                            top = row
                    runs.append(rows)
                    best.append(top)
                    texts.append(w.joined(i, keep))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(runs, type=pa.list_(run_type)), pa.array(best, type=run_type),
                     pa.array(texts, type=pa.binary()).cast(pa.string())], names=[id_col, "runs", "strongest", "collapsed"])

    id_type = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"`{id_col}` {id_type}, runs array<{RUN}>, strongest {RUN}, collapsed string")


def with_planted_runs(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text``; in a tenth of the texts (by the id's CRC-32) the words from one
    place on become repetitions of a period, both drawn from the same CRC-32."""
    h = F.crc32(F.col(f"`{id_col}`").cast("string"))
    t = F.col(f"`{text}`").cast("string")
    parts = df.select(F.col(f"`{id_col}`"), t.alias("t"), h.alias("h"),
                      F.when(h % 10 == 0, F.array_remove(F.split(t, "[\\x20\\x09-\\x0D]+"), "")).alias("ws"))
    sized = parts.withColumn("n", F.greatest(F.size("ws"), F.lit(0))).withColumn("g", F.floor(F.col("h") / 10))
    placed = sized.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.greatest("n", F.lit(1))).cast("int"))
    drawn = placed.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    tail = F.slice(F.flatten(F.array_repeat(F.slice("ws", F.col("a") + 1, F.col("p")), F.expr("cast((n - a) div p + 1 as int)"))),
                   F.lit(1), F.col("n") - F.col("a"))
    return drawn.select(
        f"`{id_col}`",
        F.when(F.col("a").isNotNull(), F.array_join(F.concat(F.slice("ws", F.lit(1), F.col("a")), tail), " ")).otherwise(F.col("t")).alias(text))
