"""Repeated passages by suffix automata.

A window is ``span`` consecutive words of one document. Every word covered by a
window that also starts in a document of a smaller id goes; windows are judged on
the input, not on what is left.

Shards. Every window names a seed: of the hashes of its runs of ``SEED`` words, the
least. Equal windows have equal seeds, so a seed's segments (the maximal runs
of windows with that seed, and their words) are a shard that needs no other: all
documents that could share a window meet there. Seeds that one document alone holds
(most of them) can't repeat and go no further. A shard's segments stream in order
of document id past a suffix automaton of the segments of smaller ids: where the
longest match ending at a word (its matching statistic) reaches ``span``, the
window ending there is repeated. Then the document's own segments join the
automaton. An automaton is sent nowhere but to its own shard's segments: one of all
documents, or a broadcast of all shards to all tasks, would grow with the corpus.

Copies. Of equal texts the one of the least id stands for all: the others lose every
word (where they have a window at all) and are never compared.

Sizes. What a piece of ``PIECE_BYTES`` of texts knows by itself (a seed in two
of its documents, equal segments) is folded before the shuffle. Shards of more
than ``shard_segments`` segments are never built: each window of such a seed is
looked up by 128 bits of hash in an aggregation that combines before it
shuffles, so a passage in a third of all documents meets in no task.

Defined cases: null text has no words (kept text empty); a text shorter than ``span`` loses nothing, whatever its
length the whole text counts, and so does one word of any length; rows of one id are one document, whose own
repeats stay; rows that repeat an id and a text get equal results each; rows with a null id neither lose nor take
words; an empty table gives no rows. Other columns have no influence and are not returned.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mobility.llm.common import slices, written
from mobility.llm.words import Words, mix

SPAN = 13
#: Words of a seed: fewer are shared by chance more often, more make more segments.
SEED = 7
#: Folded segments of a shard, and places of theirs, that may meet in one task.
SHARD_SEGMENTS = 16_384
SHARD_PLACES = 1_000_000
PIECE_BYTES = 4 << 20
#: Place of a span that stands for the whole text.
WHOLE = -1
#: A hot seed's documents of one piece are spread over this many groups.
SPREAD = 4096
_STEP = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD6E8FEB86659FD93)


class SuffixAutomaton:
    """A suffix automaton of several word sequences, extended word by word."""

    def __init__(self):
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, words: list[bytes]) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w)

    def _extend(self, last: int, w: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length
        known = nxt[last].get(w)
        if known is not None:
            return known if length[known] == length[last] + 1 else self._split(last, w, known)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return new

    def _split(self, p: int, w: bytes, q: int) -> int:
        """A copy of state ``q`` for the shorter sequences that reach it through ``p``."""
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = copy
            p = link[p]
        return copy

    def statistics(self, words: list[bytes]) -> list[int]:
        """Length of the longest match that ends at each word."""
        nxt, link, length = self.next, self.link, self.length
        state = matched = 0
        out = []
        for w in words:
            to = nxt[state].get(w)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = nxt[state].get(w)
            if to is not None:
                state = to
                matched += 1
            out.append(matched)
        return out


def _grams(h: np.ndarray, k: int, step: np.uint64 = _STEP) -> np.ndarray:
    """A hash of every run of ``k`` words, from the words' hashes."""
    n = len(h) - k + 1
    g = h[:n].copy()
    for j in range(1, k):
        g *= step
        g += h[j: n + j]
    return mix(g)


class Segments:
    """The segments of a piece: ``seed``, ``row`` (text), ``at`` (its first window,
    by the words of the piece), ``n`` (windows, at most ``span``), ``content`` (a hash of its words)."""

    def __init__(self, words: Words, span: int):
        self.words = words
        h = words.hashes()
        self.hashes = h
        k = min(SEED, span)
        n = max(len(h) - span + 1, 0)
        if n:
            g = _grams(h, k)
            seed = g[:n].copy()
            for j in range(1, span - k + 1):
                np.minimum(seed, g[j: n + j], out=seed)
            at = np.flatnonzero(words.text_of[:n] == words.text_of[span - 1:])
            seed, row = seed[at], words.text_of[at]
        else:
            at, seed, row = (np.zeros(0, dtype=t) for t in (np.int64, np.uint64, np.int64))
        change = np.ones(len(at), dtype=bool)
        change[1:] = (seed[1:] != seed[:-1]) | (row[1:] != row[:-1])
        starts = np.flatnonzero(change)
        # longer runs (of repetitive text) are cut, so that the first and the last window hold all words
        place = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
        starts = np.flatnonzero(place % span == 0)
        self.n = np.diff(np.append(starts, len(at)))
        self.seed, self.row, self.at = seed[starts], row[starts], at[starts]
        # a hash of all its words: the first and the last window hold them
        g = _grams(h, span) if n else h[:0]
        self.content = mix(g[self.at] * _STEP + g[self.at + self.n - 1] + self.n.astype(np.uint64))


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _rows(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """``r, doc_id, t``: ``r`` is a key of the id and the text, the same for equal rows.

    Every use of the texts by key reads these columns of this frame, so that they are shuffled once.
    """
    t = F.col(f"`{text}`").cast("string")
    key = F.col(f"`{id_col}`").cast("long")
    return df.select(F.xxhash64(key, key.isNull(), t).alias("r"), key.alias("doc_id"), t.alias("t"))


def copies_and_firsts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``r, doc_id`` of texts that a smaller id has too, ``r`` of the first of each text)"""
    texts = written(rows.where("doc_id is not null and t is not null").select(
        "r", "doc_id", F.xxhash64("t").alias("h1"), F.xxhash64(F.lit(7), "t").alias("h2")), "substring-texts")
    firsts = texts.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.min_by("r", "doc_id").alias("first"))
    copies = texts.join(firsts, ["h1", "h2"]).where("doc_id > least").select("r", "doc_id").distinct()
    return copies, firsts.select(F.col("first").alias("r"))


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted table's rows differ from the row before."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def shared_seeds(rows: DataFrame, span: int, shard_segments: int, shard_places: int) -> DataFrame:
    """``m, r, large``: the seeds of each row that another row holds too.

    ``large``: the seed has more than ``shard_segments`` segments (equal ones of a piece are one) or ``shard_places`` places.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, PIECE_BYTES, "t"):
                s = Segments(Words(batch.column(1)), span)
                if not len(s.seed):
                    continue
                r = batch.column(0).to_numpy()[s.row]
                # for each seed of the piece: its places, its different segments
                order = np.lexsort((s.content, s.seed))
                m, content = s.seed[order], s.content[order]
                heads = np.flatnonzero(_heads(m))
                places = np.diff(np.append(heads, len(m)))
                contents = np.add.reduceat(_heads(m, content).astype(np.int64), heads)
                seeds = m[heads]
                # and its rows
                order = np.lexsort((r, s.seed))
                m, r = s.seed[order], r[order]
                first = np.flatnonzero(_heads(m, r))
                m, r = m[first], r[first]
                of = np.searchsorted(seeds, m)
                alone = np.bincount(of)[of] == 1
                # a seed of several rows of this piece: one row for the counts, theirs apart from it
                several = np.flatnonzero(~alone)
                shared = np.unique(of[several])
                counted = np.concatenate([of[alone], shared])
                none = np.zeros(len(several), dtype=np.int32)
                yield pa.RecordBatch.from_arrays([
                    _long(np.concatenate([m[alone], seeds[shared], m[several]])),
                    pa.array(np.concatenate([np.zeros(len(counted), dtype=np.int32), 1 + (r[several] % SPREAD).astype(np.int32)])),
                    pa.concat_arrays([pa.array(r[alone]), pa.nulls(len(shared), pa.int64()), pa.array(r[several])]),
                    pa.array(np.concatenate([contents[counted].astype(np.int32), none])),
                    pa.array(np.concatenate([places[counted].astype(np.int32), none]))], names=["m", "salt", "r", "c", "p"])

    found = rows.where("doc_id is not null").select("r", "t").mapInArrow(run, "m long, salt int, r long, c int, p int")
    group = Window.partitionBy("m", "salt")
    marked = found.select("m", "salt", "r", F.count(F.lit(1)).over(group).alias("rows"),
                          F.sum("c").over(group).alias("contents"), F.sum("p").over(group).alias("places"))
    large = (F.col("salt") == 0) & ((F.col("contents") > shard_segments) | (F.col("places") > shard_places))
    # a lone row with an id is a seed that no other piece and no other row of its own piece holds
    seeds = written(marked.where("salt > 0 or r is null or rows > 1").select("m", "r", large.alias("large")), "substring-seeds")
    marks = seeds.where("large").select("m").distinct().withColumn("is_large", F.lit(True))
    return (seeds.where("r is not null").select("m", "r").join(marks, "m", "left")
            .select("m", "r", F.coalesce("is_large", F.lit(False)).alias("large")))


def _with_seeds(rows: DataFrame, seeds: DataFrame, firsts: DataFrame) -> DataFrame:
    lists = seeds.groupBy("r").agg(F.collect_set("m").alias("ms")).join(firsts, "r", "left_semi")
    return rows.join(lists, "r").select("r", "doc_id", "t", "ms")


def _held_segments(batches: Iterable[pa.RecordBatch], span: int) -> Iterator[tuple[pa.RecordBatch, Segments, np.ndarray]]:
    """Each piece (of rows that differ), its segments, and the places of those whose seed is in their row's list."""
    for whole in batches:
        for piece in slices(whole, PIECE_BYTES, "t"):
            batch = piece.take(pa.array(np.unique(piece.column("r").to_numpy(), return_index=True)[1]))
            s = Segments(Words(batch.column("t")), span)
            lists = batch.column("ms")
            listed = np.unique(lists.flatten().to_numpy().view(np.uint64))
            keep = np.flatnonzero(np.isin(s.seed, listed)) if len(listed) else np.zeros(0, dtype=np.int64)
            # a seed in another row's list only: (row, seed) pairs decide
            of = np.repeat(np.arange(batch.num_rows), np.asarray(pa.compute.list_value_length(lists)))
            place = np.searchsorted(listed, lists.flatten().to_numpy().view(np.uint64))
            pairs = np.sort(of * len(listed) + place)
            mine = s.row[keep] * len(listed) + np.searchsorted(listed, s.seed[keep])
            at = np.minimum(np.searchsorted(pairs, mine), max(len(pairs) - 1, 0))
            keep = keep[pairs[at] == mine] if len(pairs) else keep[:0]
            if len(keep):
                yield batch, s, keep


def _segment_rows(rows: DataFrame, seeds: DataFrame, firsts: DataFrame, span: int) -> DataFrame:
    """``m, ch, n, places, words``: the segments of shared seeds, equal ones of a piece as one row;
    ``places``: its (doc_id, r, pos), 64 bits each."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, s, keep in _held_segments(batches, span):
            w = s.words
            keep = keep[np.lexsort((s.content[keep], s.seed[keep]))]
            seed, row, at, n, ch = s.seed[keep], s.row[keep], s.at[keep], s.n[keep], s.content[keep]
            places = np.stack([batch.column("doc_id").to_numpy()[row], batch.column("r").to_numpy()[row], at - w.first[row]], axis=1)
            heads = np.flatnonzero(_heads(seed, ch))
            sizes = places.strides[0] * np.append(heads, len(seed))
            packed = pa.Array.from_buffers(pa.binary(), len(heads), [
                None, pa.py_buffer(sizes.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(places, dtype="<i8"))])
            last = (at + n + span - 2)[heads]
            ends = w.start[last] + w.size[last]
            words = [w.buffer[a:b] for a, b in zip(w.start[at[heads]].tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [_long(seed[heads]), _long(ch[heads]), pa.array(n[heads].astype(np.int32)), packed, pa.array(words, type=pa.binary())],
                names=["m", "ch", "n", "places", "words"])

    return _with_seeds(rows, seeds, firsts).mapInArrow(run, "m long, ch long, n int, places binary, words binary")


def repeated_in_shard(segments: list[tuple[int, int, bytes]], span: int) -> list[int]:
    """For distinct segments (key, least id, words): the bits of the windows that
    segments of smaller ids hold."""
    masks = [0] * len(segments)
    if len(segments) < 2:
        return masks
    order = sorted(range(len(segments)), key=lambda i: segments[i][1])
    split = [s[2].split() for s in segments]
    automaton = SuffixAutomaton()
    i = 0
    while i < len(order):
        j = i
        while j < len(order) and segments[order[j]][1] == segments[order[i]][1]:
            j += 1
        if i:
            for k in order[i:j]:
                masks[k] = sum(1 << at for at, long in enumerate(automaton.statistics(split[k])[span - 1:]) if long >= span)
        if j < len(order):
            for k in order[i:j]:
                automaton.add(split[k])
        i = j
    return masks


def _shard_spans(segments: DataFrame, span: int) -> DataFrame:
    """``r, doc_id, pos, bits``: the repeated windows from window ``pos`` on, a bit each."""
    placed = segments.repartition("m").sortWithinPartitions("m", "ch")
    names = ["r", "doc_id", "pos", "bits"]
    one = 3 * 8  # bytes of a place

    def shard(rows: list[tuple], out: list[int]) -> None:
        """Rows (ch, n, places, words) of one seed, sorted; adds what is repeated, four numbers a span."""
        distinct: list[tuple[int, int, bytes]] = []
        held: list[tuple[int, list[int]]] = []
        i = 0
        while i < len(rows):
            ch, n, raw, words = rows[i]
            j = i + 1
            while j < len(rows) and rows[j][0] == ch:
                j += 1
            places = memoryview(raw if j == i + 1 else b"".join([r[2] for r in rows[i:j]])).cast("q").tolist()
            if j > i + 1 and len(set(zip(places[1::3], places[2::3], strict=True))) * 3 < len(places):
                places = [x for place in sorted(set(zip(*(places[k::3] for k in range(3)), strict=True))) for x in place]  # given twice
            held.append((n, places))
            distinct.append((ch, min(places[::3]), words))
            i = j
        for (n, places), (_, least, _), mask in zip(held, distinct, repeated_in_shard(distinct, span), strict=True):
            whole = (1 << n) - 1
            for doc, r, pos in zip(places[::3], places[1::3], places[2::3], strict=True):
                bits = whole if doc > least else mask
                if bits:
                    out += (r, doc, pos, bits)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed, rows, out = None, [], []

        def batch_of(found: list[int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(found[k::4], type=pa.int64()) for k in range(4)], names=names)

        for batch in batches:
            ms, *rest = (c.to_pylist() for c in batch.columns)
            for m, row in zip(ms, zip(*rest, strict=True), strict=True):
                if m != seed:
                    if len(rows) > 1 or rows and len(rows[0][2]) > one:
                        shard(rows, out)
                    seed, rows = m, []
                rows.append(row)
            if out:
                yield batch_of(out)
                out = []
        if len(rows) > 1 or rows and len(rows[0][2]) > one:
            shard(rows, out)
        if out:
            yield batch_of(out)

    return placed.mapInArrow(run, "r long, doc_id long, pos long, bits long")


def _window_spans(rows: DataFrame, seeds: DataFrame, firsts: DataFrame, span: int) -> DataFrame:
    """``r, doc_id, pos, bits`` of the windows of large seeds, one window a row."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, s, keep in _held_segments(batches, span):
            n = s.n[keep]
            row = np.repeat(s.row[keep], n)
            at = np.repeat(s.at[keep] - np.cumsum(n) + n, n) + np.arange(n.sum())
            yield pa.RecordBatch.from_arrays(
                [_long(_grams(s.hashes, span)[at]), _long(_grams(s.hashes, span, _OTHER)[at]),
                 pa.array(batch.column("doc_id").to_numpy()[row]), pa.array(batch.column("r").to_numpy()[row]),
                 pa.array(at - s.words.first[row])], names=["h1", "h2", "doc_id", "r", "pos"])

    windows = _with_seeds(rows, seeds, firsts).mapInArrow(run, "h1 long, h2 long, doc_id long, r long, pos long")
    least = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    return (windows.join(least, ["h1", "h2"]).where("doc_id > least")
            .select("r", "doc_id", "pos", F.lit(1).cast("long").alias("bits")))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text: str = "text", span: int = SPAN,
                   shard_segments: int = SHARD_SEGMENTS, shard_places: int = SHARD_PLACES) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (the kept words joined by one space) of every row."""
    if not 1 <= span <= 62:
        raise ValueError("a window has 1 to 62 words")
    rows = _rows(df, id_col, text)
    copies, firsts = copies_and_firsts(rows)
    seeds = shared_seeds(rows, span, shard_segments, shard_places)
    spans = _shard_spans(_segment_rows(rows, seeds.where("not large"), firsts, span), span)
    if not seeds.where("large").isEmpty():
        spans = spans.unionByName(_window_spans(rows, seeds.where("large"), firsts, span))
    spans = spans.unionByName(copies.select("r", "doc_id", F.lit(WHOLE).cast("long").alias("pos"), F.lit(0).cast("long").alias("bits")))
    found = spans.groupBy("r").agg(F.collect_list(F.struct("doc_id", "pos", "bits")).alias("spans"))
    width = np.arange(span)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, PIECE_BYTES, "t"):
                w = Words(batch.column("t"))
                gone = np.zeros(len(w), dtype=bool)
                lists = batch.column("spans")
                of = np.repeat(np.arange(batch.num_rows), np.asarray(pa.compute.list_value_length(lists).fill_null(0)))
                if len(of):
                    flat = lists.flatten()
                    doc, pos, bits = (flat.field(k).to_numpy() for k in range(3))
                    own = np.asarray(batch.column("doc_id").fill_null(0))[of] == doc
                    for i in np.unique(of[own & (pos == WHOLE)]).tolist():
                        a, b = int(w.first[i]), int(w.first[i + 1])
                        gone[a:b] = b - a >= span
                    own &= pos != WHOLE
                    at = (w.first[of] + pos)[own]
                    bits = bits[own]
                    for k in range(span):
                        window = at[(bits >> k & 1).astype(bool)] + k
                        gone[(window[:, None] + width).ravel()] = True
                n_words = np.diff(w.first)
                removed = np.bincount(w.text_of[gone], minlength=batch.num_rows)
                kept = [w.joined(i, ~gone[w.first[i]: w.first[i + 1]] if x else None) for i, x in enumerate(removed.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n_words), pa.array(removed), pa.array(kept, type=pa.binary()).cast(pa.string())],
                    names=[id_col, "n_words", "n_removed", "kept"])

    joined = rows.join(found, "r", "left").select("doc_id", "t", "spans")
    return joined.mapInArrow(run, f"`{id_col}` long, n_words long, n_removed long, kept string")
