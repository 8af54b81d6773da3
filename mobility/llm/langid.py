"""Language identification by segmentation-marginalised unigrams.

The pieces are those of a public vocabulary (a ``sentencepiece`` model; its path is a
parameter): its pieces of letters, in lower case, with the mark of a word's
beginning, and every single letter seen in training. Each language has
probabilities for them, learned by expectation-maximisation. A word (a run of letters
in lower case) has, in a language, the probability summed over all its
segmentations into pieces, by the forward algorithm; a text has the product over its
words. The prediction is the language with the greatest posterior under
equal priors, and the score that posterior.

Training reads a sample of the labelled rows: about ``sample_docs`` whole texts a
language, chosen by a hash of the id and the text, so one id on many rows brings no more than its share (all texts of
languages with fewer; repeated rows once); its
word counts are made by Spark, and each language's model is fitted in a task of
its own on its counts. What is broadcast is bounded by pieces times languages.
Prediction takes the text only. Words already scored are kept in a bounded table
per worker, new ones of an Arrow batch are scored together by NumPy.

Defined cases: text that is null or has no letter gives ``und`` with score 0;
letters outside all pieces have one small probability in every language; ties take the first language in
order; a very long text counts whole, and so does a very long word; columns named like an output give way to it; labels may be null (not learned from); with no labelled row at all every
prediction is ``und`` with score 0; ids may be null or repeat; an empty table gives no rows.
"""
from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mobility.llm.common import binary_values, held, slices, with_replaced, written

UNDETERMINED = "und"
#: Texts of a language that the fit reads, about (bound of the training sample).
SAMPLE_DOCS = 400
ROUNDS = 4
#: Probability of a letter outside all pieces, and least probability of a piece.
FLOOR = 1e-8
#: Weight that a language's fit gives to the mean of all languages' fits.
SMOOTHING = 0.01
#: Letters of a word that are learned from together: a longer word is learned from in stretches, scored whole.
STRETCH = 100
CACHE_ENTRIES = 80_000
PIECE_BYTES = 1 << 20
MARK = "▁"
WORDS = r"\p{L}[\p{L}\p{M}]*"
_BASE = np.uint64(1_000_003)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def read_pieces(path: str) -> list[str]:
    """The vocabulary's pieces of letters, in lower case."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {sp.id_to_piece(i).lower() for i in range(sp.get_piece_size())}
    return sorted(p for p in pieces if p.removeprefix(MARK).isalpha())


class Pieces:
    """Pieces by rolling hash, in an open table that NumPy probes for many at once.

    Prefixes of pieces are in it too (as number -1), so that a search ends where
    no longer piece can match.
    """

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        entries: dict[int, int] = {}
        for p in pieces:
            h = 0
            for c in p:
                h = (h * int(_BASE) + ord(c)) & 0xFFFFFFFFFFFFFFFF
                entries.setdefault(h, -1)
        for i, p in enumerate(pieces):
            h = 0
            for c in p:
                h = (h * int(_BASE) + ord(c)) & 0xFFFFFFFFFFFFFFFF
            entries[h] = i
        self.longest = max(map(len, pieces), default=1)
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(entries)))) + 3))
        size = 1 << self.bits
        self.keys = np.zeros(size, dtype=np.uint64)
        self.values = np.full(size, -2, dtype=np.int32)
        self.probes = 1
        for h, i in entries.items():
            at, n = ((h * int(_SPREAD)) & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits), 1
            while self.values[at] != -2:
                at, n = (at + 1) & (size - 1), n + 1
            self.keys[at], self.values[at] = h, i
            self.probes = max(self.probes, n)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of the piece; -1: a prefix only; -2: neither."""
        at = ((hashes * _SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)
        found = np.where(self.keys[at] == hashes, self.values[at], -2)
        todo = np.flatnonzero((found == -2) & (self.values[at] != -2))
        for _ in range(self.probes - 1):
            if not todo.size:
                break
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)
            here = at[todo]
            hit = self.keys[here] == hashes[todo]
            found[todo[hit]] = self.values[here[hit]]
            todo = todo[~hit & (self.values[here] != -2)]
        return found

    def edges(self, codes: np.ndarray) -> Iterator[list[tuple[int, np.ndarray, np.ndarray]]]:
        """For words of one length (a row of code points each), by start: all
        (length, rows, pieces) that match there. Letters of their own that are
        no piece have number ``len(pieces)``."""
        n_words, n = codes.shape
        for i in range(n):
            here = []
            rows = np.arange(n_words)
            h = np.zeros(n_words, dtype=np.uint64)
            for length in range(1, min(self.longest, n - i) + 1):
                h = h * _BASE + codes[rows, i + length - 1]
                found = self.find(h)
                if length == 1:
                    single = np.where(found >= 0, found, len(self.pieces))
                    here.append((1, rows, single))
                else:
                    hit = found >= 0
                    if hit.any():
                        here.append((length, rows[hit], found[hit]))
                go = found != -2
                if not go.any():
                    break
                rows, h = rows[go], h[go]
            yield here


LONG_WORD = 2000


def _long_log_probability(word: str, pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """The forward sum of one long word: matches of each length at all places at once, then one
    pass over the places that holds no more values than the longest piece has letters."""
    codes = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    n = len(codes)
    places, lengths, numbers = [], [], []
    at, h = np.arange(n), np.zeros(n, dtype=np.uint64)
    for length in range(1, min(pieces.longest, n) + 1):
        inside = at + length <= n
        at, h = at[inside], h[inside]
        h = h * _BASE + codes[at + length - 1]
        found = pieces.find(h)
        hit = found >= 0 if length > 1 else np.ones(len(at), dtype=bool)
        places.append(at[hit])
        lengths.append(np.full(int(hit.sum()), length))
        numbers.append(np.where(found[hit] >= 0, found[hit], len(pieces.pieces)))
        go = found != -2
        at, h = at[go], h[go]
        if not len(at):
            break
    order = np.argsort(np.concatenate(places), kind="stable")
    to = (np.concatenate(places) + np.concatenate(lengths))[order]
    weight = probs[np.concatenate(numbers)[order]]
    starts = np.searchsorted(np.concatenate(places)[order], np.arange(n + 1))
    ring = pieces.longest + 1
    alpha = np.zeros((ring, probs.shape[1]))
    alpha[0] = 1.0
    logs = np.zeros(probs.shape[1])
    first, ends = starts.tolist(), (to % ring).tolist()
    for i in range(n):
        here = alpha[i % ring].copy()
        alpha[i % ring] = 0.0
        if i % 8 == 0:
            alpha /= here
            logs += np.log(here)
            here = np.ones_like(here)
        for k in range(first[i], first[i + 1]):
            alpha[ends[k]] += here * weight[k]
    return logs + np.log(alpha[n % ring])


def _by_length(words: list[str]) -> dict[int, list[int]]:
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    return groups


def _codes(words: list[str]) -> np.ndarray:
    n = len(words[0])
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return flat.reshape(len(words), n).astype(np.uint64)


def word_log_probabilities(words: list[str], pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """Log probability of each word (with its mark) in each language: the sum
    over all segmentations. ``probs``: pieces and one more row, by languages."""
    n_lang = probs.shape[1]
    out = np.zeros((len(words), n_lang))
    for n, members in _by_length(words).items():
        if n > LONG_WORD:
            for i in members:
                out[i] = _long_log_probability(words[i], pieces, probs)
            continue
        # about 8 MB of forward values at a time
        step = max(1, (1 << 20) // ((n + pieces.longest + 1) * max(1, n_lang)))
        for k in range(0, len(members), step):
            some = members[k: k + step]
            out[some] = _forward(_codes([words[i] for i in some]), pieces, probs)
    return out


def _forward(codes: np.ndarray, pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    n_words, n = codes.shape
    alpha = np.zeros((n + 1, n_words, probs.shape[1]))
    alpha[0] = 1.0
    logs = np.zeros((n_words, probs.shape[1]))
    for i, here in enumerate(pieces.edges(codes)):
        if i and i % 8 == 0:  # keep the values in range, whatever the word's length
            scale = alpha[i].copy()
            alpha[i: i + pieces.longest + 1] /= scale
            logs += np.log(scale)
        for length, rows, found in here:
            alpha[i + length, rows] += alpha[i, rows] * probs[found]
    return logs + np.log(alpha[n])


def fit_language(words: list[str], counts: np.ndarray, pieces: Pieces, rounds: int = ROUNDS) -> np.ndarray:
    """Expected counts of the pieces in the last round of expectation-maximisation."""
    v = len(pieces.pieces) + 1
    groups = []
    for members in _by_length(words).values():
        codes = _codes([words[i] for i in members])
        groups.append((codes.shape, counts[members].astype(float), list(pieces.edges(codes))))
    p = np.full(v, 1.0 / v)
    expected = np.zeros(v)
    for _ in range(rounds):
        expected = np.zeros(v)
        for (n_words, n), weight, edges in groups:
            alpha = np.zeros((n + 1, n_words))
            beta = np.zeros((n + 1, n_words))
            alpha[0] = beta[n] = 1.0
            for i, here in enumerate(edges):
                for length, rows, found in here:
                    alpha[i + length, rows] += alpha[i, rows] * p[found]
            for i in range(n - 1, -1, -1):
                for length, rows, found in edges[i]:
                    beta[i, rows] += beta[i + length, rows] * p[found]
            total = weight / np.maximum(alpha[n], 1e-300)
            for i, here in enumerate(edges):
                for length, rows, found in here:
                    share = alpha[i, rows] * p[found] * beta[i + length, rows] * total[rows]
                    expected += np.bincount(found, weights=share, minlength=v)
        expected[v - 1] = 0.0
        p = np.maximum(expected / max(expected.sum(), 1e-300), FLOOR)
    return expected


class Model:
    """Languages, pieces and probabilities, as broadcast."""

    def __init__(self, languages: list[str], pieces: list[str], expected: np.ndarray):
        """``expected``: counts of pieces (and the row for others), by languages."""
        self.languages, self.names = languages, pieces
        if languages:
            share = expected / np.maximum(expected.sum(axis=0, keepdims=True), 1e-300)
            mixed = (1 - SMOOTHING) * share + SMOOTHING * share.mean(axis=1, keepdims=True)
            self.probs = np.maximum(mixed, FLOOR)
        else:
            self.probs = np.zeros((len(pieces) + 1, 0))
        self.token = uuid.uuid4().hex


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def training_words(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
                   sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``lang, word, n``: word counts of the sample of labelled rows."""
    spark = docs.sparkSession
    learn = docs.where(~held_out(F.col(id_col)) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = learn.groupBy(F.col(lang).alias("l")).count()
    drawn = F.xxhash64(F.col(id_col).cast("string"), F.lit(5), F.col(text).cast("string"))
    share = F.pmod(drawn, F.lit(1 << 20))
    limits = spark.createDataFrame(
        [(r["l"], min(1 << 20, -(-sample_docs * (1 << 20) // r["count"]))) for r in sizes.collect()],
        "__l string, __limit long")
    sample = learn.join(F.broadcast(limits), F.col(lang) == F.col("__l")).where(share < F.col("__limit"))
    # A row given many times is drawn many times or never: it is learned from once.
    rows = (sample.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("t"), drawn.alias("at"))
            .dropDuplicates(["lang", "at"]).select("lang", "t"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        pattern = regex.compile(WORDS)
        for whole in batches:
            for batch in slices(whole, PIECE_BYTES, "t"):
                found: Counter = Counter()
                for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    found.update((name, w[k: k + STRETCH]) for w in pattern.findall(t.lower()) for k in range(0, len(w), STRETCH))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in found], type=pa.string()), pa.array([k[1] for k in found], type=pa.string()),
                     pa.array(list(found.values()), type=pa.int64())], names=["lang", "word", "n"])

    counted = rows.mapInArrow(count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
          sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on the labelled rows of ``docs`` that aren't held out.

    The number of languages is that of the labels: a closed, small set.
    """
    words = written(training_words(docs, id_col, text, lang, sample_docs), "langid-words")
    letters = [r[0] for r in words.select(F.explode(F.split("word", "")).alias("c")).where("c != ''").distinct().collect()]
    names = sorted({*read_pieces(vocabulary), *letters, MARK})
    shared = docs.sparkSession.sparkContext.broadcast(names)

    def fit(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("word").to_pylist(), table.column("n").to_pylist(), strict=True))
        expected = fit_language([MARK + w for w, _ in rows], np.array([n for _, n in rows]), Pieces(shared.value))
        return pa.table({"lang": [table.column("lang")[0].as_py()], "expected": [expected.astype("<f8").tobytes()]})

    fitted = words.groupBy("lang").applyInArrow(fit, "lang string, expected binary").collect()
    fitted.sort(key=lambda r: r["lang"])
    expected = [np.frombuffer(bytes(r["expected"]), dtype="<f8") for r in fitted]
    return Model([r["lang"] for r in fitted], names,
                 np.stack(expected, axis=1) if expected else np.zeros((len(names) + 1, 0)))


class Scorer:
    """Log probabilities of white-space chunks, kept for those seen before."""

    def __init__(self, model: Model):
        import regex

        self.model = model
        self.pieces = Pieces(model.names)
        self.words = regex.compile(WORDS)
        self.limit = max(1000, min(CACHE_ENTRIES, (32 << 20) // (8 * max(1, len(model.languages)))))
        self.clear()

    def clear(self) -> None:
        self.places: dict[bytes, int] = {}
        self.table = np.zeros((1024, len(self.model.languages) + 1))

    def score(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """By text: log probability in each language, and whether it has a letter."""
        n_lang = len(self.model.languages)
        out = np.zeros((len(texts), n_lang + 1))
        if len(self.places) > self.limit:
            self.clear()
        split = [(t.lower() if t.isascii() else t.decode("utf-8", "replace").lower().encode()).split() if t else [] for t in texts]
        places = self.places
        new = {c for chunks in split for c in chunks if c not in places}
        if new:
            self._add(sorted(new))
        table = self.table
        for i, chunks in enumerate(split):
            if chunks:
                out[i] = table[[places[c] for c in chunks]].sum(axis=0)
        return out[:, :n_lang], out[:, n_lang] > 0

    def _add(self, chunks: list[bytes]) -> None:
        parts = [self.words.findall(c.decode("utf-8", "replace")) for c in chunks]
        distinct = sorted({w for p in parts for w in p})
        values = word_log_probabilities([MARK + w for w in distinct], self.pieces, self.model.probs)
        at = {w: k for k, w in enumerate(distinct)}
        start = len(self.places)
        need = start + len(chunks)
        if need > len(self.table):
            grown = np.zeros((max(need, 2 * len(self.table)), self.table.shape[1]))
            grown[:start] = self.table[:start]
            self.table = grown
        owner = np.repeat(np.arange(len(chunks)), [len(p) for p in parts])
        rows = np.array([at[w] for p in parts for w in p], dtype=np.int64)
        block = np.zeros((len(chunks), self.table.shape[1]))
        np.add.at(block[:, :-1], owner, values[rows])
        block[:, -1] = [len(p) for p in parts]
        self.table[start:need] = block
        self.places.update(zip(chunks, range(start, need), strict=True))


def _scorer(model: Model) -> Scorer:
    return held(("langid", model.token), lambda: Scorer(model))


def predict(df: DataFrame, model: Model, text: str = "text", lang_pred: str = "lang_pred", score: str = "score",
            keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with the predicted language and its posterior."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    base = with_replaced(df, lang_pred, score)
    kept = keep if keep is not None else base.columns
    names = [*kept] if text in kept else [*kept, text]
    place = names.index(text)
    src = df.select(*[F.col(f"`{c}`") for c in names])
    schema = T.StructType([*src.schema.fields[: len(kept)], T.StructField(lang_pred, T.StringType(), False),
                           T.StructField(score, T.DoubleType(), False)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared.value)
        languages = np.array([*scorer.model.languages, UNDETERMINED], dtype=object)
        for whole in batches:
            for batch in slices(whole, PIECE_BYTES, text):
                logs, letters = scorer.score(binary_values(batch.column(place)))
                if logs.shape[1]:
                    best = logs.argmax(axis=1)
                    top = 1.0 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                else:
                    best, top, letters = np.zeros(len(logs), dtype=int), np.zeros(len(logs)), np.zeros(len(logs), dtype=bool)
                best = np.where(letters, best, len(languages) - 1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[: len(kept)], pa.array(languages[best].tolist(), type=pa.string()),
                     pa.array(np.where(letters, top, 0.0))], names=[*kept, lang_pred, score])

    return src.mapInArrow(run, schema)
