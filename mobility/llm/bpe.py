"""BPE encoding by backtracking, and decoding from an offset table.

The vocabulary is a ``tokenizers`` JSON file of the kind with word ends (lower
case, white space dropped); its path is a parameter and its text is broadcast
(a file of a few MB that doesn't grow with the data).

Encoding. White space and special tokens cut a text into chunks that the merges
never cross. A chunk is normalised, cut into words by the file's pattern, and
each word is encoded by backtracking: an Aho-Corasick automaton gives the
longest token at every position; a token is taken if it and the one before
it are compatible, that is, if the merges would leave exactly these two
side by side; else the next shorter token at that place is tried, and a place
from which nothing fits is never tried again. Every position is left at most
once per token length, so the time is linear in the word's length, and the
result is that of applying the merges in order.

Decoding takes each id's string from a table of offsets into one blob, and
joins them as the library does for a file without a decoder: by one space.

Defined cases: null text encodes and decodes like an empty one (no ids, ``""``);
ids outside the vocabulary decode to nothing, as in the library; null
ids decode to ``""``; repeated rows give repeated rows; other columns pass
through, and a column named like an output gives way to it.
"""
from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mobility.llm.common import binary_values, held, slices, with_replaced

#: Entries that a worker's word and chunk tables hold at most; later new words
#: are encoded each time they come. It bounds memory and changes no result.
CACHE_ENTRIES = 150_000
#: Bytes of text that are encoded in one piece of an Arrow batch, or a row at least.
PIECE_BYTES = 2 << 20


#: Lead bytes in UTF-8 of the characters beyond U+00FF. Up to there nothing composes.
BEYOND_LATIN1 = re.compile(rb"[\xc4-\xff]")
#: All Unicode versions agree on the characters below.
AGREED = "\u0530"


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in printable}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(printable))
    return [out[b] for b in range(256)]


class BacktrackingEncoder:
    """Exact merges of one vocabulary, word by word."""

    #: A word's last byte is a symbol of its own: its character moved up here.
    END = 0x10000

    def __init__(self, spec: str):
        import ahocorasick
        import regex
        from tokenizers import Tokenizer

        doc = json.loads(spec)
        model = doc["model"]
        self.suffix = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in doc["added_tokens"]}
        self.strings = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for s, i in [*vocab.items(), *self.special.items()]:
            self.strings[i] = s
        self.alphabet = byte_alphabet()
        pattern = doc["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern)
        self.library = Tokenizer.from_str(spec)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.special_mark = {s.encode()[:2] for s in self.special}
        # How each token came to be: the two it was merged from, and that merge's place.
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[tuple[int, int], int] = {}
        self.made_by: dict[int, int] = {}
        for place, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, both = vocab[left], vocab[right], vocab[left + right]
            self.rank[a, b] = place
            if both not in self.parts:
                self.parts[both], self.made_by[both] = (a, b), place
        self.automaton = ahocorasick.Automaton()
        self.by_symbols: dict[str, int] = {}
        for s, i in vocab.items():
            symbols = self.symbols(s)
            self.by_symbols[symbols] = i
            self.automaton.add_word(symbols, (len(symbols), i))
        self.automaton.make_automaton()
        self.length = {i: len(s) for s, i in self.by_symbols.items()}
        # The longest proper prefix of each token that is itself a token.
        self.shorter: dict[int, int] = {}
        for s, i in self.by_symbols.items():
            for n in range(len(s) - 1, 0, -1):
                if (j := self.by_symbols.get(s[:n])) is not None:
                    self.shorter[i] = j
                    break
        self.compatible_pairs: dict[tuple[int, int], bool] = {}
        self.chunks: dict[bytes, bytes] = {}
        self.cached_words: dict[str, bytes] = {}
        self.decoder: OffsetTable | None = None

    def offset_table(self) -> OffsetTable:
        if self.decoder is None:
            self.decoder = OffsetTable(self.strings)
        return self.decoder

    def symbols(self, token: str) -> str:
        """A vocabulary string as one character a symbol."""
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            body = token[: -len(self.suffix)]
            return body[:-1] + chr(ord(body[-1]) + self.END)
        return token

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left right`` as these two tokens.

        Undo the merges of both sides from the last one backwards. If the two
        that then touch at the border have a merge of their own that comes
        before the merges that used each of them, it would have come first. Of
        merges at one place the left one comes first: the border's before one
        to its right, after one to its left.
        """
        key = (left, right)
        known = self.compatible_pairs.get(key)
        if known is not None:
            return known
        a, b, ok = left, right, True
        never = len(self.rank)
        a_used = b_used = never  # the place of the merge that used up a, b
        while True:
            here = self.rank.get((a, b), never)
            if here < a_used and here <= b_used and here < never:
                ok = False
                break
            made_a, made_b = self.made_by.get(a, -1), self.made_by.get(b, -1)
            if made_a < 0 and made_b < 0:
                break
            if made_b >= made_a:
                b_used, b = made_b, self.parts[b][0]
            else:
                a_used, a = made_a, self.parts[a][1]
        if len(self.compatible_pairs) < CACHE_ENTRIES:
            self.compatible_pairs[key] = ok
        return ok

    def encode_word(self, word: str) -> list[int]:
        """The ids of one word of the pattern."""
        return self.encode_mapped("".join([self.alphabet[b] for b in word.encode()]))

    def encode_mapped(self, word: str) -> list[int]:
        """The ids of a word given as one character of the alphabet per byte."""
        s = word
        if self.suffix:
            s = s[:-1] + chr(ord(s[-1]) + self.END)
        whole = self.by_symbols.get(s)
        n = len(s)
        longest: list[int] = [-1] * n
        size = [0] * n
        for end, (length, token) in self.automaton.iter(s):
            start = end + 1 - length
            if length > size[start]:
                size[start], longest[start] = length, token
        if whole is not None and longest[0] == whole and whole not in self.parts:
            return [whole]
        dead = [False] * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        lengths, shorter, compatible = self.length, self.shorter, self.compatible
        while at < n:
            if token < 0:
                # nothing fits from here: step back and try a shorter token there
                dead[at] = True
                if not out:
                    raise ValueError(f"the vocabulary has no tokens for {word!r}")
                last = out.pop()
                at -= lengths[last]
                token = shorter.get(last, -1)
                continue
            end = at + lengths[token]
            if not dead[end] and (not out or compatible(out[-1], token)):
                out.append(token)
                at = end
                token = longest[at] if at < n else -1
            else:
                token = shorter.get(token, -1)
        return out

    def _word_bytes(self, word: str) -> bytes:
        got = self.cached_words.get(word)
        if got is None:
            got = np.asarray(self.encode_word(word), dtype=np.int32).tobytes()
            if len(self.cached_words) < CACHE_ENTRIES and len(word) <= 64:
                self.cached_words[word] = got
        return got

    def _plain(self, text: str) -> bytes:
        """Text without special tokens: normalise, cut into words, encode.

        What is a letter differs between Unicode versions only further up; there
        the library's own normaliser and word pattern decide.
        """
        if max(text) >= AGREED:
            cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return b"".join([np.asarray(self.encode_mapped(w), dtype=np.int32).tobytes() for w, _ in cut])
        text = unicodedata.normalize("NFC", text)
        text = "".join([c.lower() for c in text]) if not text.isascii() else text.lower()
        return b"".join([self._word_bytes(w) for w in self.words.findall(text)])

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8", "replace")
        if self.specials is None or not any(m in chunk for m in self.special_mark):
            got = self._plain(text)
        else:
            got = b"".join([
                np.int32(self.special[p]).tobytes() if p in self.special else self._plain(p)
                for p in self.specials.split(text) if p])
        if len(self.chunks) < CACHE_ENTRIES and len(chunk) <= 64:
            self.chunks[chunk] = got
        return got

    def encode_bytes(self, text: bytes | None) -> bytes:
        """The ids of one text as little-endian 32-bit integers."""
        if not text:
            return b""
        if not BEYOND_LATIN1.search(text) and not any(m in text for m in self.special_mark):
            text = text.lower()  # A-Z, as the normaliser does, so that more chunks are alike
        get, chunk = self.chunks.get, self._chunk
        return b"".join([get(c) or chunk(c) for c in text.split()])


class OffsetTable:
    """Decoding: one blob with all strings, and where each id's begins."""

    def __init__(self, strings: list[str]):
        self.n = len(strings)
        raw = [s.encode() + b" " if s else b"" for s in strings] + [b""]
        self.offsets = np.zeros(len(raw) + 1, dtype=np.int32)
        np.cumsum([len(r) for r in raw], out=self.offsets[1:])
        self.table = pa.Array.from_buffers(
            pa.binary(), len(raw), [None, pa.py_buffer(self.offsets), pa.py_buffer(b"".join(raw))])

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The texts of rows ``ids[bounds[k]:bounds[k + 1]]``."""
        safe = np.where((ids < 0) | (ids >= self.n), self.n, ids)
        taken = self.table.take(pa.array(safe, type=pa.int32()))
        ends = np.frombuffer(taken.buffers()[1], dtype=np.int32)[taken.offset: taken.offset + len(taken) + 1]
        data = taken.buffers()[2]
        data = data.to_pybytes() if data is not None else b""
        at = ends[bounds]
        return [data[a:b - 1] if b > a else b"" for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _encoder(spec: str) -> BacktrackingEncoder:
    return held(("bpe", hash(spec)), lambda: BacktrackingEncoder(spec))


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(df: DataFrame, vocabulary: str, text: str = "text", out: str = "ids", keep: list[str] | None = None,
           decoded: str | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with the ids of ``text`` as array<int>, and,
    where ``decoded`` names a column, with the text that the ids decode to: a
    round trip in one pass, by one Python worker a task.

    ``vocabulary`` is the path of the JSON file on the driver.
    """
    spec = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    outputs = [out] if decoded is None else [out, decoded]
    taken = {o.lower() for o in outputs}
    kept = [c for c in (keep if keep is not None else df.columns) if c.lower() not in taken]
    # the text travels under a name of its own, also when it isn't kept
    src = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("__text"))
    schema = T.StructType([*src.schema.fields[:-1], T.StructField(out, T.ArrayType(T.IntegerType(), False), False)])
    if decoded is not None:
        schema = schema.add(decoded, T.StringType(), False)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(spec.value)
        for whole in batches:
            for batch in slices(whole, PIECE_BYTES, "__text"):
                rows = [encoder.encode_bytes(t) for t in binary_values(batch.column(len(kept)))]
                offsets = np.zeros(len(rows) + 1, dtype=np.int32)
                np.cumsum([len(r) // 4 for r in rows], out=offsets[1:])
                ids = np.frombuffer(b"".join(rows), dtype=np.int32)
                made = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))]
                if decoded is not None:
                    made.append(pa.array(encoder.offset_table().decode(ids, offsets), type=pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *made], names=[*kept, *outputs])

    return src.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of the ids in column ``ids``."""
    spec = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    src = with_replaced(df, out)
    place = src.columns.index(ids)
    schema = T.StructType([*src.schema.fields, T.StructField(out, T.StringType(), False)])
    names = [*src.columns, out]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = OffsetTable(_strings(spec.value))
        for whole in batches:
            for batch in id_slices(whole, place, PIECE_BYTES // 4):
                col = batch.column(place)
                lengths = pc.list_value_length(col).fill_null(0).to_numpy(zero_copy_only=False)
                bounds = np.zeros(len(lengths) + 1, dtype=np.int64)
                np.cumsum(lengths, out=bounds[1:])
                flat = col.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                texts = table.decode(flat, bounds)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(texts, type=pa.binary()).cast(pa.string())], names=names)

    return src.mapInArrow(run, schema)


def id_slices(batch: pa.RecordBatch, place: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a piece holds about ``limit`` ids, or one row."""
    lengths = pc.list_value_length(batch.column(place)).fill_null(0).to_pylist()
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def _strings(spec: str) -> list[str]:
    doc = json.loads(spec)
    pairs = [*doc["model"]["vocab"].items(), *((t["content"], t["id"]) for t in doc["added_tokens"])]
    out = [""] * (max(i for _, i in pairs) + 1)
    for s, i in pairs:
        out[i] = s
    return out


def digests(df: DataFrame, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of an encoded and decoded table."""
    return df.select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col(ids).cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"))
