"""Token ids as binary shards with a minimal perfect hash index.

Files, below one root in shared storage:

- ``<shard>.bin``: the raw ids of the shard's documents in ascending key order,
  little-endian, 16 bits each if the vocabulary has at most 65,536 ids, else 32.
- ``<shard>.idx``: NumPy arrays (``np.savez``): the minimal perfect hash
  (``bits`` and ``sizes`` of its levels), and by slot ``prints`` (a 32-bit
  fingerprint of the key), ``first`` and ``count`` (the key's rows), and
  ``starts`` (each row's first id in the payload, and the end).
- ``manifest/``: Parquet, a row per shard: files, first and last key, rows, ids.

A key is hashed to a bit of the first level; keys alone on their bit own it,
the rest go on to the next level. The number of set bits before a key's bit is
its slot: one array access a level, no key stored. The fingerprint tells absent
keys apart (but for one in 2**32).

Rows are range-partitioned and sorted by key, then by the text's first characters and its
hash, so the whole order is ascending and a key of many rows lies in as many shards as it fills. A lookup goes to
every shard whose range holds the key, in a task of that shard, and a shard's rows leave it in batches. Each task writes files of a name of
its own and reports them in its manifest row; only rows of successful attempts
reach the manifest, so files of lost or repeated tasks are never read.

Defined cases: null text counts as empty; the end id follows every document,
also an empty one; a very long text is encoded whole; rows that repeat a key lie side by side in order of
their text's first characters and all belong to the key; a null key is kept
as the least key; an empty table gives an empty manifest. Other columns, whatever their names, are
not stored.
"""
from __future__ import annotations

import io
import json
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mobility.llm.bpe import BEYOND_LATIN1, byte_alphabet, read_vocabulary
from mobility.llm.common import binary_values, held, slices
from mobility.llm.words import Words
from mobility.session import shared_path

#: Entries of one generation of a worker's tables of chunks and words; it bounds memory and changes no result.
CACHE_ENTRIES = 300_000
#: Marks that stand alone after a word's letters.
ENDINGS = (b".", b",", b";", b":", b"!", b"?")
#: Bytes of texts that are encoded in one piece: its different chunks are looked up once.
ENCODED_BYTES = 4 << 20
#: First characters by which rows of one key are ordered.
PREFIX = 32
#: Rows that a lookup hands on at once.
READ_ROWS = 4096
#: Stands for a null key.
NULL_KEY = -(1 << 63)
#: Bits per key of a level of the hash.
GAMMA = 2.0
MANIFEST = ("shard string, dtype string, first_key long, first_text string, first_hash long, last_key long, "
            "n_rows long, n_ids long")


class Generations:
    """A table of two generations: when the new one is full it becomes the old one, and what
    isn't asked for in the meantime goes with the old one before."""

    def __init__(self, entries: int):
        self.entries = entries
        self.new: dict = {}
        self.old: dict = {}

    def get(self, key):
        got = self.new.get(key)
        if got is None and (got := self.old.get(key)) is not None:
            self.put(key, got)
        return got

    def put(self, key, value) -> None:
        if len(self.new) >= self.entries:
            self.old, self.new = self.new, {}
        self.new[key] = value


class LibraryEncoder:
    """The tokenizers library, with bounded tables of the chunks and words seen lately.

    White space cuts a text into chunks that the library encodes one by one,
    whatever surrounds them; the different chunks of a piece of texts are encoded once.
    """

    def __init__(self, spec: str):
        import regex
        from tokenizers import Tokenizer

        doc = json.loads(spec)
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.words = regex.compile(doc["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.marks = {t["content"].encode()[:2] for t in doc["added_tokens"]}
        self.alphabet = byte_alphabet()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(True) <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.chunks = Generations(CACHE_ENTRIES // 2)
        self.words_seen = Generations(CACHE_ENTRIES)
        self.endings = {m: self._chunk(m) for m in ENDINGS}

    def _word(self, word: str) -> bytes:
        mapped = "".join([self.alphabet[b] for b in word.encode()])
        got = array(self.code, [t.id for t in self.model.tokenize(mapped)]).tobytes()
        if len(word) <= 64:
            self.words_seen.put(word, got)
        return got

    def _letters(self, word: bytes) -> bytes:
        """The ids of a word of letters of ASCII, which the pattern leaves whole."""
        word = word.lower()
        got = self.words_seen.get(word)
        if got is None:
            got = array(self.code, [t.id for t in self.model.tokenize(word.decode())]).tobytes()
            if len(word) <= 64:
                self.words_seen.put(word, got)
        return got

    def _any(self, chunk: bytes) -> bytes:
        """The ids of a chunk: most are a word, or a word and one mark."""
        if chunk.isalpha():
            return self._letters(chunk)
        last = chunk[-1:]
        if last in self.endings and chunk[:-1].isalpha():
            return self._letters(chunk[:-1]) + self.endings[last]
        got = self.chunks.get(chunk)
        return self._chunk(chunk) if got is None else got

    def _chunk(self, chunk: bytes) -> bytes:
        if not BEYOND_LATIN1.search(chunk) and not any(m in chunk for m in self.marks):
            # up to U+00FF nothing composes, and lower case is one character for one
            text = chunk.decode().lower()
            get, word = self.words_seen.get, self._word
            got = b"".join([get(w) or word(w) for w in self.words.findall(text)])
        else:
            ids = self.tokenizer.encode(chunk.decode("utf-8", "replace"), add_special_tokens=False).ids
            got = np.array(ids, dtype=self.dtype).tobytes()
        if len(chunk) <= 64:
            self.chunks.put(chunk, got)
        return got

    def encode_all(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts in this encoder's dtype, one after the other; the number of each text's)"""
        plain = [t.lower() if t and not BEYOND_LATIN1.search(t) and not any(m in t for m in self.marks) else t for t in texts]
        words = Words(plain)
        chunks, code = words.distinct()
        found = [self._any(c) for c in chunks]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // self.dtype.itemsize
        pool = np.frombuffer(b"".join(found), dtype=self.dtype)
        counts = sizes[code]
        # each chunk's ids lie side by side in the pool; word by word they are copied from there
        shift = (np.cumsum(sizes) - sizes)[code] - (np.cumsum(counts) - counts)
        ids = pool[np.arange(int(counts.sum())) + np.repeat(shift, counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])[words.first]
        return ids, np.diff(ends)

    def encode(self, text: bytes | None) -> bytes:
        """The ids of a text in this encoder's dtype."""
        return self.encode_all([text])[0].tobytes()


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of each 64-bit key."""
    x = keys.astype(np.int64).view(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Distinct 64-bit keys to 0..n-1, each to a slot of its own."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        flags = np.unpackbits(bits)[: int(self.offsets[-1])].astype(bool)
        self.flags = flags
        self.ranks = np.cumsum(flags) - flags

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, flags, rest = [], [], keys
        while rest.size:
            m = max(64, int(GAMMA * rest.size))
            at = (_mix(rest, len(sizes)) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            sizes.append(m)
            flags.append(alone)
            rest = rest[~alone[at]]
        joined = np.concatenate(flags) if flags else np.zeros(0, dtype=bool)
        return cls(np.array(sizes, dtype=np.int64), np.packbits(joined))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Each key's slot; -1 for keys that are certainly absent."""
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for level, m in enumerate(self.sizes.tolist()):
            if not open_.size:
                break
            at = self.offsets[level] + (_mix(keys[open_], level) % np.uint64(m)).astype(np.int64)
            hit = self.flags[at]
            out[open_[hit]] = self.ranks[at[hit]]
            open_ = open_[~hit]
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


def index_bytes(keys: np.ndarray, starts: np.ndarray) -> bytes:
    """The index file of rows with ascending ``keys`` (repeats side by side)."""
    distinct, first, count = np.unique(keys, return_index=True, return_counts=True)
    mph = PerfectHash.build(distinct)
    slots = mph.slots(distinct)
    arrays = {"prints": fingerprints(distinct), "first": first.astype(np.uint32), "count": count.astype(np.uint32)}
    by_slot = {}
    for name, values in arrays.items():
        by_slot[name] = np.zeros_like(values)
        by_slot[name][slots] = values
    out = io.BytesIO()
    np.savez(out, sizes=mph.sizes, bits=mph.bits, starts=starts.astype(np.uint64), **by_slot)
    return out.getvalue()


class ShardReader:
    """Keyed access to one shard's payload."""

    def __init__(self, root: str, shard: str, dtype: str):
        self.fs, base = pafs.FileSystem.from_uri(root)
        with self.fs.open_input_file(f"{base}/{shard}.idx") as f:
            arrays = np.load(io.BytesIO(f.read()))
            self.mph = PerfectHash(arrays["sizes"], arrays["bits"])
            self.prints, self.first, self.count = arrays["prints"], arrays["first"], arrays["count"]
            self.starts = arrays["starts"].astype(np.int64)
        self.payload = self.fs.open_input_file(f"{base}/{shard}.bin")
        self.dtype = np.dtype(dtype)

    def rows(self, keys: np.ndarray) -> list[tuple[int, int]]:
        """(first row, rows) of each key; rows is 0 for an absent key."""
        slots = self.mph.slots(keys)
        safe = np.maximum(slots, 0)
        if not len(self.prints):
            return [(0, 0)] * len(keys)
        there = (slots >= 0) & (self.prints[safe] == fingerprints(keys))
        return list(zip(self.first[safe].tolist(), np.where(there, self.count[safe], 0).tolist(), strict=True))

    def ids(self, row: int) -> np.ndarray:
        """The ids of one row, from one read at its offset."""
        start, end = int(self.starts[row]), int(self.starts[row + 1])
        size = self.dtype.itemsize
        raw = self.payload.read_at((end - start) * size, start * size)
        return np.frombuffer(raw, dtype=self.dtype)

    def close(self) -> None:
        self.payload.close()


def _encoder(spec: str) -> LibraryEncoder:
    return held(("library", hash(spec)), lambda: LibraryEncoder(spec))


def _uri(spark: SparkSession, path: str) -> str:
    """The path on the file system that the session's settings give it, whatever they are."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    full = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return "file://" + full[len("file:"):] if full.startswith("file:/") and not full.startswith("file://") else full


def write_token_files(df: DataFrame, vocabulary: str, end_id: int, key: str = "doc_id", text: str = "text") -> str:
    """Encode ``text`` and write the shards, index files and manifest; returns their root."""
    spark = df.sparkSession
    root = _uri(spark, shared_path(spark, "mobility-llm", f"tokens-{uuid.uuid4().hex}"))
    spec = spark.sparkContext.broadcast(read_vocabulary(vocabulary))
    t = F.col(f"`{text}`").cast("string")
    order = ["k", "p", "h"]
    rows = (df.select(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NULL_KEY)).alias("k"),
                      F.left(F.coalesce(t, F.lit("")), F.lit(PREFIX)).alias("p"), F.xxhash64(t).alias("h"), t.alias("t"))
            .repartitionByRange(*order).sortWithinPartitions(*order, "t"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, first = None, None
        keys, lengths = [], []
        for whole in batches:
            if not whole.num_rows:
                continue
            if encoder is None:
                encoder = _encoder(spec.value)
                first = [whole.column(c)[0].as_py() for c in range(3)]
                fs, base = pafs.FileSystem.from_uri(root)
                fs.create_dir(base, recursive=True)
                shard = uuid.uuid4().hex
                payload = fs.open_output_stream(f"{base}/{shard}.bin")
            for batch in slices(whole, ENCODED_BYTES, "t"):
                ids, counts = encoder.encode_all(binary_values(batch.column(3)))
                payload.write(np.insert(ids, np.cumsum(counts), end_id).tobytes())
                keys.append(batch.column(0).to_numpy())
                lengths.append(counts + 1)
        if encoder is None:
            return
        payload.close()
        all_keys = np.concatenate(keys)
        starts = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
        with fs.open_output_stream(f"{base}/{shard}.idx") as f:
            f.write(index_bytes(all_keys, starts))
        yield pa.RecordBatch.from_pydict({
            "shard": [shard], "dtype": [encoder.dtype.str], "first_key": [first[0]], "first_text": [first[1]],
            "first_hash": [first[2]], "last_key": [int(all_keys[-1])], "n_rows": [len(all_keys)], "n_ids": [int(starts[-1])]})

    rows.mapInArrow(run, MANIFEST).write.parquet(f"{root}/manifest")
    return root


def read_token_files(spark: SparkSession, root: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, start, n_tokens, ids_crc32`` of every stored row of the given keys.

    Keys are looked up through the index files. ``start`` counts the ids of all
    rows before, over all shards. Keys that aren't stored give no row.
    """
    # One small row a shard, as many as the write had tasks.
    manifest = spark.read.schema(MANIFEST).parquet(f"{root}/manifest").orderBy("first_key", "first_text", "first_hash").collect()
    firsts, lasts = (np.array([m[c] for m in manifest], dtype=np.int64) for c in ("first_key", "last_key"))
    bases = np.concatenate([[0], np.cumsum([m["n_ids"] for m in manifest])]).astype(np.int64)
    shards = [(m["shard"], m["dtype"]) for m in manifest]
    wanted = keys.select(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NULL_KEY)).alias("k")).distinct()

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each key with every shard whose range holds it."""
        for batch in batches:
            k = batch.column(0).to_numpy()
            low, high = np.searchsorted(lasts, k, side="left"), np.searchsorted(firsts, k, side="right")
            count = np.maximum(high - low, 0)
            s = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
            yield pa.RecordBatch.from_arrays([pa.array(s.astype(np.int32)), pa.array(np.repeat(k, count))], names=["s", "k"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, held = None, -1
        for batch in batches:
            place, all_keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            out: list[tuple[int | None, int, int, int]] = []
            for s in np.unique(place).tolist():
                if s != held:
                    if reader is not None:
                        reader.close()
                    reader, held = ShardReader(root, *shards[s]), s
                mine = all_keys[place == s]
                for k, (first, count) in zip(mine.tolist(), reader.rows(mine), strict=True):
                    for row in range(first, first + count):
                        ids = reader.ids(row)
                        out.append((None if k == NULL_KEY else k, int(bases[s] + reader.starts[row]), len(ids),
                                    zlib.crc32(ids.astype("<u4").tobytes())))
                        if len(out) >= READ_ROWS:
                            yield results(out)
                            out = []
            if out:
                yield results(out)
        if reader is not None:
            reader.close()

    def results(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*out, strict=True)],
                                          names=[key, "start", "n_tokens", "ids_crc32"])

    placed = wanted.mapInArrow(place, "s int, k long").repartitionByRange("s", "k").sortWithinPartitions("s", "k")
    return placed.mapInArrow(run, f"`{key}` long, start long, n_tokens long, ids_crc32 long")
