"""Benchmark decontamination by greedy string tiling.

Tokens are white-space chunks in lower case without the marks at their ends, so case and
punctuation don't hide a copy. Seeds are ``least`` = 3 tokens in a row (items of fewer tokens: the whole
item). Every tile consists of shared seeds, so the places of an item that shared seeds cover are at
least as many as its tiles'; only items that reach the needed coverage by this bound are tiled, which loses
none. Then their longest common runs of tokens are marked as tiles, again and again,
each token in one tile only and no tile under ``least`` tokens; the
matches are found by running Karp-Rabin hashes, of long runs first. Tiles may
come in any order, so reordered passages count in full. A document is
contaminated by an item if its tiles cover at least 0.8 of the item's tokens.

The benchmark goes to the tasks in blocks of at most about ``block_bytes`` of text,
by a hash of the item, one pass over the documents per block: what is broadcast is
bounded however large the benchmark is (a single item is not cut). Documents are never moved.

Defined cases: null and empty texts, and texts without letters or digits,
match nothing, as documents and as items; rows with null ids are compared like others; repeated
documents give repeated rows; repeated items count once per id and text; an empty
table on either side gives no rows (and removes none).
"""
from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobility.llm.common import binary_values, held, slices

LEAST = 3
COVERAGE = 0.8
#: Search length that the tiling starts from; runs over twice as long raise it.
FIRST_LENGTH = 24
BLOCK_BYTES = 4 << 20
PIECE_BYTES = 2 << 20
CACHE_ENTRIES = 120_000
_PRIME = (1 << 61) - 1
_RADIX = 1_000_003
NO_TOKEN, OTHER = -2, -1


def normal(chunk: bytes) -> str:
    """A chunk as a token: lower case, from its first to its last letter or digit."""
    s = chunk.decode("utf-8", "replace").lower()
    a, b = 0, len(s)
    while a < b and not s[a].isalnum():
        a += 1
    while a < b and not s[b - 1].isalnum():
        b -= 1
    return s[a:b]


def _runs(tokens: list[int], free: list[bool], least: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the stretches of free known tokens."""
    start = None
    for i, (t, f) in enumerate(zip(tokens, free, strict=True)):
        if f and t >= 0:
            if start is None:
                start = i
        elif start is not None:
            if i - start >= least:
                yield start, i
            start = None
    if start is not None and len(tokens) - start >= least:
        yield start, len(tokens)


def _hashes(tokens: list[int], start: int, end: int, s: int) -> Iterator[tuple[int, int]]:
    """(place, hash) of the runs of ``s`` tokens in a stretch, each from the one before."""
    top = pow(_RADIX, s - 1, _PRIME)
    h = 0
    for i in range(start, end):
        if i - start >= s:
            h = (h - (tokens[i - s] + 1) * top) % _PRIME
        h = (h * _RADIX + tokens[i] + 1) % _PRIME
        if i - start >= s - 1:
            yield i - s + 1, h


def _scan(p: list[int], t: list[int], free_p: list[bool], free_t: list[bool], s: int) -> tuple[int, list[tuple[int, int, int]]]:
    """Matches of at least ``s`` free tokens, as long as they go, and the longest length."""
    table: dict[int, list[int]] = {}
    for a, b in _runs(p, free_p, s):
        for i, h in _hashes(p, a, b, s):
            table.setdefault(h, []).append(i)
    found, longest = [], 0
    if not table:
        return 0, found
    for a, b in _runs(t, free_t, s):
        for j, h in _hashes(t, a, b, s):
            for i in table.get(h, ()):
                if i and j > a and free_p[i - 1] and p[i - 1] == t[j - 1]:
                    continue  # part of the match that begins one token earlier
                n = 0
                while i + n < len(p) and j + n < b and free_p[i + n] and p[i + n] == t[j + n]:
                    n += 1
                if n >= s:
                    found.append((n, i, j))
                    longest = max(longest, n)
    return longest, found


def _free_parts(free_p: list[bool], free_t: list[bool], i: int, j: int, n: int) -> list[tuple[int, int, int]]:
    """What other tiles have left of a match."""
    out, k = [], 0
    while k < n:
        start = k
        while k < n and free_p[i + k] and free_t[j + k]:
            k += 1
        if k > start:
            out.append((i + start, j + start, k - start))
        k += 1
    return out


def tiles(p: list[int], t: list[int], least: int = LEAST, first: int = FIRST_LENGTH) -> list[tuple[int, int, int]]:
    """Greedy string tiling of ``p`` by ``t``: (place in p, place in t, tokens).

    Negative tokens match nothing.
    """
    free_p, free_t = [True] * len(p), [True] * len(t)
    out: list[tuple[int, int, int]] = []
    s = max(least, min(first, len(p), len(t)))
    while True:
        longest, found = _scan(p, t, free_p, free_t, s)
        if longest > 2 * s:
            s = longest
            continue
        # the longest first; of equal ones the first in p, then in t
        queue = [(-n, i, j) for n, i, j in found]
        heapify(queue)
        while queue:
            n, i, j = heappop(queue)
            rest = _free_parts(free_p, free_t, i, j, -n)
            if rest == [(i, j, -n)]:
                free_p[i: i - n] = [False] * -n
                free_t[j: j - n] = [False] * -n
                out.append(rest[0])
            else:
                for i, j, n in rest:
                    if n >= s:
                        heappush(queue, (-n, i, j))
        if s <= least:
            return out
        s = max(least, s // 2)


class Matcher:
    """The items of one block, ready to be looked for in texts."""

    def __init__(self, items: list[tuple[int | None, str]], least: int, coverage: float):
        self.least, self.coverage = least, coverage
        self.vocabulary: dict[str, int] = {}
        self.ids, self.tokens = [], []
        for item_id, text in items:
            words = [w for w in map(normal, (text or "").encode().split()) if w]
            if words:
                self.ids.append(item_id)
                self.tokens.append([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words])
        self.sizes = np.array([len(t) for t in self.tokens], dtype=np.int64)
        starts = np.cumsum(self.sizes) - self.sizes
        self.owners = np.repeat(np.arange(len(self.tokens)), self.sizes)  # of the items' tokens one after the other
        by_length: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for start, tokens in zip(starts.tolist(), self.tokens, strict=True):
            m = min(least, len(tokens))
            places, hashes = self._seeds(np.array(tokens, dtype=np.int64), m)
            by_length.setdefault(m, []).append((hashes, places + start))
        self.seeds = {}
        for m, parts in by_length.items():
            hashes, places = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(hashes, kind="stable")
            distinct, first, count = np.unique(hashes[order], return_index=True, return_counts=True)
            self.seeds[m] = (distinct, first, count, places[order])
        self.cache: dict[bytes, int] = {}

    @staticmethod
    def _seeds(tokens: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``m`` known tokens in a row, and their hashes."""
        n = len(tokens) - m + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        known = tokens >= 0
        ok = known[:n].copy()
        for j in range(1, m):
            ok &= known[j: j + n]
        places = np.flatnonzero(ok)
        h = np.zeros(len(places), dtype=np.uint64)
        for j in range(m):
            h = h * np.uint64(0x9E3779B97F4A7C15) + (tokens[places + j] + 1).astype(np.uint64)
        return places, h

    def _token(self, chunk: bytes) -> int:
        word = normal(chunk)
        got = self.vocabulary.get(word, OTHER) if word else NO_TOKEN
        if len(self.cache) < CACHE_ENTRIES and len(chunk) <= 64:
            self.cache[chunk] = got
        return got

    def _candidates(self, at: np.ndarray) -> list[int]:
        """The items of which shared seeds cover enough places."""
        covered = []
        for m, (hashes, first, count, places) in self.seeds.items():
            _, found = self._seeds(at, m)
            if not found.size:
                continue
            found = np.unique(found)
            i = np.searchsorted(hashes, found)
            i = i[hashes[np.minimum(i, len(hashes) - 1)] == found]
            n = count[i]
            shared = places[np.repeat(first[i] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            covered.extend(shared + j for j in range(m))
        if not covered:
            return []
        reached = np.bincount(self.owners[np.unique(np.concatenate(covered))], minlength=len(self.sizes))
        return np.flatnonzero((reached > 0) & (reached >= self.coverage * self.sizes)).tolist()

    def overlaps(self, text: bytes | None) -> list[tuple[int, int, int]]:
        """(item's number, covered tokens, tiles) of the items that the text covers enough."""
        chunks = text.split() if text else []
        get, token = self.cache.get, self._token
        ids = [got if (got := get(c)) is not None else token(c) for c in chunks]
        at = np.array(ids, dtype=np.int64)
        at = at[at != NO_TOKEN]
        out = []
        for k in self._candidates(at):
            p = self.tokens[k]
            t = np.where(np.isin(at, p), at, OTHER)
            if len(set(p) & set(t.tolist())) == 0:
                continue
            got = tiles(p, _close_up(t), min(self.least, len(p)))
            covered = sum(n for _, _, n in got)
            if covered >= self.coverage * len(p):
                out.append((k, covered, len(got)))
        return out


def _close_up(t: np.ndarray) -> list[int]:
    """``t`` with each stretch of other tokens as one: nothing matches across it."""
    other = t < 0
    again = np.zeros(len(t), dtype=bool)
    again[1:] = other[1:] & other[:-1]
    return t[~again].tolist()


def blocks(benchmark: DataFrame, id_col: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The distinct items in blocks of about ``block_bytes`` of text at most."""
    items = (benchmark.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("t"))
             .where("t is not null").distinct())
    size = items.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    n = -(-size // block_bytes)
    for b in range(n):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64("id", "t"), F.lit(n)) == b).orderBy("id", "t").collect()]


def contaminations(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
                   item_id: str = "item_id", item_text: str = "text", least: int = LEAST,
                   coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row per contaminated document and item: ``doc_id, item_id, item_tokens,
    covered_tokens, coverage, n_tiles``. Clean documents give none."""
    src = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("t"))
    schema = "doc_id long, item_id long, item_tokens long, covered_tokens long, coverage double, n_tiles long"
    out = df.sparkSession.createDataFrame([], schema)
    for items in blocks(benchmark, item_id, item_text, block_bytes):
        out = out.union(src.mapInArrow(_finder(df, items, least, coverage), schema))
    return out


def _finder(df: DataFrame, items: list[tuple], least: int, coverage: float):
    shared, token = df.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = held(token, lambda: Matcher(shared.value, least, coverage))
        for whole in batches:
            for batch in slices(whole, PIECE_BYTES, "t"):
                rows = []
                for doc_id, t in zip(batch.column(0).to_pylist(), binary_values(batch.column(1)), strict=True):
                    for k, covered, n in matcher.overlaps(t):
                        size = len(matcher.tokens[k])
                        rows.append({"doc_id": doc_id, "item_id": matcher.ids[k], "item_tokens": size,
                                     "covered_tokens": covered, "coverage": covered / size, "n_tiles": n})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_PAIRS)

    return run


_PAIRS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_tokens", pa.int64()),
                    ("covered_tokens", pa.int64()), ("coverage", pa.float64()), ("n_tiles", pa.int64())])


def without_contaminated(df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                         item_text: str = "text", least: int = LEAST, coverage: float = COVERAGE,
                         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``df`` that no item contaminates, in one pass per block."""
    place = df.columns.index(text)
    out = df
    for items in blocks(benchmark, item_id, item_text, block_bytes):
        shared, token = df.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

        def run(batches: Iterable[pa.RecordBatch], shared=shared, token=token) -> Iterator[pa.RecordBatch]:
            matcher = held(token, lambda: Matcher(shared.value, least, coverage))
            for whole in batches:
                for batch in slices(whole, PIECE_BYTES, text):
                    clean = [not matcher.overlaps(t) for t in binary_values(batch.column(place))]
                    yield batch.filter(pa.array(clean, type=pa.bool_()))

        out = out.mapInArrow(run, df.schema)
    return out
