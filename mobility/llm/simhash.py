"""SimHash near-duplicates with BK-trees.

Fingerprints. The words of a text (runs of bytes other than space and
``\\x09-\\x0D``, A-Z in lower case) form shingles of three, repeats included; a
text of fewer words is one shingle, a text without words has fingerprint zero.
Bit ``b`` of the fingerprint is 1 if it is set in over half of the shingles'
XXH64 hashes (seed 42).

Links. Fingerprints that differ in at most ``radius`` = 2 bits link. Equal
fingerprints are first folded into one row. Cut the 64 bits into four blocks:
two bits can spoil at most two of them, so linked fingerprints agree in at
least one of the six pairs of blocks. Each pair's 32 bits are a bucket, and
each bucket a shard with a BK-tree of its own: the children of a node are keyed
by their distance to it, and a search for a fingerprint at distance ``d`` of a node goes
down only the edges ``d - radius .. d + radius``. The shards' trees are sent where
the bucket's rows are and nowhere else: a broadcast of all trees would
grow with the corpus.

A bucket of more than ``bucket_rows`` fingerprints is cut again by the other 32
bits: four blocks of eight, of which linked fingerprints agree in at least two.
Such a shard shares 48 bits, so it holds at most 2**16 fingerprints whatever the
data. No bucket is capped and no pair of linked fingerprints is missed.

A shard gives at most one link per row (those that join two trees of links),
so dense groups don't emit their pairs. Components over all shards come from
alternating stars (``components.py``).

Defined cases: null text counts as text without words; rows of the same id are
one document with several fingerprints, which it links; rows with a null id get a
fingerprint but link with nothing (component null); an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobility.llm.common import binary_values, free_name, slices, written
from mobility.llm.components import connected_components

RADIUS = 2
SHINGLE = 3
#: Fingerprints of a bucket that go into one tree; larger buckets are cut again.
BUCKET_ROWS = 1024
PIECE_BYTES = 2 << 20

#: For each byte value its eight bits, most significant first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text in UTF-8."""
    import xxhash

    words = (text or b"").lower().split()  # of bytes: A-Z, and \x09-\x0D and space
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[a:b], 42) for a, b in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1:].tolist(), strict=True)],
                      dtype=">u8")
    n = len(hashes)
    columns = hashes.view(np.uint8).reshape(n, 8)
    ones = np.concatenate([np.bincount(columns[:, k], minlength=256) @ _BITS for k in range(8)])
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def with_fingerprints(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` of every row; ``fp`` is the fingerprint as a signed long."""
    src = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("t"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, PIECE_BYTES, "t"):
                fps = [_signed(fingerprint(t, shingle)) for t in binary_values(batch.column(1))]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, type=pa.int64())], names=["doc_id", "fp"])

    return src.mapInArrow(run, "doc_id long, fp long")


class BKTree:
    """Fingerprints by distance: ``children[node][distance]`` is a node."""

    def __init__(self, radius: int):
        self.radius = radius
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def within(self, value: int) -> list[int]:
        """Nodes at most ``radius`` bits away."""
        found, radius = [], self.radius
        stack = [0] if self.values else []
        while stack:
            node = stack.pop()
            d = (self.values[node] ^ value).bit_count()
            if d <= radius:
                found.append(node)
            below = self.children[node]
            if len(below) <= 2 * radius + 1:
                stack.extend([c for k, c in below.items() if -radius <= k - d <= radius])
            else:
                for k in range(d - radius, d + radius + 1):
                    if (c := below.get(k)) is not None:
                        stack.append(c)
        return found

    def add(self, value: int) -> int:
        """The new node of a value that isn't in the tree yet."""
        new = len(self.values)
        self.values.append(value)
        self.children.append({})
        if new:
            node = 0
            while True:
                d = (self.values[node] ^ value).bit_count()
                below = self.children[node].get(d)
                if below is None:
                    self.children[node][d] = new
                    break
                node = below
        return new


def shard_links(values: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links (places in ``values``, which are distinct) that connect whatever
    links within the radius connect; fewer than ``values``."""
    tree = BKTree(radius)
    parent = list(range(len(values)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, value in enumerate(values):
        for j in tree.within(value):
            a, b = root(i), root(j)
            if a != b:
                parent[a] = b
                out.append((i, j))
        tree.add(value)
    return out


def _block_keys(fp: F.Column, width: int, within: F.Column | None = None) -> F.Column:
    """Array of the six bucket keys of four blocks of ``width`` bits: (pair, bits)."""
    mask = F.lit((1 << width) - 1).cast("long")

    def block(i: int) -> F.Column:
        return F.shiftrightunsigned(fp, i * width).bitwiseAND(mask)

    keys = [F.struct(F.lit(p).cast("int").alias("p"),
                     F.shiftleft(block(i), width).bitwiseOR(block(j)).alias("bits"))
            for p, (i, j) in enumerate(combinations(range(4), 2))]
    return F.array(*keys)


def _rest(fp: F.Column, pair: F.Column) -> F.Column:
    """The 32 bits of ``fp`` that a bucket's pair of blocks leaves out, as a long."""
    out = None
    for p, used in enumerate(combinations(range(4), 2)):
        i, j = (k for k in range(4) if k not in used)
        mask = F.lit(0xFFFF).cast("long")
        bits = F.shiftleft(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(mask), 16).bitwiseOR(
            F.shiftrightunsigned(fp, 16 * j).bitwiseAND(mask))
        out = F.when(pair == p, bits) if out is None else out.when(pair == p, bits)
    return out


def _links_of(rows: DataFrame, radius: int) -> DataFrame:
    """Links within the shards of ``rows`` (key columns, ``rep``, ``fp``)."""
    keys = [c for c in rows.columns if c not in ("rep", "fp")]
    placed = rows.repartition(*keys).sortWithinPartitions(*keys, "rep")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, reps, fps = None, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            links = shard_links(fps, radius) if len(fps) > 1 else []
            if links:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([reps[i] for i, _ in links], type=pa.int64()),
                     pa.array([reps[j] for _, j in links], type=pa.int64())], names=["a", "b"])

        for batch in batches:
            n = len(keys)
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns, strict=True):
                if row[:n] != held:
                    yield from flush()
                    held, reps, fps = row[:n], [], []
                reps.append(row[n])
                fps.append(row[n + 1] & 0xFFFFFFFFFFFFFFFF)
        yield from flush()

    return placed.mapInArrow(run, "a long, b long")


def fingerprint_links(reps: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links ``(a, b)`` between the ``rep`` of distinct fingerprints ``fp``."""
    if not 0 <= radius <= 2:
        raise ValueError("four blocks find every link only up to two bits")
    rows = (reps.select("rep", "fp", F.explode(_block_keys(F.col("fp"), 16)).alias("k"))
            .select("k.p", "k.bits", "rep", "fp"))
    # Only keys that several fingerprints share, with their number; far fewer than rows.
    shared = written(rows.groupBy("p", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-buckets")
    small = rows.join(shared.where(F.col("n") <= bucket_rows).drop("n"), ["p", "bits"]).select("p", "bits", "rep", "fp")
    large = rows.join(shared.where(F.col("n") > bucket_rows).drop("n"), ["p", "bits"])
    cut = (large.select("p", "bits", "rep", "fp", F.explode(_block_keys(_rest(F.col("fp"), F.col("p")), 8)).alias("k"))
           .select("p", "bits", F.col("k.p").alias("p2"), F.col("k.bits").alias("bits2"), "rep", "fp"))
    return _links_of(small, radius).union(_links_of(cut, radius))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    prints = written(with_fingerprints(df, id_col, text, shingle), "simhash-prints")
    known = prints.where("doc_id is not null")
    reps = written(known.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-reps")
    links = fingerprint_links(reps.select("rep", "fp"), radius, bucket_rows)
    # Fingerprints that share a document (rows of one id) have one of its ids as
    # rep only by chance; tie them through that document.
    several = (known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"))
    tied = (known.join(several, "doc_id").join(reps, "fp")
            .select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).where("a <> b"))
    classes = connected_components(links.union(tied))
    by_fp = (reps.join(classes, reps["rep"] == classes["node"], "left")
             .select("fp", F.coalesce("component", "rep").alias("component_id")))
    return prints.join(by_fp, "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                radius: int = RADIUS) -> DataFrame:
    """The rows of ``df`` whose id is the least of its component, one per id (of
    rows with that id, the least in its columns' order); rows without an id stay."""
    classes = near_duplicates(df, id_col, text, shingle, radius)
    stays = classes.where("doc_id = component_id").select(F.col("doc_id").alias("__keep")).distinct()
    columns = [F.col(f"`{c}`") for c in df.columns]
    held = df.join(stays, F.col(f"`{id_col}`") == F.col("__keep"), "left_semi")
    row = free_name(df, "row")
    one = held.groupBy(F.col(f"`{id_col}`").alias("__id")).agg(F.min(F.struct(*columns)).alias(row)).select(f"{row}.*")
    return one.unionByName(df.where(F.col(f"`{id_col}`").isNull()))
