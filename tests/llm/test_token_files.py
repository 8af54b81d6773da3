import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from mobility.llm import token_files as tf

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_perfect_hash_gives_every_key_a_slot_of_its_own():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(-(1 << 63), (1 << 63) - 1, n, dtype=np.int64))
        mph = tf.PerfectHash.build(keys)
        assert sorted(mph.slots(keys).tolist()) == list(range(len(keys)))
        again = tf.PerfectHash(mph.sizes, mph.bits)
        assert (again.slots(keys) == mph.slots(keys)).all()


def test_files_hold_every_document_in_order(spark, tmp_path):
    rows = [(5, "The end."), (2, None), (9, ""), (2, "again"), (None, "no id"), (7, "x " * 5000), (5, "The end.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    root = tf.write_token_files(df, PATH, end_id=1)
    got = sorted(map(tuple, tf.read_token_files(spark, root, df).collect()), key=lambda r: r[1])
    library, start, want = Tokenizer.from_file(PATH), 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((key, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert got == want
    missing = spark.createDataFrame([(4,), (2,)], "doc_id long")
    assert [r.doc_id for r in tf.read_token_files(spark, root, missing).collect()] == [2, 2]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, start long")
    root = tf.write_token_files(df, PATH, end_id=1)
    assert tf.read_token_files(spark, root, df).count() == 0


def test_library_ids_with_chunks_kept():
    enc = tf.LibraryEncoder(tf.read_vocabulary(PATH))
    library = Tokenizer.from_file(PATH)
    for text in ["It's ÉTÉ, <|endoftext|>x", "á J̌ Σς 日本 12½", "\x1c a\xa0b c", "the the THE"]:
        for _ in range(2):
            got = np.frombuffer(enc.encode(text.encode()), dtype=enc.dtype).tolist()
            assert got == library.encode(text, add_special_tokens=False).ids


def test_a_key_on_a_third_of_the_rows_lies_in_several_shards(spark):
    rows = [(7 if i % 3 == 0 else i, f"text {i} of the table, {'again ' * (i % 5)}") for i in range(3000)] + [(7, "text 3 of the table, ")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as many shards as shuffle partitions
    try:
        root = tf.write_token_files(df, PATH, end_id=1)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    holding = spark.read.parquet(f"{root}/manifest").where("first_key <= 7 and last_key >= 7")
    assert holding.count() > 1
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in tf.read_token_files(spark, root, df).collect())
    library = Tokenizer.from_file(PATH)
    ids = [(k, [*library.encode(t, add_special_tokens=False).ids, 1]) for k, t in rows]
    assert len(got) == len(rows) and [g[1] for g in got] == sorted(k for k, _ in rows)
    assert sorted((g[1], g[2], g[3]) for g in got) == sorted(
        (k, len(i), zlib.crc32(np.array(i, dtype="<u4").tobytes())) for k, i in ids)
    starts = np.cumsum([0] + [g[2] for g in got])[:-1].tolist()
    assert [g[0] for g in got] == starts


def test_roots_without_a_scheme_follow_the_session(spark):
    assert tf._uri(spark, "/some/folder") == "file:///some/folder"
    assert tf._uri(spark, "file:///a/b") == "file:///a/b"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    old = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "nowhere://x/")
    try:
        with pytest.raises(Exception, match="nowhere"):  # it is asked for, and not silently passed over
            tf._uri(spark, "/some/folder")
    finally:
        conf.set("fs.defaultFS", old)


def test_tables_that_turn_over_change_no_ids(monkeypatch):
    monkeypatch.setattr(tf, "CACHE_ENTRIES", 5)
    enc = tf.LibraryEncoder(tf.read_vocabulary(PATH))
    library = Tokenizer.from_file(PATH)
    texts = [" ".join(f"word{(i * j) % 17} Plain{j}" for j in range(30)) for i in range(20)] + ["", None, "x" * 3000, "É" * 200]
    for _ in range(2):
        ids, counts = enc.encode_all([None if t is None else t.encode() for t in texts])
        want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [x for w in want for x in w]
    assert len(enc.chunks.new) <= 5 and len(enc.chunks.old) <= 5
