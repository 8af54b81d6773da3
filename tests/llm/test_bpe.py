import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from mobility.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = bpe.BacktrackingEncoder(bpe.read_vocabulary(PATH))
ODD = ["a", "É", "ß", "İ", "ı", "Σ", "ς", "ǰ", "J̌", "́", "é", "日本", "한", "ﬁ", "²", "½", "٣", "'s", "'LL", "12",
       " ", "\t", "\n", "\x1c", "\x85", "\xa0", " ", "😀", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "the", "ing"]


def _ids(text):
    return np.frombuffer(ENCODER.encode_bytes(text.encode()), dtype=np.int32).tolist()


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(ODD), max_size=20).map("".join),
                 st.text("abeinrst", max_size=60), st.integers(1, 80).map(lambda n: "a" * n)))
def test_ids_and_text_equal_the_library(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert _ids(text) == want
    table = bpe.OffsetTable(ENCODER.strings)
    got = table.decode(np.array(want, dtype=np.int64), np.array([0, len(want)]))[0].decode()
    assert got == LIBRARY.decode(want, skip_special_tokens=False)


def test_results_do_not_depend_on_the_tables_of_words_seen(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    small = bpe.BacktrackingEncoder(bpe.read_vocabulary(PATH))
    rng = random.Random(4)
    text = " ".join("".join(rng.choices("aeinorst", k=rng.randint(1, 12))) for _ in range(400))
    assert small.encode_bytes(text.encode()) == ENCODER.encode_bytes(text.encode())


def test_table_round_trip_and_defined_cases(spark):
    rows = [(1, "That it.", "x"), (1, "That it.", "x"), (None, None, "y"), (3, "", None), (4, "word " * 30_000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS string")
    got = bpe.decode(bpe.encode(df, PATH), PATH)
    assert got.columns == ["doc_id", "text", "ids", "decoded"]  # the clashing column gave way
    for r in got.collect():
        want = LIBRARY.encode(r.text or "", add_special_tokens=False).ids
        assert list(r.ids) == want and r.decoded == LIBRARY.decode(want, skip_special_tokens=False)
    assert got.count() == 5
    both = bpe.encode(df.withColumn("DECODED", df["text"]), PATH, decoded="decoded")
    assert both.columns == got.columns and sorted(map(str, both.collect())) == sorted(map(str, got.collect()))
    assert bpe.decode(bpe.encode(df.limit(0), PATH), PATH).count() == 0


@pytest.mark.parametrize("ids", [None, [], [-1, 682, 10**6]])
def test_ids_outside_the_vocabulary_decode_to_nothing(spark, ids):
    df = spark.createDataFrame([(ids,)], "ids array<int>")
    assert bpe.decode(df, PATH).first().decoded == ("that</w>" if ids else "")
