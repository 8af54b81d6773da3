import re
from pathlib import Path

import corpus_pipeline as cp
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tests.llm.brute import components, dedup_lines, simhash
from tokenizers import Tokenizer

import __spark_entry__ as entry
from mobility.llm import bpe, decontaminate, langid, queries
from mobility.llm.common import table
from tests.conftest import SF_SMALL

ROOT = Path(__file__).resolve().parents[2]


def test_stages_against_brute_force(spark):
    """Each stage on its own input; the whole run ends at the same documents."""
    docs = table(spark, SF_SMALL, "documents")
    extra = spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "12 34", "de", "s", 5), (10**6 + 2, "12 34", None, None, None)], docs.schema)
    docs = docs.unionByName(extra)
    columns, steps = docs.columns, dict(cp.STAGES)
    rows = {r.doc_id: r for r in docs.collect()}

    first = steps["language id"](spark, docs, SF_SMALL)
    assert first.columns == columns
    kept = {r.doc_id: r for r in first.collect()}
    assert set(rows) - set(kept) == {10**6, 10**6 + 1, 10**6 + 2}
    assert all(kept[k] == rows[k] for k in kept)

    second = steps["line dedup"](spark, first, SF_SMALL)
    want = {k: t for k, t in dedup_lines([(r.doc_id, r.text) for r in kept.values()]).items() if t.strip()}
    got = {r.doc_id: r for r in second.collect()}
    assert second.columns == columns and {k: r.text for k, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())

    third = steps["simhash near-dedup"](spark, second, SF_SMALL)
    prints = {k: simhash(r.text) for k, r in got.items()}
    classes = components(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2])
    singles = {r.doc_id: r for r in third.collect()}
    assert third.columns == columns and set(singles) == set(classes.values()) and third.count() == len(singles)
    assert all(singles[k] == got[k] for k in singles)

    fourth = steps["decontamination"](spark, third, SF_SMALL)
    items = [" ".join(filter(None, (decontaminate.normal(w.encode()) for w in r.text.split())))
             for r in table(spark, SF_SMALL, "benchmark").collect()]
    clean = {r.doc_id for r in fourth.collect()}
    plain = {k: " ".join(filter(None, (decontaminate.normal(w.encode()) for w in r.text.split()))) for k, r in singles.items()}
    assert all(not any(f" {i} " in f" {plain[k]} " for i in items) for k in clean)
    words = {k: set(t.split()) for k, t in plain.items()}
    gone = set(singles) - clean
    assert gone and all(any(len(words[k] & set(i.split())) >= 0.8 * len(set(i.split())) for i in items) for k in gone)

    last = steps["bpe encoding and decoding"](spark, fourth, SF_SMALL).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert {r.doc_id for r in last} == clean
    assert all(r.n_tokens == len(library.encode(singles[r.doc_id].text, add_special_tokens=False).ids) for r in last)


def test_run_equals_the_stages_one_by_one(spark):
    docs = table(spark, SF_SMALL, "documents")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert sorted(cp.run(spark, SF_SMALL).collect()) == sorted(docs.collect())


def test_stages_take_empty_tables_and_extra_columns(spark):
    docs = table(spark, SF_SMALL, "documents").withColumn("score", F.lit("s")).withColumn("n_removed", F.lit(1))
    for name, stage in cp.STAGES:
        out = stage(spark, docs.limit(0), SF_SMALL)
        assert out.count() == 0
        if name != cp.STAGES[-1][0]:
            assert out.columns == docs.columns


def test_every_operator_is_registered():
    numbers = sorted(int(m[1]) for q in entry.queries() if (m := re.match(r"op(\d+)_", q)))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()
    assert len(cp.STAGES) == 5 and set(queries.ORACLES) == {"op2_line_dedup", "op9_url_filter"}


def test_nothing_else_imports_the_subpackage_and_no_local_checkpoints():
    for p in (ROOT / "mobility").rglob("*.py"):
        text = p.read_text()
        assert "localCheckpoint" not in text and "toPandas" not in text
        if "llm" not in p.parts:
            assert "mobility.llm" not in text


def test_worker_objects_are_replaced():
    from mobility.llm.common import held

    a = held("a", lambda: np.zeros(1))
    assert held("a", lambda: None) is a
    assert held("b", lambda: 5) == 5 and held("a", lambda: 6) == 6
    assert bpe.CACHE_ENTRIES > 0 and langid.CACHE_ENTRIES > 0
