"""The corpus pipeline: five stages over ``documents``, each calling one operator.

Every stage but the last returns the columns of ``documents``. Between stages the
documents are written as Parquet in the session's shared folder and read again, so
no stage depends on the ones before it when executors are lost.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mobility.llm import bpe, decontaminate, langid, line_dedup, simhash
from mobility.llm.common import free_name, table, written
from mobility.llm.queries import PIECE_VOCABULARY, WORD_VOCABULARY, register

#: Language ID rejects texts without a language and those whose best language
#: is no likelier than all others together.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language stay as they are; those that language ID rejects go."""
    model = langid.learn(docs, PIECE_VOCABULARY)
    pred, score = free_name(docs, "lang_pred"), free_name(docs, "score")
    marked = langid.predict(docs, model, lang_pred=pred, score=score)
    return marked.where((F.col(pred) != langid.UNDETERMINED) & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the windows seen earlier in the corpus; documents that lose every line go."""
    removed, left = free_name(docs, "n_removed"), free_name(docs, "n_left")
    out = line_dedup.dedup_lines(docs, removed=removed, left=left)
    stays = out.where((F.col(removed) == 0) | (F.trim(F.regexp_replace("text", "\n", " ")) != ""))
    return stays.withColumn(
        "n_chars", F.when(F.col(removed) == 0, F.col("n_chars")).otherwise(F.length("text").cast("long"))
    ).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and decode every document that is left."""
    return bpe.digests(bpe.encode(docs, WORD_VOCABULARY, keep=["doc_id"], decoded="decoded"))


STAGES = [
    ("language id", language_id),
    ("line dedup", line_deduplication),
    ("simhash near-dedup", near_duplicates),
    ("decontamination", decontamination),
    ("bpe encoding and decoding", encoding),
]

#: None: SQL has no form of the language model, XXH64 fingerprints and BPE ids.
#: tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


run = register(pipeline)
