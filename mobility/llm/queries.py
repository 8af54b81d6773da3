"""Registered queries of the training-data operators, one per operator."""
from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mobility.llm import (
    bpe, chat, decontaminate, embedding_dedup, html_text, langid, line_dedup, periodic_runs, simhash, substring_dedup, token_files,
    url_filter, whitening,
)
from mobility.llm.common import table, written

ARROW_BYTES = str(8 << 20)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def register(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        # An Arrow batch is held whole, here and in the JVM, by every task.
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
        return fn(spark, sf_dir)

    REGISTRY[fn.__name__] = run
    return run


@register
def op1_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return bpe.digests(bpe.encode(docs, WORD_VOCABULARY, keep=["doc_id"], decoded="decoded"))


@register
def op2_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return line_dedup.dedup_lines(docs.select("doc_id", "text"))


ORACLES["op2_line_dedup"] = line_dedup.ORACLE


@register
def op3_chat(spark, sf_dir):
    """Transcripts of all conversations, parsed by a model of those not held out."""
    raw = written(chat.raw_transcripts(table(spark, sf_dir, "conversations")), "transcripts")
    model = chat.learn(raw.where(~langid.held_out(raw["conv_id"])))
    parsed = chat.format_conversations(raw, model)
    return parsed.select("conv_id", "part", "piece", "n_turns", F.array_join("roles", ",").alias("roles"), "chat")


@register
def op4_html_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    model = html_text.train(pages)
    return html_text.extract(pages, model, keep=["page_id", "url"])


@register
def op5_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs, PIECE_VOCABULARY)
    marked = docs.select("doc_id", langid.held_out(docs["doc_id"]).alias("held_out"), "text")
    return langid.predict(marked, model, keep=["doc_id", "held_out"])


@register
def op6_decontamination(spark, sf_dir):
    return decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op7_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op8_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@register
def op9_url_filter(spark, sf_dir):
    listed = spark.sql("SELECT explode(array(" + ", ".join(f"'{d}'" for d in url_filter.LISTED_DOMAINS) + ")) AS domain")
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.RULES, listed)


ORACLES["op9_url_filter"] = url_filter.ORACLE


@register
def op10_token_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    root = token_files.write_token_files(docs, WORD_VOCABULARY, end_id=1)
    return token_files.read_token_files(spark, root, docs)


@register
def op11_whitening(spark, sf_dir):
    return whitening.components(table(spark, sf_dir, "embeddings"))


@register
def op12_substring_dedup(spark, sf_dir):
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register
def op13_periodic_runs(spark, sf_dir):
    docs = periodic_runs.with_planted_runs(table(spark, sf_dir, "documents"))
    runs = periodic_runs.periodic_runs(docs)
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return runs.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "strongest.start", "strongest.length", "strongest.period",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
