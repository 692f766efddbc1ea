"""The operators' queries on the given tables and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsdesk.llm import (
    chaining, cotraining, decontaminate, language_id, language_model, line_dedup, maximal_repeats, merkle, mixing, near_dedup, quality_rules, sql, toxicity,
    whitening,
)
from newsdesk.llm.common import remainder
from newsdesk.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(build):
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return build

    return add


def _table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_template_decontamination")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every contaminated document with each class of items it holds."""
    return decontaminate.leaks(_table(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


@query("benchmark_classes")
def benchmark_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every item of the benchmark: the membership that op1's rows leave out."""
    return decontaminate.item_classes(_table(spark, sf_dir, "benchmark"))


@query("op2_raked_mixture", sql.MIXTURE)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raked weight, probability and decision of every document."""
    rows = mixing.weighted(_table(spark, sf_dir))
    return rows.select("doc_id", F.col("m_source").alias("source"), F.col("m_lang").alias("lang"), F.col("m_topic").alias("topic"), "n_tokens",
                       F.round("weight", 5).alias("weight"), F.round("probability", 5).alias("probability"), "kept")


@query("op3_cotrained_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from both views."""
    docs = _table(spark, sf_dir)
    model = cotraining.train(docs, _table(spark, sf_dir, "labels"))
    scored = cotraining.score(docs, model)
    held_out = remainder(F.col("doc_id"), cotraining.FOLDS) == cotraining.TEST_FOLD
    return scored.select("doc_id", held_out.alias("held_out"), "score", "content_score", "metadata_score", "kept")


@query("op4_circulant_minhash", sql.NEAR_DUPLICATES)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document by two-word shingles."""
    return near_dedup.classes(_table(spark, sf_dir), shingle_words=2).select("doc_id", "n_shingles", "component_id", "kept")


@query("op5_sentence_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document and its offending sentences."""
    docs = _table(spark, sf_dir)
    scored = toxicity.score(docs, *toxicity.train(docs, _table(spark, sf_dir, "labels")))
    held_out = remainder(F.col("doc_id"), toxicity.FOLDS) == toxicity.TEST_FOLD
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", F.col("offending.sentence").alias("sentences"))


@query("op6_deleted_interpolation")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model log probability of every document."""
    return language_model.score(_table(spark, sf_dir))


@query("op7_chained_passages")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuzzy passages of 50 words or more that documents share."""
    return chaining.passages(_table(spark, sf_dir))


@query("op8_line_windows", sql.LINE_WINDOWS)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated three-line windows."""
    rows = line_dedup.dedup_lines(_table(spark, sf_dir))
    return rows.select("doc_id", "n_removed_lines", F.length("text").cast("bigint").alias("n_chars_left"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("op9_maximal_repeats")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its 200-byte repeats."""
    return maximal_repeats.removal_digests(_table(spark, sf_dir))


@query("op10_rule_ledger", sql.RULE_LEDGER)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, failure bits and verdict of every document."""
    rows = quality_rules.ledger(_table(spark, sf_dir))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~quality_rules.passes("base")).alias("base_failed"),
                       quality_rules.passes().alias("kept"), "n_lines", "n_letter_words", "fail_mask")


@query("op11_merkle_witnesses", sql.MANIFEST)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Witness digest of every document, folded after a third of the documents was tampered with."""
    return merkle.verified(merkle.tampered(_table(spark, sf_dir)))


@query("op12_bit_sliced_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First whitened coordinates of every embedding."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


@query("op13_hyperdimensional_langid")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = _table(spark, sf_dir)
    held_out = remainder(F.col("doc_id"), language_id.FOLDS) == language_id.TEST_FOLD
    return language_id.identify(docs, *language_id.learn(docs)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("rule_ablations", sql.RULE_ABLATIONS)
def rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per policy and rule: what fails, and what only this rule rejects."""
    return quality_rules.ablations(quality_rules.ledger(_table(spark, sf_dir)))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
