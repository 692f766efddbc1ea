"""The corpus pipeline: quality rules, line dedup, near dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns the rows of `docs` it keeps; the next stage reads
what the one before it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsdesk.llm import decontaminate, line_dedup, mixing, near_dedup, quality_rules
from newsdesk.session import store, tune

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Template windows, components and raked weights have no practical SQL form; tests/llm holds brute-force versions.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of the quality rules accepts."""
    return quality_rules.select(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated three-line windows; documents left without a word go, n_chars is renewed."""
    rows = line_dedup.dedup_lines(docs)
    rows = rows.withColumn("n_chars", F.when(F.col("n_removed_lines") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return rows.filter((F.col("n_removed_lines") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word shingle similarity 0.8 or more."""
    return near_dedup.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the raked weights, with the weight and probability of each."""
    return mixing.weighted(docs).filter("kept").select(*docs.columns, "n_tokens", "weight", "probability")


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmark_leaks", benchmark_leaks), ("mix", mix)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    tune(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir))
    return docs
