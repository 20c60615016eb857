"""From raw documents to encoded training text: five stages, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commonspulse.llm import bpe, contamination, language, lines, near_duplicates
from commonspulse.llm.common import read, saved

MIN_SCORE = 0.3  # of the predicted language; four languages give the best one 0.25 at least
NEAR_WORDS, NEAR_SHARE = 5, (80, 100)  # of the near_dedup stage; op5 has its own


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: null texts, texts without letters, no language above ``MIN_SCORE``."""
    kept = language.labelled(docs, language.fit(docs)).filter((F.col("lang_pred") != language.UNDEFINED) & (F.col("score") >= MIN_SCORE))
    return kept.select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove lines that repeat an earlier one; documents that have no word left go."""
    kept = lines.dedup(docs, equal_words=1)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of near duplicates: ``NEAR_SHARE`` of their shingles of ``NEAR_WORDS`` words."""
    return near_duplicates.keep_first(docs, NEAR_SHARE, NEAR_WORDS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold benchmark items."""
    return contamination.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text that is left, with digests of ids and decoded bytes."""
    return bpe.digests(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("encode", encode),
]
ORACLE_SQL = None  # a trained model and a tokenizer are beyond SQL; the tests hold each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
