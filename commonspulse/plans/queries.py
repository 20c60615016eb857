"""Read-only SQL over named DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from commonspulse import constants as C
from commonspulse.plans.exports import write_csv
from commonspulse.sources.tables import register_views


def ensure_read_only(sql: str) -> None:
    """Refuse text that does not start like a query or holds a mutating word.

    The test is on text: a word inside a literal is refused too.
    """
    words = sql.lower().split()
    if not " ".join(words).startswith(C.READ_ONLY_PREFIXES):
        raise ValueError("The text does not begin like a query")
    found = set(words) & set(C.MUTATING_WORDS)
    if found:
        raise ValueError(f"These words change data and are refused: {sorted(found)}")


def run_query(spark: SparkSession, sql: str, views: Mapping[str, DataFrame]) -> DataFrame:
    ensure_read_only(sql)
    register_views(views)
    return spark.sql(sql)


def query_to_csv(spark: SparkSession, sql: str, views: Mapping[str, DataFrame], path: str) -> None:
    write_csv(run_query(spark, sql, views), path)
