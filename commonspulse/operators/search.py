"""Ranked repository search hits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commonspulse.session import scratch_dir


def _numbered(results: DataFrame) -> DataFrame:
    """Ranks of all results of every query, however many one query has.

    Results are dealt by range of (query, time, id) and written once; each range
    numbers its own rows and adds the rows that the query has in earlier ranges.
    """
    spark, path = results.sparkSession, scratch_dir(results.sparkSession, "search-ranges")
    order = [F.col("query"), F.col("o.updated_at").desc_nulls_last(), F.col("o.id")]
    dealt = results.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    dealt.write.parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)
    earlier = Window.partitionBy("query").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy("query", "part").agg(F.count("*").alias("n")).select(
        "query", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("query", "part").orderBy(*order[1:])
    numbered = dealt.withColumn("place", F.row_number().over(within)).withColumnRenamed("query", "asked").withColumnRenamed("part", "range")
    return numbered.join(before, F.col("asked").eqNullSafe(F.col("query")) & (F.col("range") == F.col("part"))).withColumn(
        "rank", (F.col("before") + F.col("place")).cast("int"))


def ranked_hits(results: DataFrame, limit: int | None = None) -> DataFrame:
    """The results of each query, the most recently updated first, ranked from 1.

    ``results`` has ``query``, ``observed_at``, the typed object ``o`` and its
    text ``object``.  ``limit`` is the caller's; none ranks all results.  With a
    limit Spark keeps so many per query in every task before the shuffle.
    """
    if limit is None:
        ranked = _numbered(results)
    else:
        newest = Window.partitionBy("query").orderBy(F.col("o.updated_at").desc_nulls_last(), F.col("o.id"))
        ranked = results.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= limit)
    return ranked.select(
        "query",
        F.col("o.id").alias("repo_id"),
        "rank",
        F.col("o.full_name").alias("full_name"),
        F.col("o.owner.login").alias("owner_login"),
        F.col("o.owner.type").alias("owner_type"),
        F.col("observed_at").alias("matched_at"),
        F.col("object").alias("raw"),
    )
