"""Snapshot values as they stood strictly before a cutoff.

For many (repository, cutoff) pairs at once, without pairing facts with cutoffs:
snapshots and pairs lie in one ordered stream, cut into ranges of time, and each
pair takes the last snapshot before it in its own range.  Where that range has
none, it takes what the earlier ranges end with, one row per repository and
range.  So a repository with very many snapshots is many small groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SNAPSHOT_VALUES = ("stargazers_count", "forks_count")


def snapshots_before(snapshots: DataFrame, pairs: DataFrame, values: Sequence[str] = SNAPSHOT_VALUES,
                     grain: str = "day") -> DataFrame:
    """``pairs`` with the values of the last snapshot strictly before ``cutoff``, and its time as ``snapshot_at``.

    Every pair is kept, repeated ones too.  Without an earlier snapshot, and for
    a null repository or cutoff, the values are null.  Of several snapshots at
    one time the greatest row counts, compared in the order of ``values``.
    ``grain`` is the length of the ranges; take "hour" where one repository has
    very many snapshots a day.
    """
    found = F.struct(F.col("observed_at").alias("snapshot_at"), *values).alias("found")
    no_pair = F.lit(None).cast(pairs.select(F.struct(*pairs.columns)).schema[0].dataType).alias("pair")
    dated = snapshots.where(F.col("repo_id").isNotNull() & F.col("observed_at").isNotNull()).select(
        F.col("repo_id").alias("repo"), F.col("observed_at").alias("moment"), found, no_pair)
    asked = pairs.select(
        F.col("repo_id").alias("repo"), F.col("cutoff").alias("moment"),
        F.lit(None).cast(dated.schema["found"].dataType).alias("found"), F.struct(*pairs.columns).alias("pair"))
    stream = dated.unionByName(asked).withColumn("range", F.date_trunc(grain, "moment"))

    # At equal times the pair comes first: only what is strictly earlier counts.
    order = Window.partitionBy("repo", "range").orderBy("moment", F.col("pair").isNull(), "found")
    within = stream.withColumn("own", _last("found", order)).where(F.col("pair").isNotNull())

    ranges = stream.groupBy("repo", "range").agg(F.max("found").alias("end"))
    carried = ranges.select(
        F.col("repo").alias("_repo"), F.col("range").alias("_range"),
        _last("end", Window.partitionBy("repo").orderBy("range")).alias("carried"))
    same = (F.col("repo") == F.col("_repo")) & (F.col("range") == F.col("_range"))
    settled = within.join(carried, same, "left").select("pair", F.coalesce("own", "carried").alias("found"))
    return settled.select("pair.*", *[f"found.{c}" for c in ("snapshot_at", *values)])


def _last(column: str, order: WindowSpec) -> Column:
    return F.last(column, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
