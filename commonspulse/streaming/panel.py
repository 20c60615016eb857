"""Incremental monthly panel.

Distinct counts cannot be kept up to date from a stream alone.  What the panel
counts of each event of the batch is stored by month, and the months it touches
are computed again from the stored rows, which replaces exactly those month partitions of the panel.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commonspulse import constants as C
from commonspulse.operators.filters import login_panel_types, with_org_login
from commonspulse.operators.panels import login_panel_of_rows, login_panel_rows
from commonspulse.session import whole_files


def panel_batch(root: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps ``root/panel`` equal to the panel of all events so far."""
    events_root, panel_root = os.path.join(root, "events"), os.path.join(root, "panel")

    def run(events: DataFrame, batch: int) -> None:
        spark = events.sparkSession
        rows = login_panel_rows(events).withColumn("event_month", F.date_format("month", "yyyyMM").cast("int"))
        with whole_files(spark):
            (
                rows.hint("rebalance", F.col("event_month"))
                .write.mode("overwrite").partitionBy("event_month")
                .parquet(os.path.join(events_root, f"batch={batch}"))
            )
        stored = spark.read.schema(rows.withColumn("batch", F.lit(batch).cast("bigint")).schema).parquet(events_root)
        # At most one value per calendar month.
        touched = [r[0] for r in stored.where(F.col("batch") == batch).select("event_month").distinct().collect()]
        if not touched:
            return
        upto = stored.where(F.col("event_month").isin(touched) & (F.col("batch") <= batch))
        (
            login_panel_of_rows(upto).write.mode("overwrite").partitionBy("month")
            .option("partitionOverwriteMode", "dynamic").parquet(panel_root)
        )

    return run


SLOTS = {"active_repositories": "repo_id", "distinct_actors": "actor_id"}


def delta_batch(root: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that only adds: counts of the batch, and the ids it sees first.

    ``root/ids`` holds each (organization, month, slot, id) once, by month.  An id that no earlier batch has brought to
    its organization and month adds one to that distinct count, so every count of the panel is a sum over batches.  A
    batch reads the ids of its own months only, writes folders of its own, and touches no other group.
    """
    ids_root, counts_root = os.path.join(root, "ids"), os.path.join(root, "counts")
    keys = ["org_login", "month", "slot", "id"]

    def run(events: DataFrame, batch: int) -> None:
        spark = events.sparkSession
        rows = login_panel_rows(events).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            brought = rows.select(
                "org_login", "month",
                F.inline(F.array(*[F.struct(F.lit(name).alias("slot"), F.col(field).alias("id")) for name, field in SLOTS.items()])),
            ).where("id is not null and month is not null").distinct()
            months = [r[0] for r in rows.select("month").where("month is not null").distinct().collect()]  # one value a calendar month
            known = spark.read.schema(_IDS).parquet(ids_root).where(F.col("month").isin(months) & (F.col("batch") < batch)) if months else None
            fresh = brought if known is None else brought.join(known.select(*keys), keys, "left_anti")
            # By month, or every task would write a file for each month.
            fresh.withColumn("batch", F.lit(batch)).hint("rebalance", F.col("month")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month", "batch").parquet(ids_root)
            mine = spark.read.schema(_IDS).parquet(ids_root)
            mine = mine.where(F.col("month").isin(months) & (F.col("batch") == batch)) if months else mine.limit(0)
            new = mine.groupBy("org_login", "month").agg(*[F.count_if(F.col("slot") == name).alias(f"new_{name}") for name in SLOTS])
            # A null month has no ids above; its groups keep the counts that add up.
            counts = login_panel_of_rows(rows).join(new, ["org_login", "month"], "left").select(
                "org_login", "month", *[F.coalesce(F.col(f"new_{m}"), F.lit(0)).alias(m) if m in SLOTS else m for m in C.LOGIN_PANEL_METRICS])
            counts.write.mode("overwrite").parquet(os.path.join(counts_root, f"batch={batch}"))
        finally:
            rows.unpersist()

    return run


_IDS = "org_login string, slot string, id bigint, month date, batch int"
_COUNTS = ", ".join(["org_login string", "month date", *[f"{m} bigint" for m in C.LOGIN_PANEL_METRICS], "batch int"])


def create_deltas(spark: SparkSession, root: str) -> None:
    spark.createDataFrame([], _IDS).write.mode("ignore").partitionBy("month", "batch").parquet(os.path.join(root, "ids"))
    spark.createDataFrame([], _COUNTS).write.mode("ignore").partitionBy("batch").parquet(os.path.join(root, "counts"))


def summed_panel(spark: SparkSession, root: str) -> DataFrame:
    """The panel of all batches so far: sums of their counts."""
    rows = spark.read.schema(_COUNTS).parquet(os.path.join(root, "counts"))
    return rows.groupBy("org_login", "month").agg(*[F.sum(m).alias(m) for m in C.LOGIN_PANEL_METRICS])


def read_panel(spark: SparkSession, root: str) -> DataFrame:
    metrics = ", ".join(f"{m} bigint" for m in C.LOGIN_PANEL_METRICS)
    return spark.read.schema(f"org_login string, {metrics}, month date").parquet(os.path.join(root, "panel"))


def additive_counts(events: DataFrame) -> DataFrame:
    """Streaming aggregate of the panel counts that add up, in update or complete mode."""
    rows = with_org_login(login_panel_types(events))
    return rows.groupBy(
        F.lower("org.login").alias("org_login"), F.trunc("created_at", "MM").alias("month")
    ).agg(
        F.count(F.lit(1)).alias("public_events"),
        F.count_if(F.col("type") == "PushEvent").alias("push_events"),
        F.count_if(F.col("type") == "ForkEvent").alias("fork_events"),
    )
