"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What a task reads, and what it takes from a shuffle, compressed.  Keys of rows may compress a hundred to one, so at Spark's
# own 128 and 64 MB one hash table or sort of a task takes gigabytes, however small the shuffle is as a whole.
TASK_SIZES = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.files.openCostInBytes": "512k",  # as many small files a task as before
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
}
_SPARKS_OWN = {
    "spark.sql.files.maxPartitionBytes": "134217728b",
    "spark.sql.files.openCostInBytes": "4194304b",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "67108864b",
    "spark.sql.parquet.columnarReaderBatchSize": "4096",
    "spark.sql.execution.arrow.maxBytesPerBatch": "67108864b",
}
# Rows that Spark decodes at once and bytes that it gives to Python at once, where a row takes megabytes.
LARGE_ROWS = {"spark.sql.parquet.columnarReaderBatchSize": "4", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}
FILE_SIZE = "64m"  # shuffled bytes of a file of a table that is kept

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    **TASK_SIZES,
}


def build_session(app_name: str = "commonspulse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; ``conf`` adds or overrides."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """Months, days and cutoffs are all defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def bound_tasks(spark: SparkSession) -> None:
    """Sizes of tasks in a session that another program built; a size that was chosen there stays."""
    for key, size in TASK_SIZES.items():
        if spark.conf.get(key) == _SPARKS_OWN[key]:
            spark.conf.set(key, size)


@contextmanager
def whole_files(spark: SparkSession) -> Iterator[None]:
    """A rebalanced table that is written meanwhile gets files of the usual size; a size that was chosen stays."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    size = spark.conf.get(key)
    if size == TASK_SIZES[key]:
        spark.conf.set(key, FILE_SIZE)
    try:
        yield
    finally:
        spark.conf.set(key, size)


@contextmanager
def large_rows(spark: SparkSession) -> Iterator[None]:
    """What is run meanwhile reads a few rows at once; a size that was chosen stays."""
    before = {key: spark.conf.get(key) for key in LARGE_ROWS}
    for key, size in LARGE_ROWS.items():
        if before[key] == _SPARKS_OWN[key]:
            spark.conf.set(key, size)
    try:
        yield
    finally:
        for key, size in before.items():
            spark.conf.set(key, size)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    The cluster names that folder because every executor can reach it.  Only a
    local session without the setting falls back to the warehouse folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "scratch")
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")
