"""Table folder: one Parquet folder per table, read with its fixed schema."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commonspulse import schemas
from commonspulse.operators import merge
from commonspulse.session import scratch_dir

BUCKET = "key_bucket"


def create_folder(spark: SparkSession, path: str, schema: str) -> None:
    """An empty table, unless the folder is there already."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def create_tables(spark: SparkSession, root: str, names: Iterable[str] = tuple(schemas.TABLES)) -> None:
    """Create what is missing; safe to repeat."""
    for name in names:
        create_folder(spark, os.path.join(root, name), schemas.TABLES[name])


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(schemas.table_schema(name)).parquet(os.path.join(root, name))


def write_tables(tables: Mapping[str, DataFrame], root: str) -> None:
    """Write tables in their declared column order below a new folder."""
    for name, frame in tables.items():
        columns = schemas.table_schema(name).fieldNames()
        frame.select(*columns).write.mode("overwrite").parquet(os.path.join(root, name))


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """Where a row lies: a hash of its key, the same for equal keys of one type."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def write_bucketed(frame: DataFrame, path: str, keys: Sequence[str], buckets: int, mode: str = "overwrite") -> None:
    """A table in folders by a hash of its key, so a merge finds and rewrites only those it hits."""
    placed = frame.withColumn(BUCKET, key_bucket(keys, buckets))
    placed.repartition(F.col(BUCKET)).write.mode(mode).partitionBy(BUCKET).parquet(path)


def read_bucketed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, {BUCKET} int").parquet(path)


def merge_into(spark: SparkSession, path: str, schema: str, incoming: DataFrame, keys: Sequence[str], buckets: int,
               order: Sequence[str] = (), defaults: Mapping[str, Any] | None = None, keep_stored: bool = False) -> list[int]:
    """Merge ``incoming`` into the bucketed table at ``path``; the folders that were rewritten.

    Incoming rows overwrite what they supply (the last of a key by ``order`` wins), or with ``keep_stored`` only fill in
    keys that are not there yet (the first by ``order`` wins).  Other folders are neither read nor written.  The merged
    folders are written aside first, so a lost executor or a repeated merge finds the table whole.
    """
    columns = [c for c in spark.createDataFrame([], schema).columns]
    types = spark.createDataFrame([], schema).schema
    # Keys hash alike only if they have the stored type.
    rows = incoming.select(*[F.col(c).cast(types[c].dataType).alias(c) if c in keys else F.col(c) for c in incoming.columns])
    hit = sorted(r[0] for r in rows.select(key_bucket(keys, buckets).alias(BUCKET)).distinct().collect())  # at most ``buckets``
    if not hit:
        return []
    stored = read_bucketed(spark, path, schema).where(F.col(BUCKET).isin(hit)).select(*columns)
    if keep_stored:
        merged = merge.insert_ignore(stored, rows, keys, order)
    elif order:
        merged = merge.upsert_many(stored, rows, keys, order, defaults)
    else:
        merged = merge.upsert(stored, rows, keys, defaults)
    aside = scratch_dir(spark, "merged")
    merged.select(*columns).withColumn(BUCKET, key_bucket(keys, buckets)).write.parquet(aside)
    whole = spark.read.schema(f"{schema}, {BUCKET} int").parquet(aside)
    whole.repartition(F.col(BUCKET)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    return hit


def write_copartitioned(frames: Mapping[str, DataFrame], root: str, key: str, buckets: int) -> dict[str, DataFrame]:
    """Tables bucketed and sorted by one key, so that grouping and joining them by it needs no shuffle.

    Written once below ``root``, which all executors share, and entered in the catalog under their names, where they
    replace entries of that name (the files of those stay).  ``buckets`` is the number of tasks such a join has; take it
    so that a bucket fits an executor.  A key with very many rows still is one bucket: count such facts before joining.
    """
    tables = {}
    for name, frame in frames.items():
        spark = frame.sparkSession
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        frame.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode("overwrite").option(
            "path", os.path.join(root, name)).saveAsTable(f"`{name}`")
        tables[name] = spark.table(f"`{name}`")
    return tables
