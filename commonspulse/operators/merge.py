"""Keyed merges.

First- and last-wins are aggregates (``min`` and ``max`` of a struct that starts
with the order), not windows: Spark combines them before the shuffle, so a key
that holds a third of the rows never has to fit into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def _pick(rows: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    """The extreme row of each key by ``order``; the other columns settle ties."""
    if not order:
        raise ValueError("An order within each key is needed")
    first = [c for c in order if c not in keys]
    rest = [c for c in rows.columns if c not in keys and c not in first]
    chosen = rows.groupBy(*keys).agg(pick(F.struct(*first, *rest)).alias("_row"))
    return chosen.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in rows.columns])


def last_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _pick(rows, keys, order, F.max)


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _pick(rows, keys, order, F.min)


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
           defaults: Mapping[str, Any] | None = None) -> DataFrame:
    """Rows of ``incoming`` (one per key) written over ``existing``.

    Only columns that ``incoming`` has are overwritten, and a null overwrites
    too.  Columns it lacks survive; on new rows they take ``defaults`` or null.
    """
    supplied = [c for c in incoming.columns if c not in keys]
    defaults = defaults or {}
    new = incoming.select(*keys, F.struct(F.lit(True).alias("_hit"), *supplied).alias("_new"))
    old = existing.select(*keys, F.struct(F.lit(True).alias("_hit"),
                                          *[c for c in existing.columns if c not in keys]).alias("_old"))
    joined = old.join(new, list(keys), "full_outer")
    columns = []
    for name in existing.columns:
        if name in keys:
            columns.append(F.col(name))
            continue
        kept = F.col(f"_old.`{name}`")
        if name in supplied:
            value = F.when(F.col("_new._hit"), F.col(f"_new.`{name}`")).otherwise(kept)
        elif name in defaults:
            value = F.when(F.col("_old._hit").isNull(), F.lit(defaults[name])).otherwise(kept)
        else:
            value = kept
        columns.append(value.cast(existing.schema[name].dataType).alias(name))
    return joined.select(*columns)


def upsert_many(existing: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[str],
                defaults: Mapping[str, Any] | None = None) -> DataFrame:
    """Upsert of an ordered batch in which keys may repeat: the later row wins."""
    helper = [c for c in order if c not in existing.columns]
    return upsert(existing, last_per_key(rows, keys, order).drop(*helper), keys, defaults)


def absent_rows(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str],
                small_increment: bool = False) -> DataFrame:
    """Rows of ``incoming`` whose key is not stored yet, the first of each key.

    With ``small_increment`` the stored keys are first reduced to those of the
    increment, so Spark can broadcast the increment and scan the stored keys
    without shuffling them.
    """
    first = first_per_key(incoming, keys, order)
    stored = existing.select(*keys)
    if small_increment:
        stored = stored.join(incoming.select(*keys).distinct(), list(keys), "left_semi")
    return first.join(stored, list(keys), "left_anti").select(*incoming.columns)


def insert_ignore(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  order: Sequence[str]) -> DataFrame:
    """``existing`` plus the absent rows; a stored row always stays as it is."""
    added = absent_rows(existing, incoming, keys, order)
    helper = [c for c in order if c not in existing.columns]
    return existing.unionByName(added.drop(*helper), allowMissingColumns=True)


def reconcile_commits(existing: DataFrame, api: DataFrame, archive: DataFrame,
                      api_order: Sequence[str], archive_order: Sequence[str]) -> DataFrame:
    """Commit table after both sources were taken in, in one grouping.

    The latest API row wins whole, nulls included; else the stored row stays;
    else the first archive row fills the gap.
    """
    columns = existing.columns
    order = sorted({*api_order, *archive_order})
    extra = [c for c in order if c not in columns]

    def tagged(rows: DataFrame, origin: str) -> DataFrame:
        padding = [F.lit(None).alias(c) for c in [*columns, *extra] if c not in rows.columns]
        return rows.select("*", *padding).select(*columns, *extra, F.lit(origin).alias("_origin"))

    rows = (
        tagged(existing, "stored")
        .unionByName(tagged(api, "api"))
        .unionByName(tagged(archive, "archive"))
    )

    def only(origin: str, first: Sequence[str]) -> Column:
        ordered = F.struct(*first, *[c for c in columns if c not in first])
        return F.when(F.col("_origin") == origin, ordered)

    best = rows.groupBy("repo_id", "sha").agg(
        F.max(only("api", api_order)).alias("api"),
        F.max(only("stored", [])).alias("stored"),
        F.min(only("archive", archive_order)).alias("archive"),
    )
    picked = [
        F.when(F.col("api").isNotNull(), F.col(f"api.{c}"))
        .when(F.col("stored").isNotNull(), F.col(f"stored.{c}"))
        .otherwise(F.col(f"archive.{c}")).alias(c)
        for c in columns
    ]
    return best.select("api", "stored", "archive").select(*picked)


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that several rows have, as ``(rule, subject, rows)``."""
    return (
        rows.groupBy(*keys).count().where("count > 1")
        .select(F.lit(f"unique({', '.join(keys)})").alias("rule"), F.to_json(F.struct(*keys)).alias("subject"),
                F.col("count").alias("rows"))
    )


def missing_values(rows: DataFrame, required: Sequence[str]) -> DataFrame:
    """Columns that have nulls though they must not, as ``(rule, subject, rows)``."""
    nulls = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    counted = F.array(*[F.struct(F.lit(c).alias("subject"), F.col(c).alias("rows")) for c in required])
    return nulls.select(F.inline(counted)).where("rows > 0").select(F.lit("not null").alias("rule"), "subject", "rows")


def key_violations(rows: DataFrame, keys: Sequence[str], not_null: Sequence[str] = ()) -> DataFrame:
    """Broken key and not-null rules as ``(rule, subject, rows)``; empty when all hold."""
    return repeated_keys(rows, keys).unionByName(missing_values(rows, list(dict.fromkeys([*keys, *not_null]))))
