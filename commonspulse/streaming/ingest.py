"""Incremental ingest with Structured Streaming.

Every micro-batch owns one folder of the table, named by its batch id and
overwritten when the batch is repeated.  What the batch adds is decided against
the earlier folders only, so a batch that runs again after a lost executor
writes the same rows once.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from commonspulse import schemas
from commonspulse.operators.filters import archive_types, of_any_organization
from commonspulse.operators.merge import absent_rows
from commonspulse.operators.projections import archive_commit_rows, event_rows
from commonspulse.sources.tables import create_folder

BATCH = "batch"

# Replays of an event or commit: the earliest archive hour wins, then the
# earliest time; the rest makes the order total.
EVENT_ORDER = ("archive_hour", "created_at", "repo_id", "actor_login", "payload")
COMMIT_ORDER = ("archive_hour", "event_time", "id", "position", "message")


def create(spark: SparkSession, root: str) -> None:
    """Empty event and commit tables, unless they are there already."""
    for name in ("gharchive_event", "commit_activity"):
        create_folder(spark, os.path.join(root, name, f"{BATCH}=-1"), schemas.TABLES[name])


def stored_rows(spark: SparkSession, root: str, schema: str, before: int | None = None) -> DataFrame:
    """Rows of all batches, or of those before one; other folders are not read."""
    rows = spark.read.schema(f"{schema}, {BATCH} bigint").parquet(root)
    if before is not None:
        rows = rows.where(F.col(BATCH) < before)
    return rows.drop(BATCH)


def append_absent(rows: DataFrame, root: str, schema: str, keys: Sequence[str], order: Sequence[str],
                  batch: int) -> None:
    """Write the rows of this batch whose key no earlier batch holds, the first of each key."""
    stored = stored_rows(rows.sparkSession, root, schema, before=batch)
    added = absent_rows(stored, rows, keys, order, small_increment=True)
    added.select(*stored.columns).write.mode("overwrite").parquet(os.path.join(root, f"{BATCH}={batch}"))


def ingest_batch(root: str, organizations: DataFrame | None = None,
                 collected_at: Column | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: raw archive events to the tables made by ``create``.

    ``organizations(login)`` limits the ingest to matching events.  Stored
    events and stored commits always stay as they are.
    """
    def run(events: DataFrame, batch: int) -> None:
        chosen = archive_types(events)
        if organizations is not None:
            chosen = of_any_organization(chosen, organizations)
        chosen = chosen.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            append_absent(event_rows(chosen, collected_at), os.path.join(root, "gharchive_event"),
                          schemas.TABLES["gharchive_event"], ["event_id"], EVENT_ORDER, batch)
            append_absent(archive_commit_rows(chosen, collected_at, keep=("archive_hour", "id")),
                          os.path.join(root, "commit_activity"), schemas.TABLES["commit_activity"],
                          ["repo_id", "sha"], COMMIT_ORDER, batch)
        finally:
            chosen.unpersist()

    return run


def start(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str,
          once: bool = True) -> StreamingQuery:
    """Run a batch function over a stream; ``once`` takes what has landed and stops."""
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
