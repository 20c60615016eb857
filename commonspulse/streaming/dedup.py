"""First row of every event from a stream, kept in Spark's state store, with an exact look-up for what comes late.

Replays of an event carry its ``created_at``, so (id, created_at) is one group of a streaming aggregate: the state holds
the least row of each event by archive hour, and gives it out once the watermark on ``created_at`` has passed it.  State
is bounded by the watermark's delay, replays inside it cost no look-up, and a settled event is written once.

Rows that come after their watermark do not reach the state; Spark counts them (``dropped_rows``).  ``catch_up`` takes
them in, and also the hours whose events are still in the state: it looks their ids up in the stored rows of their own
days only.  Settled rows are looked up in the same way, so either may come first, and repeating a batch changes nothing.
Rows without ``created_at`` can only be caught up; they are one day of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from commonspulse import schemas
from commonspulse.operators.merge import absent_rows
from commonspulse.operators.projections import event_rows
from commonspulse.streaming.ingest import EVENT_ORDER, start

RAW = ("id", "type", "created_at", "actor", "repo", "org", "payload", "archive_hour")
UNDATED = "undated"


def settled(events: DataFrame, delay: str) -> DataFrame:
    """The least row of each event of a stream, given out ``delay`` of event time later."""
    # As in EVENT_ORDER; what follows makes the order total.
    order = F.struct("archive_hour", F.col("repo.id").alias("repo_id"), F.col("actor.login").alias("actor_login"), "payload", "type", "actor", "repo", "org")
    least = events.select(*RAW).withWatermark("created_at", delay).groupBy("id", "created_at").agg(F.min(order).alias("least"))
    return least.select(*[F.col(c) if c in ("id", "created_at") else F.col(f"least.{c}").alias(c) for c in RAW])


def read_events(spark: SparkSession, root: str) -> DataFrame:
    """Stored events with the day they lie under and the batch that brought them."""
    return spark.read.schema(f"{schemas.TABLES['gharchive_event']}, day string, batch string").parquet(root)


def _day() -> Column:
    return F.coalesce(F.date_format("created_at", "yyyy-MM-dd"), F.lit(UNDATED))


def stored_of_days(spark: SparkSession, root: str, days: list[str], batch: str) -> DataFrame:
    """Events stored under these days by other batches; other folders are not read."""
    return read_events(spark, root).where(F.col("day").isin(days) & (F.col("batch") != batch))


def _insert(rows: DataFrame, root: str, batch: str) -> None:
    """Write the first row of each id that no other batch has stored under the same day."""
    spark = rows.sparkSession
    rows = rows.withColumn("day", _day())
    days = [r["day"] for r in rows.select("day").distinct().collect()]  # a value for each day
    if not days:
        return
    added = absent_rows(stored_of_days(spark, root, days, batch), rows, ["event_id"], EVENT_ORDER, small_increment=True)
    added.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(root)


def create(spark: SparkSession, root: str) -> None:
    schema = f"{schemas.TABLES['gharchive_event']}, day string, batch string"
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy("day", "batch").parquet(root)


def settle_batch(root: str, collected_at: Column | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for a stream of ``settled`` rows."""
    def run(events: DataFrame, batch: int) -> None:
        # Settled rows leave the state once, so they are kept while the batch looks at them twice.
        rows = event_rows(events, collected_at).persist()
        try:
            _insert(rows, root, f"stream-{batch}")
        finally:
            rows.unpersist()

    return run


def start_settling(stream: DataFrame, root: str, delay: str, checkpoint: str, collected_at: Column | None = None, once: bool = True) -> StreamingQuery:
    create(stream.sparkSession, root)
    return start(settled(stream.where("created_at is not null"), delay), settle_batch(root, collected_at), checkpoint, once)


def catch_up(events: DataFrame, root: str, name: str, collected_at: Column | None = None) -> None:
    """Take in events whatever the state holds; ``name`` tells this load from others and makes it repeatable."""
    create(events.sparkSession, root)
    _insert(event_rows(events, collected_at), root, f"load-{name}")


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that came after their watermark in the batches this query still remembers: hours to catch up."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])
