"""Log of collection runs: an append-only table with a start and a finish row per run."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from commonspulse import schemas


@dataclass
class Run:
    """An open run; set ``rows_written``, or let ``counted`` observe it."""

    run_id: int
    rows_written: int = 0
    _observed: Observation | None = None

    def counted(self, rows: DataFrame) -> DataFrame:
        """The same rows, counted while they are written; no extra pass."""
        self._observed = Observation()
        return rows.observe(self._observed, F.count(F.lit(1)).alias("rows"))

    def total(self) -> int:
        return self._observed.get["rows"] if self._observed is not None else self.rows_written


@contextmanager
def audited_run(spark: SparkSession, log: str, source: str, target: str, error_width: int | None = None) -> Iterator[Run]:
    """Log ``running``, then ``succeeded`` or ``failed`` with the error; errors go on to the caller.

    The error text is logged whole unless the caller gives an ``error_width``.
    """
    run = Run(time.time_ns())
    started = datetime.now(UTC)

    def append(status: str, finished: datetime | None = None, rows: int = 0, error: str | None = None) -> None:
        row = [(run.run_id, source, target, started, finished, status, rows, error)]
        spark.createDataFrame(row, schemas.table_schema("collection_run")).coalesce(1).write.mode("append").parquet(log)

    append("running")
    try:
        yield run
    except Exception as problem:
        append("failed", datetime.now(UTC), error=str(problem)[:error_width])
        raise
    append("succeeded", datetime.now(UTC), rows=run.total())


def run_states(spark: SparkSession, log: str) -> DataFrame:
    """The last state of every run: a finished row beats the start row."""
    rows = spark.read.schema(schemas.table_schema("collection_run")).parquet(log)
    latest = F.max_by(F.struct(*rows.columns), F.struct(F.col("finished_at").isNotNull(), "finished_at"))
    return rows.groupBy("run_id").agg(latest.alias("r")).select("r.*")
