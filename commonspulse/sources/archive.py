"""Event archive: hourly JSON files and the monthly Parquet table made from them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from commonspulse import schemas
from commonspulse.session import whole_files
from commonspulse.sources.months import month_bounds, month_key

# Fixed value: date and unpadded hour at the end of an archive path.
HOUR_IN_PATH = r"(\d{4}-\d{2}-\d{2})-(\d{1,2})[^/]*(?:/[^/]*)?$"

LINE = f"{schemas.RAW_EVENT}, _corrupt string"
JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def hours_in(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Whole hours from the hour of ``start`` up to, not including, ``end``."""
    return (
        bounds.where(F.date_trunc("hour", start) < F.col(end))
        .select(
            F.col(end).alias("_end"),
            F.explode(
                F.sequence(F.date_trunc("hour", start), F.col(end), F.expr("interval 1 hour"))
            ).alias("archive_hour"),
        )
        .where(F.col("archive_hour") < F.col("_end"))
        .select("archive_hour")
    )


def hour_stem(hour: str) -> F.Column:
    """Name of an hourly file without its ending; the hour is not padded."""
    moment = F.col(hour)
    return F.concat(F.date_format(moment, "yyyy-MM-dd"), F.lit("-"), F.hour(moment).cast("string"))


def archive_hours(start: datetime, end: datetime) -> list[datetime]:
    """The same enumeration on the driver, for building a path list."""
    first, last = (m.replace(tzinfo=UTC) if m.tzinfo is None else m.astimezone(UTC) for m in (start, end))
    first = first.replace(minute=0, second=0, microsecond=0)
    count = max(0, -(-(last - first) // timedelta(hours=1)))
    return [first + timedelta(hours=i) for i in range(count)]


def archive_paths(root: str, start: datetime, end: datetime) -> list[str]:
    return [f"{root}/{h:%Y-%m-%d}-{h.hour}.json.gz" for h in archive_hours(start, end)]


def read_archive(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Raw events of hourly files, plus the hour in the path; undecodable lines are dropped.

    ``payload`` keeps its JSON text.  One gzip file is one task, so the files
    spread over the cluster; compact them once with :func:`write_month_table`.
    """
    return _parsed(spark.read.schema(LINE).options(**JSON_OPTIONS).json(
        paths if isinstance(paths, str) else list(paths)))


def read_hours(spark: SparkSession, root: str, start: datetime, end: datetime) -> DataFrame:
    """Events of the files below ``root`` whose hour is in the range, ``start`` floored, ``end`` excluded.

    The range is a filter on the file path, so other files are listed but not
    opened.  Events are not trimmed to the minute: files count whole.
    """
    rows = spark.read.schema(LINE).options(**JSON_OPTIONS).option("recursiveFileLookup", "true").json(root)
    hour = _hour_of_path()
    low, high = (F.lit(m if m.tzinfo else m.replace(tzinfo=UTC)) for m in (start, end))
    return _parsed(rows.where((hour >= F.date_trunc("hour", low)) & (hour < high)))


def missing_hours(hours: DataFrame, events: DataFrame) -> DataFrame:
    """Hours asked for of which no event is there: not observed, rather than observed as zero."""
    return hours.join(events.select("archive_hour").distinct(), "archive_hour", "left_anti")


def line_ledger(spark: SparkSession, root: str) -> DataFrame:
    """Lines and undecodable lines of every file below ``root``, as ``(file, archive_hour, lines, dropped)``.

    ``dropped`` counts the lines that :func:`read_archive` leaves out.  Blank
    lines are no lines; a file without lines has no row.  Only whether a line
    decodes is read, counted before the shuffle: one file is one row.
    """
    rows = spark.read.schema("id string, type string, _corrupt string").options(**JSON_OPTIONS).option(
        "recursiveFileLookup", "true").json(root)
    return rows.groupBy(F.col("_metadata.file_path").alias("file"), _hour_of_path().alias("archive_hour")).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(~_decoded()).alias("dropped"))


def read_archive_counted(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, Observation]:
    """:func:`read_archive`, and ``lines`` and ``dropped`` over all files, observed in the pass that reads the rows.

    The figures are there once the rows were written; store them beside the run.
    """
    rows = spark.read.schema(LINE).options(**JSON_OPTIONS).json(paths if isinstance(paths, str) else list(paths))
    seen = Observation()
    return _parsed(rows.observe(
        seen, F.count(F.lit(1)).alias("lines"), F.count_if(~_decoded()).alias("dropped"))), seen


def read_archive_stream(spark: SparkSession, root: str, max_files: int = 1000) -> DataFrame:
    """The same rows as a stream over a landing folder."""
    return _parsed(
        spark.readStream.schema(LINE).options(**JSON_OPTIONS)
        .option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", "true").json(root)
    )


def _hour_of_path() -> F.Column:
    path = F.col("_metadata.file_path")
    day, hour = (F.regexp_extract(path, HOUR_IN_PATH, i) for i in (1, 2))
    return F.try_to_timestamp(F.concat(day, F.lit(" "), F.lpad(hour, 2, "0")), F.lit("yyyy-MM-dd HH"))


def _decoded() -> F.Column:
    """A line that is no JSON leaves nothing behind; one with a mistyped field keeps its other fields."""
    return F.col("_corrupt").isNull() | F.col("id").isNotNull() | F.col("type").isNotNull()


def _parsed(rows: DataFrame) -> DataFrame:
    return rows.select("*", _hour_of_path().alias("archive_hour")).where(_decoded()).drop("_corrupt")


def with_month(events: DataFrame) -> DataFrame:
    return events.withColumn("event_month", F.date_format("created_at", "yyyyMM").cast("int"))


def write_month_table(events: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Raw events as Parquet, one partition per month.

    Rebalancing by month lets Spark split a busy month over as many tasks and
    files as its size needs, and gather quiet months in few.
    """
    rows = with_month(events).hint("rebalance", F.col("event_month"))
    with whole_files(events.sparkSession):
        rows.write.mode(mode).partitionBy("event_month").parquet(path)


def scan_months(spark: SparkSession, path: str, start: str | date, end: str | date) -> DataFrame:
    """The month table between two months, both included; other partitions are not read."""
    first, last = month_bounds(start, end)
    return spark.read.parquet(path).where(
        F.col("event_month").between(month_key(first), month_key(last))
    )


def write_typed_months(typed: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Typed events as Parquet, one partition per month: the JSON was parsed once, panels read these columns only.

    ``mode="overwrite"`` with ``spark.sql.sources.partitionOverwriteMode`` as
    dynamic renews only the months that ``typed`` has.  Events without time
    are a partition of their own.
    """
    rows = typed.withColumn("event_month", F.date_format("month", "yyyyMM").cast("int"))
    with whole_files(typed.sparkSession):
        rows.hint("rebalance", F.col("event_month")).write.mode(mode).partitionBy("event_month").parquet(path)


def scan_typed_months(spark: SparkSession, path: str, start: str | date | None = None, end: str | date | None = None) -> DataFrame:
    """Typed events, of all months or of those between two, both included; other partitions are not read."""
    rows = spark.read.parquet(path)
    if start is not None and end is not None:
        first, last = month_bounds(start, end)
        rows = rows.where(F.col("event_month").between(month_key(first), month_key(last)))
    elif start is not None or end is not None:
        raise ValueError("Both months are needed, or none")
    return rows.drop("event_month")
