"""Which hours of the archive were observed, so that a zero can be told from no data.

Hours of the calendar are few (some 9,000 a year); events meet them as one row
per distinct hour.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commonspulse.sources.months import month_bounds

# What a month's zeros mean.
OBSERVED, PARTLY, UNOBSERVED = "observed", "partly observed", "not observed"


def hour_calendar(hours: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """Every hour of the months, both included, as ``(month, hour, seen)``.

    ``hours`` has ``archive_hour``, repeated or not; nulls count for nothing.
    """
    first, last = month_bounds(start, end)
    months = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month"))
    calendar = hours.sparkSession.range(1).select(F.explode(months).alias("month")).select(
        "month", F.explode(F.sequence(
            F.col("month").cast("timestamp"), F.add_months("month", 1).cast("timestamp") - F.expr("interval 1 hour"),
            F.expr("interval 1 hour"))).alias("hour"))
    seen = hours.select(F.date_trunc("hour", "archive_hour").alias("hour")).distinct().withColumn("seen", F.lit(True))
    return calendar.join(seen, "hour", "left").select("month", "hour", F.coalesce("seen", F.lit(False)).alias("seen"))


def gaps(hours: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """Runs of hours without data as ``(month, gap_start, gap_end, hours)``, the end excluded; cut at months."""
    missing = hour_calendar(hours, start, end).where(~F.col("seen"))
    place = F.row_number().over(Window.partitionBy("month").orderBy("hour"))
    # In a run of hours, the hour less its place is the same.
    run = F.unix_timestamp("hour") - place * 3600
    return missing.withColumn("run", run).groupBy("month", "run").agg(
        F.min("hour").alias("gap_start"),
        (F.max("hour") + F.expr("interval 1 hour")).alias("gap_end"),
        F.count(F.lit(1)).alias("hours"),
    ).drop("run")


def month_coverage(hours: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """Per month: hours expected, hours observed, the longest gap and what a zero means."""
    counted = hour_calendar(hours, start, end).groupBy("month").agg(
        F.count(F.lit(1)).alias("expected_hours"), F.count_if("seen").alias("observed_hours"))
    longest = gaps(hours, start, end).groupBy("month").agg(F.max("hours").alias("longest_gap_hours"))
    meaning = (
        F.when(F.col("observed_hours") == F.col("expected_hours"), OBSERVED)
        .when(F.col("observed_hours") > 0, PARTLY).otherwise(UNOBSERVED)
    )
    return counted.join(longest, "month", "left").select(
        "month", "expected_hours", "observed_hours",
        F.coalesce("longest_gap_hours", F.lit(0).cast("bigint")).alias("longest_gap_hours"), meaning.alias("coverage"))


def with_coverage(panel: DataFrame, coverage: DataFrame) -> DataFrame:
    """Panel rows with the coverage of their month; months outside it, and null ones, are not observed.

    ``coverage`` is one row per month, so Spark sends it to the panel's tasks.
    """
    names = [c for c in coverage.columns if c != "month"]
    joined = panel.join(coverage, "month", "left")
    return joined.select(*panel.columns, *[
        F.coalesce(c, F.lit(UNOBSERVED)).alias(c) if c == "coverage" else F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
        for c in names])
