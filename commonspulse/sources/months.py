"""Months: strict parsing and inclusive enumeration."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commonspulse import constants as C


def as_month(value: str | date) -> date:
    """First day of the month; text must be ``YYYY-MM``, not before the first covered year."""
    if isinstance(value, date):
        return value.replace(day=1)
    if not re.fullmatch(C.MONTH_PATTERN, value):
        raise ValueError(f"Not a month written as year-month: {value!r}")
    year, month = map(int, value.split("-"))
    if year < C.FIRST_YEAR:
        raise ValueError(f"Months before {C.FIRST_YEAR}-01 are not covered: {value!r}")
    return date(year, month, 1)


def month_bounds(start: str | date, end: str | date) -> tuple[date, date]:
    first, last = as_month(start), as_month(end)
    if last < first:
        raise ValueError("The last month lies before the first")
    return first, last


def months_in(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per month between two date columns, both ends included."""
    return bounds.select(
        F.explode(F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("interval 1 month"))).alias("month")
    )


def month_range(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    first, last = month_bounds(start, end)
    return months_in(spark.range(1).select(F.lit(first).alias("start"), F.lit(last).alias("end")))


def month_key(value: date) -> int:
    """``yyyyMM`` as a number, the value of the month partition."""
    return value.year * 100 + value.month
