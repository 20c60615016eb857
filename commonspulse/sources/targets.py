"""Target organizations from a CSV file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commonspulse.functions.expressions import as_bigint


def _pick(columns: dict[str, str], *names: str) -> str | None:
    return next((columns[n] for n in names if n in columns), None)


def read_targets(spark: SparkSession, path: str, validate: bool = True) -> DataFrame:
    """``(organization_id, historical_login)``, one row per id.

    Header names are matched trimmed and in lower case; other columns are
    ignored.  When an id repeats, its last row in the file wins.  An id that is
    no positive integer is an error naming the record.
    """
    raw = spark.read.options(header=True, escape='"', multiLine=True).csv(path)
    columns = {name.strip().lower(): name for name in raw.columns}
    if not columns:
        raise ValueError("The target file has no header")
    id_column = _pick(columns, "organization_id", "org_id")
    login_column = _pick(columns, "historical_login", "login")
    if id_column is None:
        raise ValueError("No column names the target ids (organization_id, org_id)")

    login = F.btrim(F.col(f"`{login_column}`")) if login_column else F.lit("")
    rows = raw.select(
        F.monotonically_increasing_id().alias("_line"),
        F.coalesce(F.btrim(F.col(f"`{id_column}`")), F.lit("")).alias("_text"),
        F.nullif(login, F.lit("")).alias("historical_login"),
    ).withColumn("organization_id", as_bigint(F.col("_text")))

    if validate:
        bad = rows.where(F.coalesce(F.col("organization_id") <= 0, F.lit(True)))
        first = bad.orderBy("_line").limit(1).collect()
        if first:
            line = rows.where(F.col("_line") < first[0]["_line"]).count() + 2
            raise ValueError(f"Invalid organization_id at CSV line {line}: {first[0]['_text']!r}")
        if rows.isEmpty():
            raise ValueError("No target is listed below the header")

    last = F.max_by(F.struct("historical_login"), F.col("_line"))
    return (
        rows.groupBy("organization_id").agg(last.alias("_last"))
        .select("organization_id", F.col("_last.historical_login").alias("historical_login"))
    )
