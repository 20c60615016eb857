"""Per-organization documents, combined files and manifests.

A document is one row: the observed months of an organization are collected
(never more than the range has months) and the zero months are filled in by a
sequence inside the row, so the dense panel is never multiplied out.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commonspulse import constants as C
from commonspulse.functions.expressions import month_text, safe_login, shard_of
from commonspulse.operators.filters import months_between
from commonspulse.operators.panels import activity_summary_columns, dense_panel, filled_months, months_seen
from commonspulse.sources.months import month_bounds


def _period(first: date, last: date) -> Column:
    count = (last.year - first.year) * 12 + last.month - first.month + 1
    return F.struct(
        F.lit(f"{first:%Y-%m}").alias("start"), F.lit(f"{last:%Y-%m}").alias("end"),
        F.lit(count).alias("months"),
    )


def login_documents(panel: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """``(org_login, shard, safe_login, document)`` for organizations with a row in the range."""
    first, last = month_bounds(start, end)
    totals = [F.coalesce(F.sum(m), F.lit(0)).alias(f"total_{m}") for m in C.LOGIN_ADDITIVE_METRICS]
    summary = activity_summary_columns()
    names = ["months_with_activity", *[f"{f}_monthly_{m}" for m in C.NON_ADDITIVE_METRICS for f in ("sum", "max")]]
    rows = months_between(panel, first, last)
    grouped = months_seen(rows, ["org_login"], C.LOGIN_PANEL_METRICS, *totals, *summary)
    document = F.struct(
        F.lit(C.LOGIN_DOCUMENT_VERSION).alias("schema_version"),
        F.struct(F.col("org_login").alias("login")).alias("organization"),
        _period(first, last).alias("period"),
        F.lit(C.LOGIN_DOCUMENT_SOURCE).alias("source"),
        F.struct(
            F.lit(C.LOGIN_DOCUMENT_DEFINITION).alias("definition"),
            F.lit(True).alias("zero_filled_months"),
            F.lit(False).alias("private_activity_included"),
        ).alias("coverage"),
        F.struct(*[F.col(f"total_{m}").alias(m) for m in C.LOGIN_ADDITIVE_METRICS]).alias("totals"),
        F.struct(*names).alias("monthly_activity_summary"),
        filled_months(first, last, C.LOGIN_PANEL_METRICS, text=True).alias("monthly"),
    )
    name = safe_login(F.col("org_login"))
    return grouped.select("org_login", shard_of(name).alias("shard"), name.alias("safe_login"),
                          document.alias("document"))


def named_apart(documents: DataFrame) -> DataFrame:
    """A file name for every login: of logins that share one, the last keeps it and the others add a digest of theirs."""
    logins = documents.select("shard", "safe_login", "org_login")
    last = logins.groupBy("shard", "safe_login").agg(F.max("org_login").alias("_last"))
    apart = F.concat_ws("-", "safe_login", F.sha2("org_login", 256))
    return documents.join(last, ["shard", "safe_login"]).withColumn(
        "safe_login", F.when(F.col("org_login") == F.col("_last"), F.col("safe_login")).otherwise(apart)).drop("_last")


def target_documents(targets: DataFrame, panel: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """``(organization_id, document)`` for every target, active or not."""
    first, last = month_bounds(start, end)
    totals = [F.sum(m).alias(f"total_{m}") for m in C.TARGET_ADDITIVE_METRICS]
    rows = months_between(panel, first, last)
    grouped = months_seen(rows, ["organization_id"], C.TARGET_PANEL_METRICS, *totals)
    document = F.struct(
        "organization_id", "historical_login",
        _period(first, last).alias("period"),
        F.lit(C.TARGET_DOCUMENT_SOURCE).alias("source"),
        F.struct(
            F.lit(True).alias("public_activity_only"),
            F.lit(True).alias("zero_filled_months"),
            F.lit(False).alias("persistent_database_created"),
        ).alias("coverage"),
        F.struct(*[F.coalesce(f"total_{m}", F.lit(0)).alias(m) for m in C.TARGET_ADDITIVE_METRICS]).alias("totals"),
        filled_months(first, last, C.TARGET_PANEL_METRICS, text=True).alias("monthly"),
    )
    return targets.join(grouped, "organization_id", "left").select(
        "organization_id", document.alias("document")
    )


def document_text(documents: DataFrame, pretty: bool = False) -> DataFrame:
    """Documents as JSON text in ``body``; null fields are written."""
    options = {"ignoreNullFields": "false", "pretty": str(pretty).lower()}
    return documents.withColumn("body", F.to_json("document", options)).drop("document")


def target_csv_rows(targets: DataFrame, panel: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """One row per target and month, months as text; a missing login stays null and is written empty."""
    rows = dense_panel(panel, ["organization_id"], C.TARGET_PANEL_METRICS, start, end,
                       targets.select("organization_id", "historical_login"))
    return rows.withColumn("month", month_text(F.col("month")))


def unknown_ids(panel: DataFrame, targets: DataFrame) -> DataFrame:
    """Panel ids that are no target; exporting such a panel is an error."""
    return panel.select("organization_id").distinct().join(targets, "organization_id", "left_anti")


def login_manifest(panel: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """One row describing a login export."""
    first, last = month_bounds(start, end)
    return months_between(panel, first, last).agg(F.count_distinct("org_login").alias("organization_count")).select(
        F.lit(C.LOGIN_DOCUMENT_VERSION).alias("schema_version"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("generated_at"),
        F.lit(C.LOGIN_DOCUMENT_SOURCE).alias("source"),
        F.lit(C.LOGIN_MANIFEST_DEFINITION).alias("definition"),
        _period(first, last).alias("period"),
        "organization_count",
        F.lit(C.LOGIN_FILE_LAYOUT).alias("file_layout"),
        F.array(*map(F.lit, C.LOGIN_PANEL_METRICS)).alias("metrics"),
    )


def target_manifest(targets: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """One row describing a target export; the file names are ``target_file_names``."""
    first, last = month_bounds(start, end)
    months = (last.year - first.year) * 12 + last.month - first.month + 1
    return targets.agg(F.count(F.lit(1)).alias("organization_count")).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("generated_at"),
        "organization_count",
        (F.col("organization_count") * months).alias("monthly_row_count"),
        F.lit(C.TARGET_CSV_NAME).alias("combined_csv"),
        F.lit(False).alias("persistent_database_created"),
    )


def target_file_names(targets: DataFrame) -> DataFrame:
    return targets.select(F.concat(F.col("organization_id").cast("string"), F.lit(".json")).alias("json_file"))
