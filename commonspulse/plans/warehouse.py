"""The warehouse as a whole: tables and named views for SQL, loads of the panel and of search hits, key rules."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commonspulse import constants as C
from commonspulse import schemas
from commonspulse.operators import merge, panels, projections, search, views
from commonspulse.plans.runlog import audited_run
from commonspulse.sources.tables import read_table

# Each named view: what makes it, and the tables that takes, in order.
VIEWS = {
    "repository_current": (views.repository_current, ("repository", "repository_metric_snapshot")),
    "organization_monthly_activity": (
        views.organization_monthly_activity, ("commit_activity", "issue", "pull_request", "repository", "organization")),
    "organization_innovation_summary": (
        views.innovation_summary,
        ("organization", "repository", "repository_metric_snapshot", "commit_activity", "issue", "pull_request")),
    "organization_public_activity_totals": (panels.activity_totals, ("organization_public_monthly",)),
}


def stored_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables below ``root``; each must be there (``create_tables`` makes the missing ones)."""
    return {name: read_table(spark, root, name) for name in schemas.TABLES}


def with_views(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables and the named views whose tables are among them, as ``run_query`` takes them."""
    made = {name: make(*(tables[t] for t in taken)) for name, (make, taken) in VIEWS.items() if all(t in tables for t in taken)}
    return {**tables, **made}


def load_panel(events: DataFrame, stored: DataFrame, path: str, log: str, target: str = "all") -> None:
    """Write ``stored`` with the login panel of ``events`` merged in to ``path``, a new folder; the run is logged."""
    spark = events.sparkSession
    with audited_run(spark, log, C.SOURCE_PANEL, target) as run:
        rows = run.counted(projections.panel_rows(panels.login_month_panel(events)))
        merge.upsert_many(stored, rows, schemas.KEYS["organization_public_monthly"], ["collected_at"]).write.parquet(path)


def load_search_hits(stored: DataFrame, results: DataFrame, limit: int | None = None) -> DataFrame:
    """Stored hits and the ranked ones of ``results`` that are not stored yet."""
    return merge.insert_ignore(stored, search.ranked_hits(results, limit), schemas.KEYS["repository_search_hit"], ["rank"])


def broken_rules(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Broken key, second key and not-null rules as ``(table, rule, subject, rows)``; empty when all hold."""
    parts = []
    for name, rows in tables.items():
        keys = [schemas.KEYS[name], *([schemas.ALTERNATE_KEYS[name]] if name in schemas.ALTERNATE_KEYS else [])]
        required = dict.fromkeys([*schemas.KEYS[name], *schemas.REQUIRED[name]])
        broken = [merge.repeated_keys(rows, k) for k in keys] + [merge.missing_values(rows, list(required))]
        parts += [b.select(F.lit(name).alias("table"), "rule", "subject", "rows") for b in broken]
    return reduce(DataFrame.unionByName, parts)
