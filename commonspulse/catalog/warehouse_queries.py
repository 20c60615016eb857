"""Loads into the warehouse and the rules of its tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from commonspulse import constants as C
from commonspulse import schemas
from commonspulse.catalog.adapter import cte, raw_events, views
from commonspulse.catalog.load_queries import _HITS, search_results
from commonspulse.catalog.panel_queries import LOGIN_PANEL, login_panel
from commonspulse.catalog.registry import query
from commonspulse.operators import projections, search
from commonspulse.plans import warehouse
from commonspulse.session import scratch_dir

_METRICS = ", ".join(C.LOGIN_PANEL_METRICS)


@query("w_panel_load", LOGIN_PANEL + f"""
select org_login, month, {_METRICS} from panel
union all select org_login, cast(month - interval 20 year as date), {', '.join('0' for _ in C.LOGIN_PANEL_METRICS)} from panel""")
def panel_load(spark, sf_dir):
    """The stored panel has zeros for every month, and for the one twenty years before, which stays."""
    zeros = projections.panel_rows(login_panel(spark, sf_dir)).withColumns({m: F.lit(0).cast("bigint") for m in C.LOGIN_PANEL_METRICS})
    stored = zeros.unionByName(zeros.withColumn("month", F.add_months("month", -240)))
    root = scratch_dir(spark, "panel-load")
    warehouse.load_panel(raw_events(spark, sf_dir), stored, f"{root}/panel", f"{root}/collection_run")
    return spark.read.schema(stored.schema).parquet(f"{root}/panel").select("org_login", "month", *C.LOGIN_PANEL_METRICS)


@query("p9_search_load", f"""
select query, repo_id, rank, case when rank <= 100 then 'stored' else full_name end as full_name from ({_HITS.format("rank")}) hits""")
def search_load(spark, sf_dir):
    """The first hundred hits of each query are stored already and stay as they are."""
    results = search_results(spark, sf_dir)
    stored = search.ranked_hits(results, 100).withColumn("full_name", F.lit("stored"))
    return warehouse.load_search_hits(stored, results).select("query", "repo_id", "rank", "full_name")


# What the given rows lack of a table's keys and required columns.
_LACKING = {
    "organization": {"collected_at": "cast(null as timestamp)"},
    "repository": {"archived": "repo_id % 2 = 0", "disabled": "cast(null as boolean)", "collected_at": "created_at"},
    "repository_metric_snapshot": {},
    "commit_activity": {},
    "issue": {"issue_id": "repo_id"},  # several issues of a repository break the rule
    "pull_request": {"pull_id": "case when number < 3 then null else repo_id * 10 + number end"},
}


def _counted_rules(name: str) -> list[str]:
    """SQL that counts what breaks each rule of a table."""
    extra = "".join(f", {sql} as {column}" for column, sql in _LACKING[name].items())
    source = f"(select *{extra} from {name})"
    keys = [schemas.KEYS[name], *([schemas.ALTERNATE_KEYS[name]] if name in schemas.ALTERNATE_KEYS else [])]
    return [
        *(f"""select '{name}' as "table", 'unique({", ".join(k)})' as rule, count(*) as subjects, cast(sum(n) as bigint) as rows
              from (select count(*) as n from {source} t group by {", ".join(k)} having count(*) > 1) u having count(*) > 0""" for k in keys),
        f"""select '{name}', 'not null', count(*), cast(sum(n) as bigint) from (""" + " union all ".join(
            f"select count(*) as n from {source} t where {c} is null" for c in dict.fromkeys([*schemas.KEYS[name], *schemas.REQUIRED[name]])
        ) + ") u where n > 0 having count(*) > 0",
    ]


@query("q4_table_rules", cte(*_LACKING) + " union all ".join(rule for name in _LACKING for rule in _counted_rules(name)))
def table_rules(spark, sf_dir):
    tables = {
        name: rows.withColumns({c: F.expr(sql) for c, sql in _LACKING[name].items()}) if _LACKING[name] else rows
        for name, rows in zip(_LACKING, views(spark, sf_dir, *_LACKING), strict=True)
    }
    return warehouse.broken_rules(tables).groupBy("table", "rule").agg(
        F.count("*").alias("subjects"), F.sum("rows").alias("rows"))
