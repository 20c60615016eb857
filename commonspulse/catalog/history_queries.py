"""Snapshots before cutoffs, coverage of the archive, many targets, undecodable lines, co-partitioned and typed tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commonspulse import constants as C
from commonspulse.catalog.adapter import archive_events, archive_landing, base, cte, ntz, once, raw_events, view
from commonspulse.catalog.panel_queries import TARGET_PANEL, TARGETED
from commonspulse.catalog.registry import query
from commonspulse.catalog.view_queries import CURRENT
from commonspulse.operators import coverage, filters, history, panels, projections, views
from commonspulse.sources import archive, tables

# Cutoffs at the time of a snapshot, within a day, and before all snapshots.
PAIRS = """
select user_id as repo_id, ts as cutoff from events
union all select user_id, date_trunc('day', ts) + interval '12' hour from events
union all select o_custkey, o_orderdate from orders"""


@query("c1_snapshots_before_cutoff", cte("repository_metric_snapshot") + f""", pairs as ({PAIRS}), one as (
  select repo_id, observed_at, stargazers_count, forks_count from repository_metric_snapshot
  qualify row_number() over (partition by repo_id, observed_at
    order by stargazers_count desc nulls last, forks_count desc nulls last) = 1
)
select p.repo_id, p.cutoff, s.observed_at as snapshot_at, s.stargazers_count, s.forks_count
from pairs p asof left join one s on p.repo_id = s.repo_id and p.cutoff > s.observed_at""")
def snapshots_before_cutoff(spark, sf_dir) -> DataFrame:
    snapshots = view(spark, sf_dir, "repository_metric_snapshot")
    for table in ("events", "orders"):
        base(spark, sf_dir, table).createOrReplaceTempView(table)
    pairs = spark.sql(PAIRS).withColumn("cutoff", F.col("cutoff").cast("timestamp"))
    return history.snapshots_before(snapshots, pairs).withColumns({c: ntz(c) for c in ("cutoff", "snapshot_at")})


# Months around those of the archive, so that some are not observed at all.
FIRST, LAST = "2023-11", "2024-03"

_HOURS = cte("archive_event") + f""", calendar as (
  select cast(date_trunc('month', hour) as date) as month, hour from (
    select unnest(generate_series(timestamp '{FIRST}-01', timestamp '2024-03-31 23:00:00', interval 1 hour)) as hour)
), seen as (
  select distinct date_trunc('hour', archive_hour) as hour from archive_event where type = 'WatchEvent'
), missing as (
  select month, hour, hour - interval 1 hour * row_number() over (partition by month order by hour) as run
  from calendar where hour not in (select hour from seen)
), gap as (
  select month, min(hour) as gap_start, max(hour) + interval 1 hour as gap_end, count(*) as hours from missing group by month, run
)
"""


def watched_hours(spark, sf_dir) -> DataFrame:
    """Hours of one feed, the stars: it is the feed whose gaps the panel of stars must know."""
    return archive_events(spark, sf_dir).where("type = 'WatchEvent'").select("archive_hour")


@query("c2_archive_gaps", _HOURS + "select month, gap_start, gap_end, hours from gap")
def archive_gaps(spark, sf_dir) -> DataFrame:
    return coverage.gaps(watched_hours(spark, sf_dir), FIRST, LAST).withColumns({c: ntz(c) for c in ("gap_start", "gap_end")})


@query("c3_panel_coverage", _HOURS + """, months as (
  select month, count(*) as expected_hours, count(*) filter (where hour in (select hour from seen)) as observed_hours
  from calendar group by 1
), stars as (
  select lower(org_login) as org_login, cast(date_trunc('month', created_at) as date) as month, count(*) as star_events
  from archive_event where type = 'WatchEvent' and org_login is not null group by 1, 2
)
select o.org_login, m.month, coalesce(s.star_events, 0) as star_events, m.expected_hours, m.observed_hours,
  coalesce((select max(hours) from gap g where g.month = m.month), 0) as longest_gap_hours,
  case when m.observed_hours = m.expected_hours then 'observed' when m.observed_hours > 0 then 'partly observed'
    else 'not observed' end as coverage
from (select distinct org_login from stars) o cross join months m
left join stars s on s.org_login = o.org_login and s.month = m.month""")
def panel_coverage(spark, sf_dir) -> DataFrame:
    stars = archive_events(spark, sf_dir).where("type = 'WatchEvent'")
    dense = panels.dense_panel(panels.login_month_panel(stars), ["org_login"], C.LOGIN_PANEL_METRICS, FIRST, LAST)
    months = coverage.month_coverage(watched_hours(spark, sf_dir), FIRST, LAST)
    return coverage.with_coverage(dense.select("org_login", "month", "star_events"), months)


@query("f5_targeted_events_of_many", TARGETED)
def targeted_events_of_many(spark, sf_dir) -> DataFrame:
    typed = projections.typed_events(raw_events(spark, sf_dir))
    return panels.targeted_events_of_many(typed, view(spark, sf_dir, "target"), megabytes=1)


@query("f3_any_organization_of_many", cte("archive_event") + """, login as (
  select 'acme-' || cast(s_suppkey as varchar) as login from supplier
)
select event_id, archive_hour, repo_name, org_login from archive_event
where (contains(repo_name, '/') and split_part(lower(repo_name), '/', 1) in (select login from login))
  or lower(org_login) in (select login from login)""")
def any_organization_of_many(spark, sf_dir) -> DataFrame:
    logins = base(spark, sf_dir, "supplier").select(F.concat(F.lit("Acme-"), F.col("s_suppkey")).alias("login"))
    rows = filters.of_any_organization_of_many(archive_events(spark, sf_dir), logins, megabytes=1)
    return rows.select(F.col("id").alias("event_id"), ntz("archive_hour"), F.col("repo.name").alias("repo_name"),
                       F.col("org.login").alias("org_login"))


def typed_months(spark, sf_dir) -> DataFrame:
    """Typed events written by month once, and read back."""
    path = once(spark, sf_dir, "typed-months", lambda path: archive.write_typed_months(
        projections.typed_events(raw_events(spark, sf_dir)), path))
    return archive.scan_typed_months(spark, path)


@query("a2_panel_of_typed_months", TARGET_PANEL + "select * from panel")
def panel_of_typed_months(spark, sf_dir) -> DataFrame:
    return panels.typed_target_panel(typed_months(spark, sf_dir), view(spark, sf_dir, "target"))


@query("f5_targeted_of_typed_months", TARGETED)
def targeted_of_typed_months(spark, sf_dir) -> DataFrame:
    return panels.targeted_events(typed_months(spark, sf_dir), view(spark, sf_dir, "target"))


@query("s1_line_ledger", cte("archive_event") + """
select archive_hour, cast(sum(case when type = 'WatchEvent' then 2 else 1 end) as bigint) as lines,
  count(*) filter (where type = 'WatchEvent') as dropped
from archive_event group by 1""")
def line_ledger(spark, sf_dir) -> DataFrame:
    """Lines per hour; an hour of the landing folder may be several files."""
    files = archive.line_ledger(spark, archive_landing(spark, sf_dir))
    return files.groupBy(ntz("archive_hour")).agg(F.sum("lines").alias("lines"), F.sum("dropped").alias("dropped"))


@query("j3_copartitioned", CURRENT + """
select repo_id, org_id, name, is_fork, stargazers_count, forks_count, observed_at from current_repository""")
def copartitioned_current(spark, sf_dir) -> DataFrame:
    """Repositories and snapshots bucketed by ``repo_id`` once; grouping and join then need no shuffle."""
    def write(path: str) -> None:
        columns = ["repo_id", "org_id", "name", "is_fork"]
        tables.write_copartitioned({
            f"{os.path.basename(path)}_repository".replace("-", "_"): view(spark, sf_dir, "repository").select(*columns),
            f"{os.path.basename(path)}_snapshot".replace("-", "_"): view(spark, sf_dir, "repository_metric_snapshot"),
        }, path, "repo_id", 16)

    name = os.path.basename(once(spark, sf_dir, "copartitioned", write)).replace("-", "_")
    rows = views.repository_current(spark.table(f"`{name}_repository`"), spark.table(f"`{name}_snapshot`"))
    return rows.select("repo_id", "org_id", "name", "is_fork", "stargazers_count", "forks_count", ntz("observed_at"))
