"""Joins, portfolio views, measures and screens."""

from __future__ import annotations

from pyspark.sql import functions as F

from commonspulse.catalog.adapter import base, cte, ntz, view, views
from commonspulse.catalog.panel_queries import LOGIN_PANEL, login_panel
from commonspulse.catalog.registry import query
from commonspulse.functions import expressions as X
from commonspulse.operators import filters, measures, merge, panels
from commonspulse.operators import views as V
from commonspulse.operators.dependencies import setup_dependencies
from commonspulse.plans.queries import run_query
from commonspulse.plans.warehouse import with_views

FACTS = ("commit_activity", "issue", "pull_request", "repository", "organization")

LATEST = """, latest as (
  select s.* from repository_metric_snapshot s
  join (select repo_id, max(observed_at) as observed_at from repository_metric_snapshot group by 1) m
    on s.repo_id = m.repo_id and s.observed_at = m.observed_at
), current_repository as (
  select r.*, s.stargazers_count, s.forks_count, s.observed_at
  from repository r left join latest s on r.repo_id = s.repo_id
)
"""

# Phrases for the given part names; the default ones have no match there.
PART_PHRASES = ("red widget", "small ring")


@query("j1_inner_joins", cte("issue", "repository", "organization") + """
select o.login, r.repo_id, i.number from issue i join repository r using (repo_id) join organization o using (org_id)""")
def inner_joins(spark, sf_dir):
    issue, repo, org = views(spark, sf_dir, "issue", "repository", "organization")
    joined = issue.select("repo_id", "number").join(repo.select("repo_id", "org_id"), "repo_id").join(org, "org_id")
    return joined.select("login", "repo_id", "number")


SUMMARY = cte(*FACTS, "repository_metric_snapshot") + LATEST + """, tallied as (
  select c.*, (select count(*) from commit_activity f where f.repo_id = c.repo_id) as n_commits,
    (select count(*) from issue f where f.repo_id = c.repo_id) as n_issues,
    (select count(*) from pull_request f where f.repo_id = c.repo_id) as n_pulls
  from current_repository c
), summary as (
  select login, count(repo_id) as repositories, count(repo_id) filter (where is_fork = false) as original_repositories,
    count(repo_id) filter (where is_fork) as forked_repositories, cast(coalesce(sum(n_commits), 0) as bigint) as commits,
    cast(coalesce(sum(n_issues), 0) as bigint) as issues, cast(coalesce(sum(n_pulls), 0) as bigint) as pull_requests,
    cast(coalesce(sum(stargazers_count), 0) as bigint) as current_stars
  from organization left join tallied using (org_id) group by org_id, login
)
"""


def innovation_summary(spark, sf_dir):
    commits, issues, pulls, repos, orgs, snaps = views(spark, sf_dir, *FACTS, "repository_metric_snapshot")
    return V.innovation_summary(orgs, repos, snaps, commits, issues, pulls)


query("a11_innovation_summary", SUMMARY + "select * from summary")(innovation_summary)


def warehouse(spark, sf_dir):
    """The given rows as warehouse tables, with the named views."""
    names = (*FACTS, "repository_metric_snapshot")
    return with_views(dict(zip(names, views(spark, sf_dir, *names), strict=True)))


@query("w4_innovation_summary_view", SUMMARY + "select * from summary")
def innovation_summary_view(spark, sf_dir):
    return run_query(spark, "select * from organization_innovation_summary", warehouse(spark, sf_dir))


@query("j2_preaggregated_left_joins", SUMMARY + "select login, commits, issues, pull_requests from summary")
def preaggregated_left_joins(spark, sf_dir):
    return innovation_summary(spark, sf_dir).select("login", "commits", "issues", "pull_requests")


@query("a17_origin_counts", SUMMARY + """
select login, original_repositories, forked_repositories from summary where repositories > 0""")
def origin_counts(spark, sf_dir):
    repos, orgs = views(spark, sf_dir, "repository", "organization")
    return repos.join(orgs.select("org_id", "login"), "org_id").groupBy("login").agg(
        F.count_if(~F.col("is_fork")).alias("original_repositories"),
        F.count_if("is_fork").alias("forked_repositories"),
    )


def current(spark, sf_dir):
    return V.repository_current(*views(spark, sf_dir, "repository", "repository_metric_snapshot"))


CURRENT = cte("repository", "repository_metric_snapshot") + LATEST


@query("j3_repository_current", CURRENT + """
select repo_id, org_id, name, is_fork, stargazers_count, forks_count, observed_at from current_repository""")
def repository_current(spark, sf_dir):
    return current(spark, sf_dir).select("repo_id", "org_id", "name", "is_fork", "stargazers_count",
                                         "forks_count", ntz("observed_at"))


@query("w2_repository_current_view", CURRENT + """
select repo_id, org_id, name, is_fork, stargazers_count, forks_count, observed_at from current_repository""")
def repository_current_view(spark, sf_dir):
    return run_query(spark, """
        select repo_id, org_id, name, is_fork, stargazers_count, forks_count, cast(observed_at as timestamp_ntz) as observed_at
        from repository_current""", warehouse(spark, sf_dir))


MONTHLY = cte(*FACTS) + """, stacked as (
  select 'commit' as kind, repo_id, author_time as moment from commit_activity
  union all select 'issue', repo_id, created_at from issue
  union all select 'pull', repo_id, created_at from pull_request
), dated as (
  select kind, org_id, cast(date_trunc('month', moment) as timestamp) as month
  from stacked join repository using (repo_id) where moment is not null
)
"""
_MONTHLY_ROWS = """
select login, month, count(*) filter (where kind = 'commit') as commits, count(*) filter (where kind = 'issue') as issues,
  count(*) filter (where kind = 'pull') as pull_requests
from dated join organization using (org_id) group by login, month"""


@query("q3_stored_query_monthly", MONTHLY + _MONTHLY_ROWS)
@query("a10_monthly_activity", MONTHLY + _MONTHLY_ROWS)
def monthly_activity(spark, sf_dir):
    rows = V.organization_monthly_activity(*views(spark, sf_dir, *FACTS))
    return rows.withColumn("month", ntz("month"))


@query("w3_monthly_activity_view", MONTHLY + _MONTHLY_ROWS)
def monthly_activity_view(spark, sf_dir):
    return run_query(spark, """
        select login, cast(month as timestamp_ntz) as month, commits, issues, pull_requests
        from organization_monthly_activity""", warehouse(spark, sf_dir))


@query("f15_known_months", MONTHLY + """
select month, count(*) as entries from (select distinct kind, org_id, month from dated) d group by 1""")
def known_months(spark, sf_dir):
    commits, issues, pulls, repos, _ = views(spark, sf_dir, *FACTS)

    def months(rows, column):
        dated = rows.join(repos.select("repo_id", "org_id"), "repo_id")
        return dated.select("org_id", F.date_trunc("month", column).alias("month")).where("month is not null").distinct()

    stacked = months(commits, "author_time").unionByName(months(issues, "created_at")).unionByName(
        months(pulls, "created_at"))
    return stacked.groupBy(ntz("month")).agg(F.count(F.lit(1)).alias("entries"))


@query("u_all_union_of_aggregates", cte("commit_activity", "issue", "pull_request") + """
select 'commits' as kind, repo_id, count(*) as rows from commit_activity group by 2
union all select 'issues', repo_id, count(*) from issue group by 2
union all select 'pull_requests', repo_id, count(*) from pull_request group by 2""")
def union_of_aggregates(spark, sf_dir):
    def counted(kind, rows):
        return rows.groupBy("repo_id").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(kind).alias("kind"), "repo_id", "rows")

    commits, issues, pulls = views(spark, sf_dir, "commit_activity", "issue", "pull_request")
    return counted("commits", commits).unionByName(counted("issues", issues)).unionByName(counted("pull_requests", pulls))


CUTOFF = cte(*FACTS, "cutoff_target") + """, scoped as (
  select lower(o.login) as org_key, r.repo_id, r.is_fork, r.created_at from repository r join organization o using (org_id)
), measured as (
  select t.login, t.cutoff, coalesce(s.repos, 0) as repos, coalesce(s.original_repos, 0) as original_repos,
    coalesce(s.forked_repos, 0) as forked_repos, coalesce(c.n, 0) as commits, coalesce(i.n, 0) as issues, coalesce(p.n, 0) as pulls
  from cutoff_target t
  left join (select t.login, t.cutoff, count(*) as repos, count(*) filter (where not is_fork) as original_repos,
      count(*) filter (where is_fork) as forked_repos
    from cutoff_target t join scoped s on s.org_key = lower(t.login) where s.created_at < t.cutoff group by 1, 2) s using (login, cutoff)
  left join (select t.login, t.cutoff, count(*) as n from cutoff_target t join scoped s on s.org_key = lower(t.login)
    join commit_activity f using (repo_id) where coalesce(f.author_time, f.event_time) < t.cutoff group by 1, 2) c using (login, cutoff)
  left join (select t.login, t.cutoff, count(*) as n from cutoff_target t join scoped s on s.org_key = lower(t.login)
    join issue f using (repo_id) where f.created_at < t.cutoff group by 1, 2) i using (login, cutoff)
  left join (select t.login, t.cutoff, count(*) as n from cutoff_target t join scoped s on s.org_key = lower(t.login)
    join pull_request f using (repo_id) where f.created_at < t.cutoff group by 1, 2) p using (login, cutoff)
)
"""
_MEASURES = """
select *, round(ln(1 + pulls), 9) as pull_log, round(ln(1 + issues), 9) as issues_log,
  cast(pulls > 0 as int) as pull_dummy, cast(issues > 0 as int) as issues_dummy,
  cast(commits = 0 as int) as open_source_washer, cast(commits > 0 as int) as open_source_producer from measured"""


def all_measures(spark, sf_dir):
    targets, *facts = views(spark, sf_dir, "cutoff_target", *FACTS)
    commits, issues, pulls, repos, orgs = facts
    return measures.cutoff_measures(targets, orgs, repos, commits, issues, pulls)


@query("q2_measures_call", CUTOFF + _MEASURES)
@query("a12_cutoff_measures", CUTOFF + _MEASURES)
def cutoff_measures(spark, sf_dir):
    logs = {c: F.round(c, 9) for c in ("pull_log", "issues_log")}
    return all_measures(spark, sf_dir).withColumns(logs).withColumn("cutoff", ntz("cutoff"))


@query("j7_one_row_per_target", CUTOFF + """
select login, cutoff, repos, original_repos, forked_repos, commits, issues, pulls from measured""")
def one_row_per_target(spark, sf_dir):
    return all_measures(spark, sf_dir).select("login", ntz("cutoff"), *measures.COUNTS)


@query("f12_strictly_before_cutoff", cte("commit_activity") + """
select repo_id, sha, coalesce(author_time, event_time) as moment from commit_activity
where coalesce(author_time, event_time) < timestamp '1998-06-15'""")
def strictly_before_cutoff(spark, sf_dir):
    moment = F.coalesce("author_time", "event_time")
    cutoff = F.lit("1998-06-15").cast("timestamp")
    rows = filters.before_cutoff(view(spark, sf_dir, "commit_activity"), moment, cutoff)
    return rows.select("repo_id", "sha", moment.cast("timestamp_ntz").alias("moment"))


@query("f16_login_equality", cte("repository", "organization") + """
select o.login, r.repo_id from repository r join organization o using (org_id)
join supplier on lower(replace(s_name, 'Supplier', 'Customer')) = lower(o.login)""")
def login_equality(spark, sf_dir):
    repos, orgs = views(spark, sf_dir, "repository", "organization")
    names = base(spark, sf_dir, "supplier").select(
        F.lower(F.replace(F.col("s_name"), F.lit("Supplier"), F.lit("Customer"))).alias("key"))
    chosen = orgs.withColumn("key", F.lower("login")).join(names, "key", "left_semi")
    return repos.join(chosen, "org_id").select("login", "repo_id")


_SCREENED = """
select p_partkey as repo_id, p_name as name from part
where regexp_matches(lower(coalesce(p_name, '') || ' ' || coalesce(p_type, '')), 'red widget|small ring')"""


@query("f10_keyword_screen", _SCREENED)
def keyword_screen(spark, sf_dir):
    parts = base(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("repo_id"), F.col("p_name").alias("name"), F.col("p_type").alias("description"))
    return filters.keyword_matches(parts, PART_PHRASES).select("repo_id", "name")


@query("q3_stored_query_keywords", cte("repository", "organization") + """
select o.login, r.full_name, r.description from repository r join organization o using (org_id)
where regexp_matches(lower(coalesce(r.name, '') || ' ' || coalesce(r.description, '')), 'urgent|not specified')""")
def keyword_repositories(spark, sf_dir):
    return V.keyword_repositories(*views(spark, sf_dir, "repository", "organization"), ("urgent", "not specified"))


_ELIGIBLE = """
case when language = 'Python' then case when setup_py_present is null then null
  when not setup_py_present then false else dependency_count > 1 end else false end"""


@query("f11_setup_eligibility", cte("repository") + f"select repo_id, {_ELIGIBLE} as python_setup_eligible from repository")
def setup_eligibility(spark, sf_dir):
    eligible = X.setup_eligible(F.col("language"), F.col("setup_py_present"), F.col("dependency_count"))
    return view(spark, sf_dir, "repository").select("repo_id", eligible.alias("python_setup_eligible"))


def eligible_repositories(spark, sf_dir):
    eligible = X.setup_eligible(F.col("language"), F.col("setup_py_present"), F.col("dependency_count"))
    return view(spark, sf_dir, "repository").withColumn("python_setup_eligible", eligible)


_DEPENDENCIES = """, dependency as (
  select p_partkey as repo_id, replace(split_part(p_name, '>', 1), ' ', '-') as package_name,
    concat(replace(p_name, ' ', '_'), '>=', cast(p_size as varchar)) as requirement from part where p_size % 3 <> 0
  union select p_partkey, lower(regexp_extract(p_brand, '^[A-Za-z0-9_.-]+')), p_brand from part where p_size % 3 <> 0
), eligible as (
  select r.*, {} as python_setup_eligible from repository r
)
""".format(_ELIGIBLE)
_LISTED = cte("repository", "organization") + _DEPENDENCIES + """
select o.login, r.full_name, r.dependency_count,
  array_to_string(list(d.requirement order by d.package_name, d.requirement), ', ') as dependencies
from eligible r join organization o using (org_id) join dependency d using (repo_id)
where r.python_setup_eligible group by 1, 2, 3"""


@query("j8_eligible_dependencies", _LISTED)
@query("a9_ordered_list", _LISTED)
@query("q3_stored_query_setup_screen", _LISTED)
def eligible_dependencies(spark, sf_dir):
    found = setup_dependencies(view(spark, sf_dir, "setup_source"))
    rows = V.eligible_dependencies(eligible_repositories(spark, sf_dir), view(spark, sf_dir, "organization"), found)
    return rows.withColumn("dependencies", F.array_join("dependencies", ", "))


_PORTFOLIO = cte("repository", "organization", "repository_metric_snapshot") + LATEST + f"""
select o.login, r.name, case when r.is_fork then 'forked' else 'original' end as origin, r.created_at, r.license_spdx,
  r.stargazers_count, r.forks_count, {_ELIGIBLE} as python_setup_eligible
from current_repository r join organization o using (org_id)"""


@query("q3_stored_query_portfolio", _PORTFOLIO)
@query("a19_portfolio_listing", _PORTFOLIO)
def portfolio_listing(spark, sf_dir):
    repos = V.repository_current(eligible_repositories(spark, sf_dir), view(spark, sf_dir, "repository_metric_snapshot"))
    rows = V.portfolio_listing(repos, view(spark, sf_dir, "organization"))
    return rows.withColumn("created_at", ntz("created_at")).orderBy("login", "created_at")


@query("o2_top_repositories", CURRENT + """
select repo_id, name, stargazers_count from current_repository order by stargazers_count desc nulls last, repo_id limit 20""")
def top_repositories(spark, sf_dir):
    return V.top_repositories(current(spark, sf_dir)).select("repo_id", "name", "stargazers_count")


_DAILY = cte("archive_event") + """
select org_login, cast(date_trunc('day', created_at) as timestamp) as day, type as event_type, count(*) as events from archive_event group by 1, 2, 3"""


@query("q3_stored_query_daily", _DAILY)
@query("a13_daily_counts", _DAILY)
def daily_counts(spark, sf_dir):
    events = view(spark, sf_dir, "archive_event").withColumnRenamed("type", "event_type")
    return panels.daily_counts(events).withColumn("day", ntz("day"))


@query("u1_setup_dependencies", cte("repository") + _DEPENDENCIES + "select repo_id, package_name, requirement from dependency")
def dependencies(spark, sf_dir):
    return setup_dependencies(view(spark, sf_dir, "setup_source"))


@query("dist_sorted_pairs", cte("repository") + _DEPENDENCIES + """
select distinct package_name, requirement from dependency order by 1, 2""")
def sorted_pairs(spark, sf_dir):
    return dependencies(spark, sf_dir).select("package_name", "requirement").distinct().orderBy("package_name", "requirement")


@query("q1_read_only_sql", LOGIN_PANEL + """
select org_login, cast(sum(public_events) as bigint) as public_events, max(distinct_actors) as most_actors from panel group by 1""")
def read_only_sql(spark, sf_dir):
    return run_query(spark, """
        SELECT org_login, sum(public_events) AS public_events, max(distinct_actors) AS most_actors
        FROM organization_public_monthly GROUP BY org_login
    """, {"organization_public_monthly": login_panel(spark, sf_dir)})


@query("q4_key_violations", """
select 'unique(l_orderkey, l_linenumber)' as rule,
  concat('{"l_orderkey":', cast(l_orderkey as varchar), ',"l_linenumber":', cast(l_linenumber as varchar), '}') as subject,
  count(*) as rows
from lineitem group by l_orderkey, l_linenumber having count(*) > 1
union all
select 'not null', 'org_login', count(*) from lineitem where l_linenumber = 7""")
def key_violations(spark, sf_dir):
    lines = base(spark, sf_dir, "lineitem").withColumn(
        "org_login", F.when(F.col("l_linenumber") != 7, F.col("l_suppkey")))
    return merge.key_violations(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "org_login"])
