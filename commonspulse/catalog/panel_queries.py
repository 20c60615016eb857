"""Panels, period summaries and documents."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commonspulse import constants as C
from commonspulse.catalog.adapter import cte, ntz, raw_events, view
from commonspulse.catalog.registry import query
from commonspulse.functions import expressions as X
from commonspulse.operators import filters, panels, projections
from commonspulse.plans import documents
from commonspulse.plans.queries import run_query
from commonspulse.plans.warehouse import with_views

# Inclusive range that covers every event of the test tables.
FIRST, LAST = date(1995, 1, 1), date(2001, 12, 1)

LOGIN_PANEL = cte("raw_event") + """, bulk as (
  select lower(org_login) as org_login, cast(date_trunc('month', created_at) as date) as month, repo_id, actor_id, type,
    json_extract_string(payload, '$.action') as action, json_extract_string(payload, '$.ref_type') as ref_type,
    case when type = 'PushEvent' and json_type(payload, '$.commits') = 'ARRAY'
      then json_array_length(payload, '$.commits') else 0 end as commits
  from raw_event where org_login is not null and type in
    ('PushEvent', 'IssuesEvent', 'PullRequestEvent', 'CreateEvent', 'ForkEvent', 'WatchEvent', 'ReleaseEvent')
), panel as (
  select org_login, month, count(*) as public_events, count(distinct repo_id) as active_repositories,
    count(distinct actor_id) as distinct_actors,
    count(*) filter (where type = 'PushEvent') as push_events,
    cast(sum(commits) as bigint) as commits_in_pushes,
    count(*) filter (where type = 'IssuesEvent' and action = 'opened') as issues_opened,
    count(*) filter (where type = 'PullRequestEvent' and action = 'opened') as pull_requests_opened,
    count(*) filter (where type = 'CreateEvent' and ref_type = 'repository') as repositories_created,
    count(*) filter (where type = 'ForkEvent') as fork_events,
    count(*) filter (where type = 'WatchEvent' and action = 'started') as star_events,
    count(*) filter (where type = 'ReleaseEvent' and action = 'published') as release_events
  from bulk group by 1, 2
)
"""

TYPED = """, typed as (
  select event_id, type as event_type, actor_id, repo_id, try_cast(org_id as bigint) as event_org_id,
    case when type = 'ForkEvent' then try_cast(json_extract_string(payload, '$.forkee.owner.id') as bigint) end as fork_destination_org_id,
    case when json_type(payload, '$.action') not in ('OBJECT', 'ARRAY') then json_extract_string(payload, '$.action') end as event_action,
    json_extract_string(payload, '$.ref_type') as ref_type,
    case when type = 'PushEvent' then coalesce(try_cast(json_extract_string(payload, '$.size') as bigint),
      case when json_type(payload, '$.commits') = 'ARRAY' then cast(json_array_length(payload, '$.commits') as bigint) end, 0) else 0 end as commits_in_push,
    case when type = 'PullRequestEvent' then lower(json_extract_string(payload, '$.pull_request.merged')) end as pull_request_merged,
    cast(date_trunc('month', created_at) as date) as month
  from raw_event
), attributed as (
  select event_id, event_type, actor_id, repo_id, event_action, ref_type, commits_in_push, pull_request_merged, month,
    event_org_id as organization_id, 'repository_activity' as attribution_type from typed where event_org_id is not null
  union all
  select event_id, event_type, actor_id, repo_id, event_action, ref_type, commits_in_push, pull_request_merged, month,
    fork_destination_org_id, 'fork_destination' from typed where fork_destination_org_id is not null
)
"""

TARGET_PANEL = cte("raw_event", "target") + TYPED + """, panel as (
  select organization_id, month,
    count(*) filter (where own) as public_events,
    count(distinct case when own then repo_id end) as active_repositories,
    count(distinct case when own then actor_id end) as distinct_actors,
    count(*) filter (where own and event_type = 'PushEvent') as push_events,
    cast(coalesce(sum(commits_in_push) filter (where own and event_type = 'PushEvent'), 0) as bigint) as commits_in_pushes,
    count(*) filter (where own and event_type = 'IssuesEvent' and event_action = 'opened') as issues_opened,
    count(*) filter (where own and event_type = 'IssuesEvent' and event_action = 'closed') as issues_closed,
    count(*) filter (where own and event_type = 'IssueCommentEvent' and event_action = 'created') as issue_comments_created,
    count(*) filter (where own and event_type = 'PullRequestEvent' and event_action = 'opened') as pull_requests_opened,
    count(*) filter (where own and event_type = 'PullRequestEvent' and event_action = 'closed') as pull_requests_closed,
    count(*) filter (where own and event_type = 'PullRequestEvent' and event_action = 'closed' and pull_request_merged = 'true') as pull_requests_merged,
    count(*) filter (where own and event_type = 'CreateEvent' and ref_type = 'repository') as original_repositories_created,
    count(*) filter (where not own and event_type = 'ForkEvent') as forked_repositories_created,
    count(*) filter (where own and event_type = 'ForkEvent') as forks_received,
    count(*) filter (where own and event_type = 'WatchEvent' and event_action = 'started') as stars_received,
    count(*) filter (where own and event_type = 'ReleaseEvent' and event_action = 'published') as releases_published
  from (select *, attribution_type = 'repository_activity' as own from attributed
        where organization_id in (select organization_id from target)) a group by 1, 2
)
"""

MONTHS = """, months as (
  select cast(m as date) as month from generate_series(timestamp '1995-01-01', timestamp '2001-12-01', interval 1 month) g(m)
)
"""


def _dense(entity: str, key: str, metrics: tuple[str, ...]) -> str:
    """The zero-filled panel as a further WITH entry named dense."""
    filled = ", ".join(f"coalesce(p.{m}, 0) as {m}" for m in metrics)
    return MONTHS + f""", dense as (
  select e.{key}, x.month, {filled} from (select distinct {key} from {entity}) e cross join months x
  left join panel p on p.{key} = e.{key} and p.month = x.month
)
"""


def login_panel(spark, sf_dir) -> DataFrame:
    return panels.login_month_panel(raw_events(spark, sf_dir))


def target_panel(spark, sf_dir) -> DataFrame:
    return panels.target_month_panel(raw_events(spark, sf_dir), view(spark, sf_dir, "target"))


def dense_login_panel(spark, sf_dir) -> DataFrame:
    return panels.dense_panel(login_panel(spark, sf_dir), ["org_login"], C.LOGIN_PANEL_METRICS, FIRST, LAST)


query("a1_org_month_panel", LOGIN_PANEL + "select * from panel")(login_panel)
query("a2_target_month_panel", TARGET_PANEL + "select * from panel")(target_panel)
query("j6_dense_panel", LOGIN_PANEL + _dense("panel", "org_login", C.LOGIN_PANEL_METRICS) + "select * from dense")(
    dense_login_panel
)


@query("a3_conditional_counts", LOGIN_PANEL + """
select org_login, count(*) filter (where type = 'IssuesEvent' and action = 'opened') as opened,
  count(*) filter (where type = 'ReleaseEvent' and action = 'published') as published from bulk group by 1""")
def conditional_counts(spark, sf_dir):
    action = F.get_json_object("payload", "$.action")
    events = filters.with_org_login(filters.login_panel_types(raw_events(spark, sf_dir)))
    return events.groupBy(F.lower("org.login").alias("org_login")).agg(
        F.count_if((F.col("type") == "IssuesEvent") & (action == "opened")).alias("opened"),
        F.count_if((F.col("type") == "ReleaseEvent") & (action == "published")).alias("published"),
    )


@query("a4_distinct_counts", LOGIN_PANEL + """
select org_login, count(distinct repo_id) as repositories, count(distinct actor_id) as actors from bulk group by 1""")
def distinct_counts(spark, sf_dir):
    events = filters.with_org_login(filters.login_panel_types(raw_events(spark, sf_dir)))
    return events.groupBy(F.lower("org.login").alias("org_login")).agg(
        F.count_distinct("repo.id").alias("repositories"), F.count_distinct("actor.id").alias("actors")
    )


@query("a5_conditional_distinct", cte("raw_event") + TYPED + """
select organization_id, count(distinct case when attribution_type = 'repository_activity' then repo_id end) as own_repositories,
  count(distinct case when attribution_type = 'fork_destination' then repo_id end) as forked_repositories
from attributed group by 1""")
def conditional_distinct(spark, sf_dir):
    rows = panels.attribute_forks(projections.typed_events(raw_events(spark, sf_dir)))
    role = F.col("attribution_type")
    return rows.groupBy("organization_id").agg(
        F.count_distinct(F.when(role == C.ROLE_ACTIVITY, F.col("repo_id"))).alias("own_repositories"),
        F.count_distinct(F.when(role == C.ROLE_FORK_DESTINATION, F.col("repo_id"))).alias("forked_repositories"),
    )


@query("a6_commits_in_pushes", LOGIN_PANEL + """
select org_login, cast(sum(commits) as bigint) as commits from bulk group by 1""")
def commits_in_pushes(spark, sf_dir):
    events = filters.with_org_login(filters.login_panel_types(raw_events(spark, sf_dir)))
    commits = X.push_commits(F.col("type"), F.col("payload"))
    return events.groupBy(F.lower("org.login").alias("org_login")).agg(F.sum(commits).alias("commits"))


@query("a7_push_sizes", cte("raw_event") + TYPED + """
select event_org_id, cast(sum(commits_in_push) as bigint) as commits from typed group by 1""")
def push_sizes(spark, sf_dir):
    events = X.json_scalars(raw_events(spark, sf_dir), "payload", size="$.size")
    commits = X.push_size(F.col("type"), F.col("size"), F.col("payload"))
    return events.groupBy(X.as_bigint(F.col("org.id")).alias("event_org_id")).agg(F.sum(commits).alias("commits"))


_SUMS = ", ".join(f"cast(sum({m}) as bigint) as {m}" for m in C.LOGIN_ADDITIVE_METRICS)
_TOTALS = f"""
select org_login, min(month) as first_active_month, max(month) as last_active_month, {_SUMS} from panel group by 1"""


@query("a8_activity_totals", LOGIN_PANEL + _TOTALS)
def activity_totals(spark, sf_dir):
    return panels.activity_totals(login_panel(spark, sf_dir))


@query("w5_activity_totals_view", LOGIN_PANEL + _TOTALS)
def activity_totals_view(spark, sf_dir):
    return run_query(spark, "select * from organization_public_activity_totals",
                     with_views({"organization_public_monthly": login_panel(spark, sf_dir)}))


@query("a14_month_rollup", LOGIN_PANEL + """
select month, count(*) as organizations, cast(sum(public_events) as bigint) as public_events from panel group by 1""")
def month_rollup(spark, sf_dir):
    return panels.month_rollup(login_panel(spark, sf_dir))


@query("a15_period_totals", LOGIN_PANEL + _dense("panel", "org_login", C.LOGIN_PANEL_METRICS) +
       f"select org_login, {_SUMS} from dense group by 1")
def period_totals(spark, sf_dir):
    return panels.period_totals(dense_login_panel(spark, sf_dir), ["org_login"], C.LOGIN_ADDITIVE_METRICS)


@query("a16_activity_summary", LOGIN_PANEL + _dense("panel", "org_login", C.LOGIN_PANEL_METRICS) + """
select org_login, count(*) filter (where public_events > 0) as months_with_activity,
  cast(sum(active_repositories) as bigint) as sum_monthly_active_repositories,
  max(active_repositories) as max_monthly_active_repositories,
  cast(sum(distinct_actors) as bigint) as sum_monthly_distinct_actors,
  max(distinct_actors) as max_monthly_distinct_actors
from dense group by 1""")
def activity_summary(spark, sf_dir):
    return panels.activity_summary(dense_login_panel(spark, sf_dir), ["org_login"])


@query("f14_panel_month_range", LOGIN_PANEL + """
select org_login, month, public_events from panel where month between date '1996-03-01' and date '1998-11-01'""")
def panel_month_range(spark, sf_dir):
    rows = filters.months_between(login_panel(spark, sf_dir), date(1996, 3, 1), date(1998, 11, 1))
    return rows.select("org_login", "month", "public_events")


@query("o1_sorted_panel", LOGIN_PANEL + "select * from panel order by org_login, month")
def sorted_panel(spark, sf_dir):
    return login_panel(spark, sf_dir).orderBy("org_login", "month")


@query("o2_top_organizations", LOGIN_PANEL + f"""
select * from ({_TOTALS}) t order by public_events desc, org_login limit 100""")
def top_organizations(spark, sf_dir):
    return panels.top_organizations(activity_totals(spark, sf_dir))


@query("p11_panel_rows", LOGIN_PANEL + f"""
select org_login, month, {', '.join(C.LOGIN_PANEL_METRICS)}, 'gharchive_bigquery' as source from panel""")
def panel_rows(spark, sf_dir):
    return projections.panel_rows(login_panel(spark, sf_dir)).drop("collected_at")


@query("p10_typed_events", cte("raw_event") + TYPED + "select * from typed")
def typed_events(spark, sf_dir):
    return projections.typed_events(raw_events(spark, sf_dir))


@query("j5_fork_attribution", cte("raw_event") + TYPED + "select * from attributed")
def fork_attribution(spark, sf_dir):
    return panels.attribute_forks(projections.typed_events(raw_events(spark, sf_dir)))


TARGETED = cte("raw_event", "target") + TYPED + """
select * from attributed where organization_id in (select organization_id from target)"""


@query("f5_targeted_events", TARGETED)
def targeted_events(spark, sf_dir):
    return panels.targeted_events(projections.typed_events(raw_events(spark, sf_dir)), view(spark, sf_dir, "target"))


@query("j4_semi_join_targets", cte("raw_event", "target") + TYPED + """
select organization_id, attribution_type, count(*) as events from attributed
where organization_id in (select organization_id from target) group by 1, 2""")
def semi_join_targets(spark, sf_dir):
    rows = panels.attribute_forks(projections.typed_events(raw_events(spark, sf_dir)))
    return panels.of_targets(rows, view(spark, sf_dir, "target")).groupBy("organization_id", "attribution_type").agg(
        F.count(F.lit(1)).alias("events")
    )


@query("f2_login_panel_types", cte("raw_event") + """
select event_id, type from raw_event where type in
  ('PushEvent', 'IssuesEvent', 'PullRequestEvent', 'CreateEvent', 'ForkEvent', 'WatchEvent', 'ReleaseEvent')""")
def login_panel_types(spark, sf_dir):
    return filters.login_panel_types(raw_events(spark, sf_dir)).select(F.col("id").alias("event_id"), "type")


@query("f4_named_organizations", cte("raw_event") + """
select event_id, org_login from raw_event where org_login is not null""")
def named_organizations(spark, sf_dir):
    return filters.with_org_login(raw_events(spark, sf_dir)).select(
        F.col("id").alias("event_id"), F.col("org.login").alias("org_login")
    )


def _json_struct(pairs) -> str:
    return "{" + ", ".join(f"'{k}': {v}" for k, v in pairs) + "}"


def _list_of_months(metrics) -> str:
    item = _json_struct([("month", "strftime(month, '%Y-%m')"), *[(m, m) for m in metrics]])
    return f"list({item} order by month)"


_LOGIN_DOCUMENT = _json_struct([
    ("schema_version", "'1.0'"),
    ("organization", "{'login': org_login}"),
    ("period", "{'start': '1995-01', 'end': '2001-12', 'months': 84}"),
    ("source", "'GH Archive public events via BigQuery'"),
    ("coverage", "{'definition': 'Public events where GitHub supplied org.login', "
                 "'zero_filled_months': true, 'private_activity_included': false}"),
    ("totals", _json_struct([(m, f"cast(sum({m}) as bigint)") for m in C.LOGIN_ADDITIVE_METRICS])),
    ("monthly_activity_summary", _json_struct([
        ("months_with_activity", "count(*) filter (where public_events > 0)"),
        ("sum_monthly_active_repositories", "cast(sum(active_repositories) as bigint)"),
        ("max_monthly_active_repositories", "max(active_repositories)"),
        ("sum_monthly_distinct_actors", "cast(sum(distinct_actors) as bigint)"),
        ("max_monthly_distinct_actors", "max(distinct_actors)"),
    ])),
    ("monthly", _list_of_months(C.LOGIN_PANEL_METRICS)),
])

LOGIN_DOCUMENTS = LOGIN_PANEL + _dense("panel", "org_login", C.LOGIN_PANEL_METRICS) + f""", documents as (
  select org_login, cast(to_json({_LOGIN_DOCUMENT}) as varchar) as body from dense group by org_login
), named as (
  select org_login, body, case when trim(s, '-') = '' then 'unknown' else trim(s, '-') end as safe_login
  from (select *, regexp_replace(lower(org_login), '[^a-z0-9-]+', '-', 'g') as s from documents) d
)
"""


@query("w6_login_documents", LOGIN_DOCUMENTS + """
select org_login, substring(concat(safe_login, '__'), 1, 2) as shard, safe_login, body from named""")
def login_documents(spark, sf_dir):
    return documents.document_text(documents.login_documents(login_panel(spark, sf_dir), FIRST, LAST))


_TARGET_DOCUMENT = _json_struct([
    ("organization_id", "organization_id"),
    ("historical_login", "any_value(historical_login)"),
    ("period", "{'start': '1995-01', 'end': '2001-12', 'months': 84}"),
    ("source", "'GH Archive public monthly tables via a read-only BigQuery query'"),
    ("coverage", "{'public_activity_only': true, 'zero_filled_months': true, 'persistent_database_created': false}"),
    ("totals", _json_struct([(m, f"cast(sum({m}) as bigint)") for m in C.TARGET_ADDITIVE_METRICS])),
    ("monthly", _list_of_months(C.TARGET_PANEL_METRICS)),
])

TARGET_DENSE = TARGET_PANEL + _dense("target", "organization_id", C.TARGET_PANEL_METRICS)


@query("w7_target_documents", TARGET_DENSE + f"""
select organization_id, cast(to_json({_TARGET_DOCUMENT}) as varchar) as body
from dense join target using (organization_id) group by organization_id""")
def target_documents(spark, sf_dir):
    rows = documents.target_documents(view(spark, sf_dir, "target"), target_panel(spark, sf_dir), FIRST, LAST)
    return documents.document_text(rows)
