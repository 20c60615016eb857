"""Projections, filters, merges and loads of landed objects."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commonspulse import schemas
from commonspulse.catalog.adapter import archive_events, base, cte, ntz, once, raw_events, view
from commonspulse.catalog.landing import all_landed, landed
from commonspulse.catalog.registry import ORACLES, query
from commonspulse.operators import filters, merge, projections, search
from commonspulse.operators.dependencies import parsed_dependencies
from commonspulse.plans import landing_load
from commonspulse.sources import tables

# --- projections of archive events

_ENTITY = """
select event_id, type as event_type, actor_login, repo_id, repo_name as repo_full_name, org_login,
  json_extract_string(payload, '$.action') as action,
  try_cast(case when json_type(payload, '$.issue') = 'OBJECT' and cast(json_extract(payload, '$.issue') as varchar) <> '{}'
    then json_extract_string(payload, '$.issue.number') else json_extract_string(payload, '$.pull_request.number') end as int) as entity_number,
  created_at, payload, archive_hour from archive_event"""


@query("p1_event_rows", cte("archive_event") + _ENTITY)
def event_rows(spark, sf_dir):
    rows = projections.event_rows(archive_events(spark, sf_dir)).drop("collected_at")
    return rows.withColumn("created_at", ntz("created_at")).withColumn("archive_hour", ntz("archive_hour"))


COMMITS = """, pushed as (
  select repo_id, event_id, archive_hour, created_at, pos - 1 as position,
    json_extract(payload, '$.commits[' || cast(pos - 1 as varchar) || ']') as c
  from (select *, unnest(range(1, cast(json_array_length(payload, '$.commits') as bigint) + 1)) as pos
        from archive_event where type = 'PushEvent' and repo_id <> 0) x
), archive_commit as (
  select repo_id, json_extract_string(c, '$.sha') as sha, json_extract_string(c, '$.author.name') as author_name,
    json_extract_string(c, '$.author.email') as author_email, json_extract_string(c, '$.message') as message,
    'gharchive' as source, created_at as event_time, 'push_event' as timestamp_precision, archive_hour, event_id, position
  from pushed where json_extract_string(c, '$.sha') <> ''
)
"""


@query("p2_archive_commit_rows", cte("archive_event") + COMMITS + """
select repo_id, sha, author_name, author_email, message, source, event_time, timestamp_precision from archive_commit""")
def archive_commits(spark, sf_dir):
    rows = projections.archive_commit_rows(archive_events(spark, sf_dir))
    return rows.select("repo_id", "sha", "author_name", "author_email", "message", "source",
                       ntz("event_time"), "timestamp_precision")


# --- landed objects, written out again for the checks

OBJECTS = """with org_object as (
  select c_custkey as org_id, lower(c_name) as login, case when c_acctbal < 0 then 'User' else 'Organization' end as type,
    case when seen = 0 then c_name else c_name || ' II' end as name, case when seen = 0 then c_mktsegment end as description,
    c_nationkey as public_repos, timestamp '2015-01-01' as created_at,
    case when seen = 0 then timestamp '2024-01-01' else timestamp '2024-01-02' end as collected_at
  from (select *, 0 as seen from customer union all select *, 1 from customer where c_acctbal > 5000) c
), repo_object as (
  select o_orderkey as repo_id, o_custkey as org_id, concat('Repo-', o_orderkey) as name,
    concat('Customer#', lpad(cast(o_custkey as varchar), 9, '0'), '/Repo-', o_orderkey) as full_name,
    o_orderpriority as description, o_orderdate as created_at,
    case when o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM') then 'Python' else 'Go' end as language,
    case when o_orderstatus <> 'P' then 'MIT' end as license_spdx, o_orderstatus = 'F' as is_fork,
    case when o_orderstatus = 'F' then concat('up/Repo-', o_orderkey) end as parent_full_name,
    o_totalprice > 400000 as archived, false as disabled,
    cast(floor(o_totalprice / 1000) as int) as stargazers_count, cast(o_custkey % 100 as int) as forks_count
  from orders
), setup_object as (
  select p_partkey as repo_id, not (p_size % 5 = 0 or p_size % 7 = 0) as present, p_name, p_brand, p_size from part
), setup_pair as (
  select repo_id, replace(p_name, ' ', '-') as package_name, concat(replace(p_name, ' ', '_'), '>=', p_size) as requirement
  from setup_object where present
  union select repo_id, lower(regexp_extract(p_brand, '^[A-Za-z0-9_.-]+')), p_brand from setup_object where present
), setup_fact as (
  select s.repo_id, s.present, cast(count(d.requirement) as int) as n from setup_object s left join setup_pair d using (repo_id) group by 1, 2
), repo_row as (
  select r.*, coalesce(f.present, false) as setup_py_present, coalesce(f.n, 0) as dependency_count,
    language = 'Python' and coalesce(f.present, false) and coalesce(f.n, 0) > 1 as python_setup_eligible
  from repo_object r left join setup_fact f using (repo_id)
), commit_object as (
  select l_orderkey as repo_id, cast(l_linenumber as varchar) as sha,
    case when l_linenumber <> 2 then concat('dev-', lpad(cast(l_suppkey as varchar), 6, '0')) end as author_login,
    concat('Dev ', lpad(cast(l_suppkey as varchar), 6, '0')) as author_name, l_shipdate as author_time,
    l_shipdate as committer_time, concat('m-', lpad(cast(l_partkey as varchar), 9, '0')) as message,
    l_linenumber % 3 as parents_count, l_shipdate as collected_at
  from lineitem where l_returnflag = 'N'
), issue_object as (
  select l_orderkey * 10 + l_linenumber as issue_id, l_orderkey as repo_id, l_linenumber as number,
    concat('dev-', lpad(cast(l_suppkey as varchar), 6, '0')) as author_login,
    case when l_linenumber = 5 then '[]' else '["lead"]' end as assignee_logins,
    case when l_linestatus = 'F' then 'closed' else 'open' end as state, concat('t-', lpad(cast(l_partkey as varchar), 9, '0')) as title,
    case when l_linenumber = 6 then '[]' when l_linenumber = 1 then '["bug",null]' else '["bug","help"]' end as labels,
    cast(l_quantity as int) as comments_count, l_linestatus = 'F' as locked, l_shipdate as created_at
  from lineitem where l_returnflag = 'R'
), pull_object as (
  select l_orderkey * 10 + l_linenumber as pull_id, l_orderkey as repo_id, l_linenumber as number,
    concat('dev-', lpad(cast(l_suppkey as varchar), 6, '0')) as author_login,
    case when l_linestatus = 'F' then 'closed' else 'open' end as state, l_linenumber = 1 as draft,
    concat('t-', lpad(cast(l_partkey as varchar), 9, '0')) as title,
    case when l_linenumber <> 2 then concat('fork/', l_partkey) end as head_repo_full_name, concat('base/', l_orderkey) as base_repo_full_name,
    l_linenumber as commits_count, cast(l_quantity as int) as additions, 1 as deletions, 2 as changed_files, 3 as comments_count,
    l_shipdate as created_at
  from lineitem where l_returnflag = 'A'
)
"""

ORG_COLUMNS = ("org_id", "login", "name", "description", "public_repos", "created_at", "collected_at")
REPO_COLUMNS = ("repo_id", "org_id", "name", "full_name", "description", "created_at", "language", "license_spdx",
                "is_fork", "parent_full_name", "archived", "disabled", "setup_py_present", "dependency_count",
                "python_setup_eligible")
COMMIT_COLUMNS = ("repo_id", "sha", "author_login", "author_name", "author_time", "committer_time", "message",
                  "parents_count", "collected_at")
ISSUE_COLUMNS = ("issue_id", "repo_id", "number", "author_login", "assignee_logins", "state", "title", "labels",
                 "comments_count", "locked", "created_at")
PULL_COLUMNS = ("pull_id", "repo_id", "number", "author_login", "state", "draft", "title", "head_repo_full_name",
                "base_repo_full_name", "commits_count", "additions", "deletions", "changed_files", "comments_count",
                "created_at")


def shown(rows: DataFrame, columns) -> DataFrame:
    """The columns, with instants as plain timestamps and lists as JSON text."""
    kinds = dict(rows.dtypes)
    def show(c):
        if kinds[c] == "timestamp":
            return ntz(c)
        if kinds[c].startswith("array"):
            return F.to_json(c, {"ignoreNullFields": "false"}).alias(c)
        return F.col(c)
    return rows.select(*[show(c) for c in columns])


def pick(columns) -> str:
    return "select " + ", ".join(columns)


@query("p3_organization_rows", OBJECTS + pick(ORG_COLUMNS) + " from org_object")
def organization_rows(spark, sf_dir):
    return shown(projections.organization_rows(landed(spark, sf_dir, "organization")), ORG_COLUMNS)


@query("p4_repository_rows", OBJECTS + pick(REPO_COLUMNS) + " from repo_row")
def repository_rows(spark, sf_dir):
    files = landing_load.setup_files(landed(spark, sf_dir, "setup"))
    facts = parsed_dependencies(files.select("repo_id", "source", F.col("source").isNotNull().alias("setup_py_present")))
    counted = facts.select("repo_id", "setup_py_present", F.size("dependencies").alias("dependency_count"))
    rows = landed(spark, sf_dir, "repository").join(counted, "repo_id", "left").withColumns({
        "setup_py_present": F.coalesce("setup_py_present", F.lit(False)),
        "dependency_count": F.coalesce("dependency_count", F.lit(0)),
        "org_id": F.regexp_extract("target_login", "[0-9]+", 0).cast("bigint"),
    })
    return shown(projections.repository_rows(rows), REPO_COLUMNS)


@query("p5_repository_snapshots", OBJECTS + """
select repo_id, timestamp '2024-01-01' as observed_at, stargazers_count, forks_count, cast(null as int) as watchers_count from repo_object""")
def repository_snapshots(spark, sf_dir):
    rows = projections.snapshot_rows(landed(spark, sf_dir, "repository"))
    return shown(rows, ["repo_id", "observed_at", "stargazers_count", "forks_count", "watchers_count"])


@query("p6_commit_rows", OBJECTS + pick(COMMIT_COLUMNS) + " from commit_object")
def commit_rows(spark, sf_dir):
    return shown(projections.commit_rows(landed(spark, sf_dir, "commit")), COMMIT_COLUMNS)


@query("p7_issue_rows", OBJECTS + pick(ISSUE_COLUMNS) + " from issue_object")
def issue_rows(spark, sf_dir):
    return shown(projections.issue_rows(landed(spark, sf_dir, "issue")), ISSUE_COLUMNS)


@query("p8_pull_rows", OBJECTS + pick(PULL_COLUMNS) + " from pull_object")
def pull_rows(spark, sf_dir):
    return shown(projections.pull_rows(landed(spark, sf_dir, "pull")), PULL_COLUMNS)


_HITS = OBJECTS + """
select * from (select concat('language:', language) as query, repo_id,
    cast(row_number() over (partition by language order by created_at desc, repo_id) as int) as rank, full_name,
    split_part(full_name, '/', 1) as owner_login, 'Organization' as owner_type from repo_object) h where rank <= {}"""


def search_results(spark, sf_dir) -> DataFrame:
    rows = landed(spark, sf_dir, "repository")
    return rows.withColumn("query", F.concat(F.lit("language:"), F.col("o.language")))


@query("p9_search_hits", _HITS.format("rank"))
def search_hits(spark, sf_dir):
    return search.ranked_hits(search_results(spark, sf_dir)).drop("matched_at", "raw")


@query("o3_ranked_hits", _HITS.format(100))
def ranked_hits(spark, sf_dir):
    return search.ranked_hits(search_results(spark, sf_dir), 100).drop("matched_at", "raw")


@query("p12_dependency_rows", OBJECTS + """
select repo_id, package_name, requirement, 'setup.py' as source from setup_pair""")
def dependency_rows(spark, sf_dir):
    files = landing_load.setup_files(landed(spark, sf_dir, "setup"))
    parsed = parsed_dependencies(files.select("repo_id", "source"))
    return projections.dependency_rows(parsed).drop("collected_at")


# --- filters

@query("f1_archive_types", cte("raw_event") + """
select event_id, type from raw_event where type in ('PushEvent', 'IssuesEvent', 'PullRequestEvent', 'CreateEvent', 'ForkEvent')""")
def archive_types(spark, sf_dir):
    return filters.archive_types(raw_events(spark, sf_dir)).select(F.col("id").alias("event_id"), "type")


@query("f3_organization_match", cte("archive_event") + """
select event_id, archive_hour, repo_name, org_login from archive_event
where lower(repo_name) like 'acme-7/%' or lower(org_login) = 'acme-7'""")
def organization_match(spark, sf_dir):
    rows = filters.of_organization(archive_events(spark, sf_dir), "ACME-7")
    return rows.select(F.col("id").alias("event_id"), ntz("archive_hour"), F.col("repo.name").alias("repo_name"),
                       F.col("org.login").alias("org_login"))


@query("f3_organizations_match", cte("archive_event") + """
select 'acme-' || cast(s_suppkey as varchar) as matched_org, event_id, archive_hour
from archive_event join supplier on split_part(lower(repo_name), '/', 1) = 'acme-' || cast(s_suppkey as varchar)
  or lower(org_login) = 'acme-' || cast(s_suppkey as varchar)""")
def organizations_match(spark, sf_dir):
    logins = base(spark, sf_dir, "supplier").select(F.concat(F.lit("Acme-"), F.col("s_suppkey")).alias("login"))
    rows = filters.of_organizations(archive_events(spark, sf_dir), logins)
    return rows.select("matched_org", F.col("id").alias("event_id"), ntz("archive_hour"))


SINCE, UNTIL = datetime(1996, 3, 15), datetime(2000, 6, 1)


@query("f6_observation_window", OBJECTS + """
select issue_id, created_at from issue_object where created_at >= timestamp '1996-03-15' and created_at <= timestamp '2000-06-01'""")
def observation_window(spark, sf_dir):
    rows = filters.in_window(landed(spark, sf_dir, "issue"), SINCE, UNTIL, "o.created_at")
    return shown(rows.select(F.col("o.id").alias("issue_id"), F.col("o.created_at").alias("created_at")),
                 ["issue_id", "created_at"])


@query("f7_issues_only", OBJECTS + "select issue_id, number from issue_object where number not in (3, 4)")
def issues_only(spark, sf_dir):
    rows = filters.without_pull_requests(landed(spark, sf_dir, "issue"))
    return rows.select(F.col("o.id").alias("issue_id"), F.col("o.number").alias("number"))


@query("f8_repository_selection", OBJECTS + """
select repo_id, name from repo_object left join part on p_partkey = repo_id
where not archived and not is_fork and (p_partkey is null or p_type = 'ECONOMY' and lower(name) = 'repo-' || cast(p_partkey as varchar))""")
def repository_selection(spark, sf_dir):
    """Rows with a list that has their name, rows with one that has not, and rows without a list, which all pass."""
    lists = base(spark, sf_dir, "part").select(F.col("p_partkey").alias("repo_id"), F.array(F.when(
        F.col("p_type") == "ECONOMY", F.concat(F.lit("REPO-"), F.col("p_partkey"))).otherwise(F.lit("other"))).alias("names"))
    rows = landed(spark, sf_dir, "repository").join(lists, "repo_id", "left")
    chosen = filters.select_repositories(rows, F.col("names"), False, False, prefix="o.")
    return chosen.select(F.col("o.id").alias("repo_id"), F.col("o.name").alias("name"))


@query("f9_commit_window", OBJECTS + """
select repo_id, sha, committer_time from commit_object where committer_time between timestamp '1996-03-15' and timestamp '2000-06-01'""")
def commit_window(spark, sf_dir):
    rows = projections.commit_rows(landed(spark, sf_dir, "commit"))
    return shown(filters.in_window(rows, SINCE, UNTIL, "committer_time"), ["repo_id", "sha", "committer_time"])


@query("f13_organization_accounts", OBJECTS + """
select type, count(*) as objects, count(distinct login) as logins from org_object group by 1""")
def organization_accounts(spark, sf_dir):
    objects = landed(spark, sf_dir, "organization")
    both = filters.organizations_only(objects).unionByName(filters.rejected_accounts(objects))
    return both.groupBy(F.col("o.type").alias("type")).agg(
        F.count(F.lit(1)).alias("objects"), F.count_distinct("o.login").alias("logins"))


# --- merges

_UPSERTED = """
with existing as (select c_custkey as org_id, lower(c_name) as login, c_name as name, c_mktsegment as description from customer),
incoming as (select s_suppkey * 20 as org_id, lower(s_name) as login, case when s_nationkey % 2 = 0 then s_name end as name from supplier)
select org_id, case when i.org_id is not null then i.login else e.login end as login,
  case when i.org_id is not null then i.name else e.name end as name,
  case when e.org_id is null then 'unknown' else e.description end as description
from existing e full outer join incoming i using (org_id)"""


def _upsert_sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    existing = base(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("org_id"), F.lower("c_name").alias("login"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("description"))
    incoming = base(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") * 20).alias("org_id"), F.lower("s_name").alias("login"),
        F.when(F.col("s_nationkey") % 2 == 0, F.col("s_name")).alias("name"))
    return existing, incoming


@query("k1_upsert", _UPSERTED)
def upsert(spark, sf_dir):
    return merge.upsert(*_upsert_sides(spark, sf_dir), ["org_id"], {"description": "unknown"})


@query("k1_merge_in_place", _UPSERTED)
def merge_in_place(spark, sf_dir):
    """The same upsert on a stored table, in three increments of which the second comes twice."""
    schema, buckets = "org_id bigint, login string, name string, description string", 64

    def write(path: str) -> None:
        existing, incoming = _upsert_sides(spark, sf_dir)
        tables.write_bucketed(existing, path, ["org_id"], buckets)
        for part in (0, 1, 1, 2):
            tables.merge_into(spark, path, schema, incoming.where(F.pmod(F.xxhash64("login"), F.lit(3)) == part), ["org_id"], buckets, defaults={"description": "unknown"})

    return tables.read_bucketed(spark, once(spark, sf_dir, "merged-table", write), schema).drop(tables.BUCKET)


def lines(spark, sf_dir) -> DataFrame:
    return base(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("repo_id"), F.col("l_linenumber").cast("string").alias("sha"),
        F.col("l_partkey").alias("part"), F.col("l_shipdate").alias("moment"), "l_linestatus")


@query("k2_insert_ignore", """
with l as (select l_orderkey as repo_id, cast(l_linenumber as varchar) as sha, l_partkey as part, l_shipdate as moment, l_linestatus from lineitem),
first_rows as (select *, row_number() over (partition by l_linestatus, repo_id, sha order by moment, part) as n from l)
select repo_id, sha, part, moment, l_linestatus from first_rows where n = 1 and l_linestatus = 'F'
union all
select repo_id, sha, part, moment, l_linestatus from first_rows f where n = 1 and l_linestatus = 'O'
  and not exists (select 1 from first_rows e where e.l_linestatus = 'F' and e.repo_id = f.repo_id and e.sha = f.sha)""")
def insert_ignore(spark, sf_dir):
    rows, keys, order = lines(spark, sf_dir), ["repo_id", "sha"], ["moment", "part"]
    existing = merge.first_per_key(rows.where("l_linestatus = 'F'"), keys, order)
    return merge.insert_ignore(existing, rows.where("l_linestatus = 'O'"), keys, order)


@query("k3_bulk_upsert", """
with l as (select l_suppkey as org_id, l_orderkey, l_partkey, l_shipdate,
    row_number() over (partition by l_suppkey order by l_shipdate desc, l_orderkey desc, l_partkey desc) as n from lineitem)
select coalesce(s.s_suppkey, l.org_id) as org_id, s.s_name as login, l.l_orderkey as last_order, l.l_partkey as last_part
from (select * from l where n = 1) l full outer join supplier s on s.s_suppkey = l.org_id""")
def bulk_upsert(spark, sf_dir):
    existing = base(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("org_id"), F.col("s_name").alias("login"),
        F.lit(None).cast("bigint").alias("last_order"), F.lit(None).cast("bigint").alias("last_part"))
    rows = base(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("org_id"), F.col("l_orderkey").alias("last_order"),
        F.col("l_partkey").alias("last_part"), "l_shipdate")
    return merge.upsert_many(existing, rows, ["org_id"], ["l_shipdate", "last_order", "last_part"])


@query("w1_commit_reconciliation", """
with l as (select l_orderkey as repo_id, cast(l_linenumber as varchar) as sha, l_partkey as part, l_shipdate as moment, l_returnflag as kind from lineitem),
ranked as (select *, row_number() over (partition by kind, repo_id, sha order by
    case when kind = 'N' then moment end desc, case when kind = 'N' then part end desc,
    case when kind <> 'N' then moment end, case when kind <> 'N' then part end) as n from l),
best as (select *, row_number() over (partition by repo_id, sha order by case kind when 'N' then 1 when 'R' then 2 else 3 end) as b
  from ranked where n = 1)
select repo_id, sha, part, case when kind = 'N' then null else moment end as event_time,
  case when kind = 'N' then 'github_api' when kind = 'R' then 'stored' else 'gharchive' end as source from best where b = 1""")
def commit_reconciliation(spark, sf_dir):
    rows = base(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("repo_id"), F.col("l_linenumber").cast("string").alias("sha"),
        F.col("l_partkey").alias("part"), F.col("l_shipdate").alias("event_time"), "l_returnflag")

    def kind(flag: str, source: str) -> DataFrame:
        return rows.where(F.col("l_returnflag") == flag).drop("l_returnflag").withColumn("source", F.lit(source))

    stored = merge.first_per_key(kind("R", "stored"), ["repo_id", "sha"], ["event_time", "part"])
    api = kind("N", "github_api").withColumn("collected", F.col("event_time")).withColumn(
        "event_time", F.lit(None).cast("timestamp_ntz"))
    return merge.reconcile_commits(stored, api, kind("A", "gharchive"), ["collected", "part"], ["event_time", "part"])


# --- load of everything that landed

TARGETS = """, wanted as (
  select c_custkey as org_id, c_nationkey, case when c_nationkey < 10 then timestamp '1996-01-01' end as since
  from customer where c_acctbal >= 0
), chosen as (
  select r.*, w.since from repo_row r join wanted w using (org_id)
  where not r.archived and (w.c_nationkey <> 3 or r.repo_id = r.org_id)
)
"""
_WINDOW = """{time} <= timestamp '2000-06-01' and (c.since is null or {time} >= c.since)"""


def loaded(spark, sf_dir, kept: dict[str, DataFrame] | None = None, keep: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    targets = base(spark, sf_dir, "customer").select(
        F.col("c_name").alias("login"),
        F.when(F.col("c_nationkey") == 3, F.array(F.concat(F.lit("REPO-"), F.col("c_custkey")))).alias("repositories"),
        F.when(F.col("c_nationkey") < 10, F.lit(datetime(1996, 1, 1))).alias("since"),
    )
    stored = {name: spark.createDataFrame([], schemas.table_schema(name)) for name in schemas.TABLES}
    for name, rows in (kept or {}).items():
        stored[name] = stored[name].unionByName(rows, allowMissingColumns=True)
    return landing_load.load_landing(all_landed(spark, sf_dir), targets, stored, until=UNTIL, include_archived=False, keep=keep)


def _last(columns, source: str, key: str, order: str) -> str:
    names = ", ".join(columns)
    return f"select {names} from (select *, row_number() over (partition by {key} order by {order}) as n from ({source}) s) t where n = 1"


query("w8_load_organizations", OBJECTS + _last(
    ORG_COLUMNS, "select * from org_object where type = 'Organization'", "org_id", "collected_at desc"))(
    lambda spark, sf_dir: shown(loaded(spark, sf_dir)["organization"], ORG_COLUMNS))
query("w8_load_repositories", OBJECTS + TARGETS + pick(REPO_COLUMNS) + " from chosen")(
    lambda spark, sf_dir: shown(loaded(spark, sf_dir)["repository"], REPO_COLUMNS))
query("w8_load_snapshots", OBJECTS + TARGETS + "select repo_id, stargazers_count, forks_count from chosen")(
    lambda spark, sf_dir: shown(loaded(spark, sf_dir)["repository_metric_snapshot"],
                                ["repo_id", "stargazers_count", "forks_count"]))
query("w8_load_dependencies", OBJECTS + TARGETS + """
select repo_id, package_name, requirement from setup_pair where repo_id in (select repo_id from chosen)""")(
    lambda spark, sf_dir: shown(loaded(spark, sf_dir)["setup_dependency"], ["repo_id", "package_name", "requirement"]))
query("w8_load_commits", OBJECTS + TARGETS + _last(
    COMMIT_COLUMNS, "select x.* from commit_object x join chosen c using (repo_id) where " + _WINDOW.format(time="x.committer_time"),
    "repo_id, sha", "collected_at desc, author_login desc nulls last, author_name desc, message desc"))(
    lambda spark, sf_dir: shown(loaded(spark, sf_dir)["commit_activity"], COMMIT_COLUMNS))
query("w8_load_issues", OBJECTS + TARGETS + _last(
    ISSUE_COLUMNS, "select x.* from issue_object x join chosen c using (repo_id) where x.number not in (3, 4) and "
    + _WINDOW.format(time="x.created_at"), "issue_id", "created_at desc, author_login desc, state desc, title desc"))(
    lambda spark, sf_dir: shown(loaded(spark, sf_dir)["issue"], ISSUE_COLUMNS))
query("w8_load_pull_requests", OBJECTS + TARGETS + _last(
    PULL_COLUMNS, "select x.* from pull_object x join chosen c using (repo_id) where " + _WINDOW.format(time="x.created_at"),
    "pull_id", "created_at desc, author_login desc, state desc, title desc"))(
    lambda spark, sf_dir: shown(loaded(spark, sf_dir)["pull_request"], PULL_COLUMNS))


# --- the same load over rows that are stored already

def _over(check: str, columns, stored: str, keys: str) -> str:
    """Loaded rows whole, nulls included, and the stored rows that nothing was loaded for."""
    names = ", ".join(columns)
    return f"""
with loaded as ({ORACLES[check]}), stored as ({stored})
select {names} from loaded union all select {names} from stored anti join loaded using ({keys})"""


# Half of the customers, their orders and their lines; the lines repeat keys, the stored rows do not.
STORED = {
    "organization": "select c_custkey as org_id, concat('stored-', c_custkey) as login, cast(null as string) as name, 'kept' as description from customer where c_custkey % 2 = 0",
    "repository": "select o_orderkey as repo_id, 0L as org_id, 'kept' as name, concat('kept/', o_orderkey) as full_name, 'old' as license_spdx, true as archived from orders where o_custkey % 2 = 0",
    "commit_activity": "select distinct l_orderkey as repo_id, cast(l_linenumber as string) as sha, 'stored' as author_login, 'kept' as message, 'gharchive' as source, timestamp'2001-01-01' as event_time from lineitem where l_suppkey % 2 = 0 and l_returnflag <> 'A'",
    "issue": "select distinct l_orderkey * 10 + l_linenumber as issue_id, l_orderkey as repo_id, l_linenumber as number, 'kept' as title, 'old reason' as state_reason from lineitem where l_returnflag <> 'A' and l_linenumber % 2 = 0",
}
_SHOWN = {
    "organization": ("w8_load_organizations", ("org_id", "login", "name", "description"), "org_id"),
    "repository": ("w8_load_repositories", ("repo_id", "org_id", "name", "full_name", "license_spdx", "archived"), "repo_id"),
    "commit_activity": ("w8_load_commits", ("repo_id", "sha", "author_login", "message"), "repo_id, sha"),
    "issue": ("w8_load_issues", ("issue_id", "repo_id", "number", "title"), "issue_id"),
}


def over_stored(spark, sf_dir, name: str) -> DataFrame:
    for table in ("customer", "orders", "lineitem"):
        base(spark, sf_dir, table).createOrReplaceTempView(table)
    kept = {table: spark.sql(sql) for table, sql in STORED.items()}
    return shown(loaded(spark, sf_dir, kept)[name], _SHOWN[name][1])


for _name, (_check, _columns, _keys) in _SHOWN.items():
    query(f"w8_over_stored_{_name}", _over(_check, _columns, STORED[_name].replace("0L", "0"), _keys))(
        lambda spark, sf_dir, name=_name: over_stored(spark, sf_dir, name))
