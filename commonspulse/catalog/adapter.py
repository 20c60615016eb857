"""The given test tables in the shapes the operators read.

``VIEWS`` holds SQL that both Spark and the checking engine run, so a query and
its check start from the same rows.  It reads whole tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commonspulse.session import bound_tasks, pin_utc, scratch_dir
from commonspulse.sources.archive import write_month_table

# Schemas of the given tables, so that opening one reads no file.
BASE_TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

VIEWS = {
    # Nine event types, nullable mixed-case organizations, JSON payloads, replayed ids.
    "raw_event": """
select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as event_id,
  case l_orderkey % 9 when 0 then 'PushEvent' when 1 then 'IssuesEvent' when 2 then 'PullRequestEvent'
    when 3 then 'CreateEvent' when 4 then 'ForkEvent' when 5 then 'WatchEvent' when 6 then 'ReleaseEvent'
    when 7 then 'IssueCommentEvent' else 'GollumEvent' end as type,
  l_orderkey % 500 as actor_id,
  l_partkey as repo_id,
  concat('Org-', cast(l_suppkey % 40 as string), '/r', cast(l_partkey as string)) as repo_name,
  case when l_linenumber = 7 then null else cast(l_suppkey as string) end as org_id,
  case when l_linenumber = 7 then null when l_linestatus = 'F' then concat('ORG-', cast(l_suppkey as string))
    else concat('org-', cast(l_suppkey as string)) end as org_login,
  l_shipdate as created_at,
  case l_orderkey % 9
    when 0 then concat('{', case when l_linestatus = 'F' then concat('"size":', cast(cast(l_quantity as bigint) as string), ',') else '' end,
      '"commits":', case when l_linenumber = 6 then '{"sha":"x"}' when l_linenumber = 5 then '[]' else
      concat('[{"sha":"', cast(l_partkey as string), '"}',
      case when l_linenumber > 3 then concat(',{"sha":"', cast(l_suppkey as string), '"}') else '' end, ']') end, '}')
    when 1 then concat('{"action":"', case l_returnflag when 'R' then 'opened' when 'A' then 'closed' else 'reopened' end,
      '","issue":{"number":', cast(l_linenumber as string), '}}')
    when 2 then concat('{"action":"', case l_returnflag when 'R' then 'opened' else 'closed' end,
      '","pull_request":{"number":', cast(l_linenumber as string), ',"merged":', case when l_linestatus = 'F' then 'true' else 'false' end, '}}')
    when 3 then concat('{"ref_type":"', case l_returnflag when 'R' then 'repository' when 'A' then 'branch' else 'tag' end, '"}')
    when 4 then concat('{"forkee":{"owner":{"id":', cast(l_partkey % 120 as string), '}}}')
    when 5 then '{"action":"started"}'
    when 6 then concat('{"action":"', case l_linestatus when 'F' then 'published' else 'edited' end, '"}')
    when 7 then '{"action":"created"}' else '{"action":{"name":"edited"},"ref_type":null}' end as payload
from lineitem""",
    # Archive hours with replays one hour later, commits without sha and unnamed repositories.
    "archive_event": """
select concat('e', cast(event_id as string)) as event_id,
  case event_id % 7 when 1 then 'IssuesEvent' when 2 then 'PullRequestEvent' when 3 then 'CreateEvent'
    when 4 then 'ForkEvent' when 5 then 'WatchEvent' else 'PushEvent' end as type,
  concat('User-', cast(user_id as string)) as actor_login,
  user_id as actor_id,
  user_id % 300 as repo_id,
  concat(case when event_id % 2 = 0 then 'Acme-' else 'ACME-' end, cast(user_id % 40 as string), '/r', cast(user_id % 300 as string)) as repo_name,
  case when event_type = 'view' then null else concat('Acme-', cast(event_id % 45 as string)) end as org_login,
  ts as created_at,
  date_trunc('hour', ts) + (case when replay = 1 then interval '1' hour else interval '0' hour end) as archive_hour,
  case event_id % 7
    when 1 then concat('{"action":"', event_type, '","issue":{"number":', cast(user_id as string), '}}')
    when 2 then concat('{"action":"opened","issue":{},"pull_request":{"number":', cast(user_id as string), '}}')
    when 3 then '{"ref_type":"repository"}' when 4 then '{"forkee":{"owner":{"id":7}}}' when 5 then '{"action":"started"}'
    else concat('{"commits":[{"sha":"c', cast(event_id % 4000 as string), '","message":"m', cast(event_id + replay as string),
      '","author":{"name":"', event_type, '","email":"a@x"}},{"sha":"","message":"none"},{"sha":"u', cast(user_id as string), '","message":"second"}]}') end as payload
from (select *, 0 as replay from events union all select *, 1 as replay from events where event_type = 'error') e""",
    "organization": """
select c_custkey as org_id, lower(c_name) as login, c_mktsegment as description from customer""",
    "repository": """
select o_orderkey as repo_id, o_custkey as org_id, concat('repo-', cast(o_orderkey as string)) as name,
  concat('org/repo-', cast(o_orderkey as string)) as full_name,
  o_orderpriority as description, o_orderdate as created_at, o_orderstatus = 'F' as is_fork,
  case when o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM') then 'Python' else 'Go' end as language,
  case o_orderkey % 3 when 0 then null when 1 then true else false end as setup_py_present,
  cast(o_orderkey % 4 as int) as dependency_count,
  case when o_orderstatus = 'P' then null else 'MIT' end as license_spdx
from orders""",
    "commit_activity": """
select l_orderkey as repo_id, cast(l_linenumber as string) as sha,
  case when l_linestatus = 'F' then l_shipdate end as author_time,
  case when l_linestatus = 'F' then null else l_shipdate end as event_time,
  case when l_linestatus = 'F' then 'github_api' else 'gharchive' end as source,
  case when l_linestatus = 'F' then 'commit' else 'push_event' end as timestamp_precision,
  l_shipdate as collected_at, l_partkey
from lineitem where l_returnflag = 'N'""",
    "issue": """
select l_orderkey as repo_id, l_linenumber as number, l_shipdate as created_at from lineitem where l_returnflag = 'R'""",
    "pull_request": """
select l_orderkey as repo_id, l_linenumber as number, l_shipdate as created_at from lineitem where l_returnflag = 'A'""",
    "repository_metric_snapshot": """
select user_id as repo_id, ts as observed_at, cast(floor(value) as int) as stargazers_count,
  cast(event_id % 1000 as int) as forks_count
from events""",
    "setup_source": """
select p_partkey as repo_id,
  case when p_size % 3 = 0 then 'setup(install_requires=lines_of(wanted))'
    else concat('from setuptools import setup', chr(10), 'reqs = ["', replace(p_name, ' ', '_'), '>=', cast(p_size as string), '", "', p_brand, '"]',
      chr(10), 'setup(name="x", install_requires=reqs)') end as source
from part""",
    # Organizations to measure: every event organization, under its login.
    "target": """
select s_suppkey as organization_id, case when s_acctbal < 0 then null else s_name end as historical_login from supplier""",
    # Every organization and, as logins nobody stored, every supplier; one cutoff lies
    # within a day.
    "cutoff_target": """
select upper(c_name) as login, timestamp '1996-01-01 00:00:00' as cutoff from customer
union all select upper(c_name), timestamp '1998-06-15 12:30:00' from customer
union all select upper(c_name), timestamp '2001-01-01 00:00:00' from customer
union all select s_name, timestamp '1996-01-01 00:00:00' from supplier
union all select s_name, timestamp '1998-06-15 12:30:00' from supplier""",
}


def cte(*names: str) -> str:
    """The named views as a WITH clause."""
    return "with " + ",\n".join(f"{n} as ({VIEWS[n]})" for n in names) + "\n"


# Opened tables and views, so that queries share their plans.
_opened: dict[tuple[str, str, str], DataFrame] = {}


def _shared(spark: SparkSession, sf_dir: str, name: str, make) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _opened:
        _opened[key] = make()
    return _opened[key]


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    pin_utc(spark)
    bound_tasks(spark)

    def opened() -> DataFrame:
        return spark.read.schema(BASE_TABLES[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))

    return _shared(spark, sf_dir, f"{name}.parquet", opened)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One adapter view; timestamps become instants in UTC."""
    def made() -> DataFrame:
        for table in BASE_TABLES:
            if table in VIEWS[name]:
                base(spark, sf_dir, table).createOrReplaceTempView(table)
        rows = spark.sql(VIEWS[name])
        moments = {c: F.col(c).cast("timestamp") for c, t in rows.dtypes if t == "timestamp_ntz"}
        return rows.withColumns(moments) if moments else rows

    pin_utc(spark)
    return _shared(spark, sf_dir, name, made)


def views(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [view(spark, sf_dir, n) for n in names]


def _nested(flat: DataFrame, *more: str) -> DataFrame:
    login = "actor_login" if "actor_login" in flat.columns else None
    org_id = F.col("org_id") if "org_id" in flat.columns else F.lit(None).cast("string")
    org = F.struct(org_id.alias("id"), F.col("org_login").alias("login"))
    return flat.select(
        F.col("event_id").alias("id"), "type", "created_at",
        F.struct(F.col("actor_id").alias("id"),
                 (F.col(login) if login else F.lit(None).cast("string")).alias("login")).alias("actor"),
        F.struct(F.col("repo_id").alias("id"), F.col("repo_name").alias("name")).alias("repo"),
        F.when(F.col("org_login").isNotNull(), org).alias("org"),
        "payload", *more,
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nested(view(spark, sf_dir, "raw_event"))


def archive_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nested(view(spark, sf_dir, "archive_event"), "archive_hour")


def ntz(column: str) -> F.Column:
    """An instant as the plain timestamp the checking engine shows."""
    return F.col(column).cast("timestamp_ntz").alias(column)


# Derived files are written once per session and input folder.
_written: dict[tuple[str, str, str], str] = {}


def once(spark: SparkSession, sf_dir: str, purpose: str, write) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, purpose)
    if key not in _written:
        path = scratch_dir(spark, purpose)
        write(path)
        _written[key] = path
    return _written[key]


def archive_landing(spark: SparkSession, sf_dir: str) -> str:
    """Hourly gzip JSON files made from ``archive_event``, with broken lines in between."""
    def write(path: str) -> None:
        events = archive_events(spark, sf_dir)
        plain = F.to_json(F.struct("id", "type", "created_at", "actor", "repo", "org"),
                          {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
        line = F.concat(F.expr("substring(head, 1, length(head) - 1)"), F.lit(',"payload":'), F.col("payload"), F.lit("}"))
        lines = events.withColumn("head", plain).select(
            F.concat_ws("-", F.date_format("archive_hour", "yyyy-MM-dd"), F.hour("archive_hour")).alias("hour"),
            line.alias("value"), F.col("type"),
        )
        broken = lines.where("type = 'WatchEvent'").withColumn("value", F.expr("substring(value, 1, 40)"))
        (
            lines.unionByName(broken).drop("type")
            .repartition(spark.sparkContext.defaultParallelism, "hour")
            .write.partitionBy("hour").option("compression", "gzip").text(path)
        )

    return once(spark, sf_dir, "archive-landing", write)


def month_table(spark: SparkSession, sf_dir: str) -> str:
    return once(spark, sf_dir, "month-table", lambda path: write_month_table(raw_events(spark, sf_dir), path))
