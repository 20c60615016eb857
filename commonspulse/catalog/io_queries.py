"""Sources, sinks, loads of archive hours and streams.

Files these queries read are written by Spark from the given tables first.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commonspulse import constants as C
from commonspulse import schemas
from commonspulse.catalog import adapter as A
from commonspulse.catalog.adapter import archive_landing, base, cte, ntz, view
from commonspulse.catalog.landing import landing_folder
from commonspulse.catalog.load_queries import COMMITS, OBJECTS, ORG_COLUMNS, loaded, search_results, shown
from commonspulse.catalog.panel_queries import (
    FIRST,
    LAST,
    LOGIN_DOCUMENTS,
    LOGIN_PANEL,
    TARGET_DENSE,
    login_panel,
    target_panel,
)
from commonspulse.catalog.registry import ORACLES, query
from commonspulse.operators import projections, search
from commonspulse.operators.filters import archive_types
from commonspulse.operators.merge import first_per_key, last_per_key
from commonspulse.plans import archive_load, exports, landing_load, queries, runlog
from commonspulse.session import scratch_dir
from commonspulse.sources import archive, landed, months, tables, targets
from commonspulse.streaming import dedup, ingest
from commonspulse.streaming import panel as stream_panel

COLLECTED = datetime(2024, 3, 1)


# --- sources

def scanned(spark, sf_dir) -> DataFrame:
    """Every hour of the landing folder."""
    bounds = view(spark, sf_dir, "archive_event").agg(
        F.min("archive_hour").alias("low"), F.max("archive_hour").alias("high")).first()
    return archive.read_hours(spark, archive_landing(spark, sf_dir), bounds["low"], bounds["high"] + timedelta(hours=1))


@query("s1_archive_scan", cte("archive_event") + """
select event_id, type, created_at, actor_login, repo_id, repo_name, org_login, payload, archive_hour from archive_event""")
def archive_scan(spark, sf_dir):
    rows = scanned(spark, sf_dir)
    return rows.select(
        F.col("id").alias("event_id"), "type", ntz("created_at"), F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"), F.col("repo.name").alias("repo_name"),
        F.col("org.login").alias("org_login"), "payload", ntz("archive_hour"))


@query("s2_archive_hours", """
with b as (select min(ts) as low, max(ts) as high from events)
select h as archive_hour, concat(strftime(h, '%Y-%m-%d'), '-', cast(hour(h) as varchar)) as stem
from (select unnest(generate_series(date_trunc('hour', low), high, interval 1 hour)) as h, high from b) x where h < high""")
def archive_hours(spark, sf_dir):
    bounds = base(spark, sf_dir, "events").agg(
        F.min("ts").cast("timestamp").alias("start"), F.max("ts").cast("timestamp").alias("end"))
    hours = archive.hours_in(bounds)
    return hours.select(ntz("archive_hour"), archive.hour_stem("archive_hour").alias("stem"))


@query("s3_month_scan", cte("raw_event") + """
select cast(strftime(created_at, '%Y%m') as int) as event_month, type, count(*) as events from raw_event
where created_at >= timestamp '1996-03-01' and created_at < timestamp '1998-12-01' group by 1, 2""")
def month_scan(spark, sf_dir):
    rows = archive.scan_months(spark, A.month_table(spark, sf_dir), date(1996, 3, 1), date(1998, 11, 1))
    return rows.groupBy("event_month", "type").agg(F.count(F.lit(1)).alias("events"))


@query("s4_targets", """
select s_suppkey + 1 as organization_id, case when s_acctbal < 0 then null else s_name end as historical_login from supplier""")
def csv_targets(spark, sf_dir):
    def write(path: str) -> None:
        suppliers = base(spark, sf_dir, "supplier")
        both = suppliers.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("seq"))
        rows = both.repartition("s_suppkey").sortWithinPartitions("s_suppkey", "seq").select(
            F.when((F.col("seq") == 0), F.lit("earlier")).when(F.col("s_acctbal") < 0, F.lit("  "))
            .otherwise(F.col("s_name")).alias(" Historical_Login "),
            F.col("s_nationkey").alias("event_types"),
            F.concat(F.lit(" "), F.col("s_suppkey") + 1, F.lit(" ")).alias("Organization_ID"))
        rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False).csv(path)

    return targets.read_targets(spark, A.once(spark, sf_dir, "target-csv", write))


@query("s5_api_objects", OBJECTS + """
select 'organization' as kind, count(*) as objects, count(distinct org_id) as ids from org_object
union all select 'repository', count(*), count(distinct repo_id) from repo_object
union all select 'issue', count(*), count(distinct issue_id) from issue_object
union all select 'pull', count(*), count(distinct pull_id) from pull_object
union all select 'commit', count(*), count(distinct concat(repo_id, '/', sha)) from commit_object
union all select 'setup', count(*), count(distinct p_partkey) from part where p_size % 5 <> 0""")
def api_objects(spark, sf_dir):
    root, parts = landing_folder(spark, sf_dir), None
    ids = {"commit": F.concat_ws("/", "repo_id", "o.sha"), "setup": F.when(F.col("o").isNotNull(), F.col("repo_id"))}
    for kind in schemas.API_OBJECTS:
        rows = landed.read_api_json(spark, kind, f"{root}/{kind}")
        part = rows.agg(F.count("o").alias("objects"), F.count_distinct(ids.get(kind, F.col("o.id"))).alias("ids")).select(
            F.lit(kind).alias("kind"), "objects", "ids")
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query("s6_table_scan", OBJECTS + """
select org_id, login, name, description, public_repos, created_at, collected_at from org_object
where type = 'Organization' qualify row_number() over (partition by org_id order by collected_at desc) = 1""")
def table_scan(spark, sf_dir):
    def write(path: str) -> None:
        kinds = ("organization",)
        objects = landing_load.read_landing(spark, landing_folder(spark, sf_dir, kinds), kinds)["organization"]
        rows = projections.organization_rows(objects.where("o.type = 'Organization'"))
        tables.write_tables({"organization": last_per_key(rows, ["org_id"], ["collected_at"])}, path)

    return shown(tables.read_table(spark, A.once(spark, sf_dir, "tables", write), "organization"), ORG_COLUMNS)


# What each table holds after a load of everything, by the query that checks its rows.
_FILLED = {
    "organization": "w8_load_organizations", "repository": "w8_load_repositories", "repository_metric_snapshot": "w8_load_snapshots",
    "setup_dependency": "w8_load_dependencies", "commit_activity": "w8_load_commits", "issue": "w8_load_issues",
    "pull_request": "w8_load_pull_requests", "repository_search_hit": "p9_search_hits",
    "organization_public_monthly": "a1_org_month_panel",
}


@query("s6_all_tables", " union all ".join(
    [f"""select '{name}' as "table", count(*) as rows, count(*) as keys from ({ORACLES[check]}) t""" for name, check in _FILLED.items()]
    + ["select 'gharchive_event', count(distinct event_id), count(distinct event_id) from (" + A.VIEWS["archive_event"] + ") t",
       "select 'collection_run', 2, 1"]))
def all_tables(spark, sf_dir):
    """Every table of the warehouse written once and scanned by its schema: rows and different keys."""
    def stored(rows: DataFrame) -> DataFrame:
        path = scratch_dir(spark, "load-step")
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    def write(path: str) -> None:
        events = projections.event_rows(A.archive_events(spark, sf_dir), F.lit(COLLECTED))
        with runlog.audited_run(spark, f"{path}/collection_run", "load", "all"):
            tables.write_tables({
                **loaded(spark, sf_dir, keep=stored),
                "repository_search_hit": search.ranked_hits(search_results(spark, sf_dir)),
                "organization_public_monthly": projections.panel_rows(login_panel(spark, sf_dir), F.lit(COLLECTED)),
                "gharchive_event": first_per_key(events, ["event_id"], ["archive_hour"]),
            }, path)

    root = A.once(spark, sf_dir, "all-tables", write)
    counted = [
        tables.read_table(spark, root, name).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(*keys).alias("keys")).select(
            F.lit(name).alias("table"), "rows", "keys")
        for name, keys in schemas.KEYS.items()
    ]
    return reduce(DataFrame.unionByName, counted)


@query("s7_months", """
select cast(m as date) as month from (select unnest(generate_series(date_trunc('month', min(l_shipdate)),
  date_trunc('month', max(l_shipdate)), interval 1 month)) as m from lineitem) x""")
def month_enumeration(spark, sf_dir):
    return months.months_in(base(spark, sf_dir, "lineitem").agg(
        F.min("l_shipdate").alias("start"), F.max("l_shipdate").alias("end")))


# --- sinks, read back

@query("k4_login_files", LOGIN_DOCUMENTS + """
select concat(substring(concat(safe_login, '__'), 1, 2), '/', safe_login, '.json') as file, body from named""")
def login_files(spark, sf_dir):
    root = A.once(spark, sf_dir, "login-json", lambda path: exports.export_login_json(
        login_panel(spark, sf_dir), path, FIRST, LAST))
    files = spark.read.text(root + "/*/*.json")
    return files.select(F.regexp_extract(F.col("_metadata.file_path"), "([^/]+/[^/]+)$", 1).alias("file"),
                        F.col("value").alias("body"))


def _target_export(spark, sf_dir) -> str:
    return A.once(spark, sf_dir, "target-export", lambda path: exports.export_targets(
        view(spark, sf_dir, "target"), target_panel(spark, sf_dir), path, FIRST, LAST))


def _target_documents(spark, sf_dir, schema: str) -> DataFrame:
    """The files of all targets: one folder is listed, where a glob path would be as many paths as there are files."""
    return spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", "[0-9]*.json").json(_target_export(spark, sf_dir))


_TARGET_SUMS = ", ".join(f"cast(sum({m}) as bigint) as {m}" for m in C.TARGET_ADDITIVE_METRICS)


@query("k5_target_files", TARGET_DENSE + f"""
select organization_id, any_value(historical_login) as historical_login, count(*) as months, {_TARGET_SUMS}
from dense join target using (organization_id) group by 1""")
def target_files(spark, sf_dir):
    totals = ", ".join(f"{m}: bigint" for m in C.TARGET_ADDITIVE_METRICS)
    schema = (f"organization_id bigint, historical_login string, totals struct<{totals}>, "
              "monthly array<struct<month: string, public_events: bigint>>")
    rows = _target_documents(spark, sf_dir, schema)
    return rows.select("organization_id", "historical_login", F.size("monthly").cast("bigint").alias("months"), "totals.*")


@query("k5_target_file_months", TARGET_DENSE + f"""
select cast(organization_id as varchar) || '.json' as file, organization_id, historical_login,
  '1995-01' as period_start, '2001-12' as period_end, true as public_activity_only, false as persistent_database_created,
  strftime(month, '%Y-%m') as month, {', '.join(C.TARGET_PANEL_METRICS)}
from dense join target using (organization_id)""")
def target_file_months(spark, sf_dir):
    """Every month of every file with all its metrics."""
    month = "month: string, " + ", ".join(f"{m}: bigint" for m in C.TARGET_PANEL_METRICS)
    schema = ("organization_id bigint, historical_login string, period struct<start: string, end: string>, "
              f"coverage struct<public_activity_only: boolean, persistent_database_created: boolean>, monthly array<struct<{month}>>")
    rows = _target_documents(spark, sf_dir, schema)
    return rows.select(
        F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)$", 1).alias("file"), "organization_id", "historical_login",
        F.col("period.start").alias("period_start"), F.col("period.end").alias("period_end"), "coverage.*", F.inline("monthly"))


@query("k6_panel_csv", TARGET_DENSE + f"""
select organization_id, historical_login, strftime(month, '%Y-%m') as month, {', '.join(C.TARGET_PANEL_METRICS)}
from dense join target using (organization_id)""")
def panel_csv(spark, sf_dir):
    schema = "organization_id bigint, historical_login string, month string, " + ", ".join(
        f"{m} bigint" for m in C.TARGET_PANEL_METRICS)
    path = f"{_target_export(spark, sf_dir)}/{C.TARGET_CSV_NAME}"
    return spark.read.schema(schema).option("header", True).csv(path)


@query("k7_login_manifest", LOGIN_PANEL + """
select '1.0' as schema_version, '1995-01' as period_start, '2001-12' as period_end, 84 as months,
  count(distinct org_login) as organization_count, 11 as metrics from panel""")
def login_manifest(spark, sf_dir):
    root = A.once(spark, sf_dir, "login-json", lambda path: exports.export_login_json(
        login_panel(spark, sf_dir), path, FIRST, LAST))
    schema = ("schema_version string, period struct<start: string, end: string, months: int>, "
              "organization_count bigint, metrics array<string>")
    rows = spark.read.schema(schema).option("multiLine", True).json(f"{root}/manifest.json")
    return rows.select("schema_version", F.col("period.start").alias("period_start"),
                       F.col("period.end").alias("period_end"), "period.months", "organization_count",
                       F.size("metrics").alias("metrics"))


@query("k7_target_manifest", """
select count(*) as organization_count, count(*) * 84 as monthly_row_count, cast(count(*) as int) as files,
  'organization_monthly.csv' as combined_csv, false as persistent_database_created from supplier""")
def target_manifest(spark, sf_dir):
    schema = ("organization_count bigint, monthly_row_count bigint, json_files_table string, combined_csv string, "
              "persistent_database_created boolean")
    root = _target_export(spark, sf_dir)
    rows = spark.read.schema(schema).option("multiLine", True).json(f"{root}/manifest.json")
    table = rows.first()["json_files_table"]
    files = spark.read.text(f"{root}/{table}").distinct().agg(F.count("*").cast("int").alias("files"))
    return rows.withColumn("files", F.lit(files.first()["files"])).select(
        "organization_count", "monthly_row_count", "files", "combined_csv", "persistent_database_created")


@query("k8_query_csv", LOGIN_PANEL + """
select org_login, strftime(month, '%Y-%m') as month, public_events from panel where star_events > 0""")
def query_csv(spark, sf_dir):
    path = A.once(spark, sf_dir, "query-csv", lambda path: queries.query_to_csv(spark, """
        select org_login, date_format(month, 'yyyy-MM') as month, public_events
        from organization_public_monthly where star_events > 0
    """, {"organization_public_monthly": login_panel(spark, sf_dir)}, path))
    return spark.read.schema("org_login string, month string, public_events bigint").option("header", True).csv(path)


@query("k9_run_log", LOGIN_PANEL + """
select 'gharchive_bigquery' as source, 'succeeded' as status, count(*) as rows_written, 0 as error_length from panel
union all select 'failing', 'failed', 0, 4000""")
def run_log(spark, sf_dir):
    root = scratch_dir(spark, "run-log")
    with runlog.audited_run(spark, f"{root}/collection_run", C.SOURCE_PANEL, "all") as run:
        run.counted(login_panel(spark, sf_dir)).write.parquet(f"{root}/panel")
    try:
        with runlog.audited_run(spark, f"{root}/collection_run", "failing", "all", error_width=4000):
            raise ValueError("x" * 5000)
    except ValueError:
        pass
    return runlog.run_states(spark, f"{root}/collection_run").select(
        "source", "status", "rows_written", F.coalesce(F.length("error_message"), F.lit(0)).alias("error_length"))


# --- archive load, batch and streaming

_ARCHIVE_FIRST = cte("archive_event") + COMMITS + """, matched as (
  select * from archive_event where type in ('PushEvent', 'IssuesEvent', 'PullRequestEvent', 'CreateEvent', 'ForkEvent')
    and ({match})
), kept_event as (
  select * from matched qualify row_number() over (partition by event_id order by archive_hour, created_at) = 1
), kept_commit as (
  select c.* from archive_commit c where exists (select 1 from matched m where m.event_id = c.event_id and m.archive_hour = c.archive_hour)
  qualify row_number() over (partition by repo_id, sha order by archive_hour, event_time, event_id, position) = 1
)
"""
ONE_ORG = _ARCHIVE_FIRST.replace("{match}", "lower(repo_name) like 'acme-7/%' or lower(org_login) = 'acme-7'")
ALL_ORGS = _ARCHIVE_FIRST.replace("{match}", "true")
MANY_ORGS = _ARCHIVE_FIRST.replace(
    "{match}", "split_part(lower(repo_name), '/', 1) in (select 'acme-' || cast(s_suppkey as varchar) from supplier) "
    "or lower(org_login) in (select 'acme-' || cast(s_suppkey as varchar) from supplier)")
_EVENTS = """
select event_id, type as event_type, repo_id, org_login, created_at, payload, archive_hour, timestamp '2024-03-01' as collected_at from kept_event"""
_COMMITS = """
select repo_id, sha, author_name, message, source, event_time, timestamp_precision from kept_commit"""
EVENT_COLUMNS = ("event_id", "event_type", "repo_id", "org_login", "created_at", "payload", "archive_hour", "collected_at")
COMMIT_COLUMNS = ("repo_id", "sha", "author_name", "message", "source", "event_time", "timestamp_precision")


def _empty(spark) -> dict[str, DataFrame]:
    return {n: spark.createDataFrame([], schemas.table_schema(n)) for n in ("gharchive_event", "commit_activity")}


def _loaded(spark, sf_dir) -> archive_load.ArchiveLoad:
    return archive_load.load_archive(scanned(spark, sf_dir), _empty(spark), "Acme-7", F.lit(COLLECTED))


@query("w9_archive_events", ONE_ORG + _EVENTS)
def loaded_events(spark, sf_dir):
    return shown(_loaded(spark, sf_dir).new_events, EVENT_COLUMNS)


@query("w9_archive_commits", ONE_ORG + _COMMITS)
def loaded_commits(spark, sf_dir):
    return shown(_loaded(spark, sf_dir).new_commits, COMMIT_COLUMNS)


def _over_stored(spark, sf_dir) -> tuple[dict[str, DataFrame], archive_load.ArchiveLoad]:
    """Stored rows, a tenth of all events and commits with marks of their own, and the load over them."""
    events = view(spark, sf_dir, "archive_event").where("event_id like '%3'").select("event_id", F.lit("stored").alias("payload")).distinct()
    commits = projections.archive_commit_rows(A.archive_events(spark, sf_dir)).where("sha like '%3'").select(
        "repo_id", "sha", F.lit("stored").alias("message")).distinct()
    kept = {name: table.unionByName(rows, allowMissingColumns=True) for (name, table), rows in zip(
        _empty(spark).items(), (events, commits), strict=True)}
    return kept, archive_load.load_archive(scanned(spark, sf_dir), kept, "Acme-7", F.lit(COLLECTED))


@query("w9_events_over_stored", ONE_ORG + """
select event_id, type as event_type, payload, archive_hour from kept_event where event_id not like '%3'
union all select distinct event_id, null, 'stored', cast(null as timestamp) from archive_event where event_id like '%3'""")
def events_over_stored(spark, sf_dir):
    kept, load = _over_stored(spark, sf_dir)
    return shown(kept["gharchive_event"].unionByName(load.new_events), ("event_id", "event_type", "payload", "archive_hour"))


@query("w9_commits_over_stored", ONE_ORG + """
select repo_id, sha, message, source, event_time from kept_commit where sha not like '%3'
union all select distinct repo_id, sha, 'stored', null, cast(null as timestamp) from archive_commit where sha like '%3'""")
def commits_over_stored(spark, sf_dir):
    kept, load = _over_stored(spark, sf_dir)
    return shown(kept["commit_activity"].unionByName(load.new_commits), ("repo_id", "sha", "message", "source", "event_time"))


@query("a20_match_count", ONE_ORG + """
select (select count(*) from matched) as matches, (select count(*) from kept_event) as stored""")
def match_count(spark, sf_dir):
    load = _loaded(spark, sf_dir)
    path = scratch_dir(spark, "archive-load")
    load.new_events.write.parquet(path)
    stored = spark.read.schema(schemas.TABLES["gharchive_event"]).parquet(path)
    return stored.agg(F.lit(load.matches()).cast("bigint").alias("matches"), F.count(F.lit(1)).alias("stored"))


def _streamed(spark, sf_dir) -> str:
    """Tables after the landing folder was filled ten days at a time, the stream going on from its checkpoint each time."""
    def write(path: str) -> None:
        lines = spark.read.text(archive_landing(spark, sf_dir)).withColumn("day", F.to_date(F.substring("hour", 1, 10)))
        first, last = lines.agg(F.min("day"), F.max("day")).first()
        logins = base(spark, sf_dir, "supplier").select(F.concat(F.lit("Acme-"), F.col("s_suppkey")).alias("login"))
        ingest.create(spark, path)
        batch = ingest.ingest_batch(path, logins, F.lit(COLLECTED))
        for k in range((last - first).days // 10 + 1):
            part = lines.where(F.floor(F.datediff("day", F.lit(first)) / 10) == k).drop("day")
            part.write.mode("append").partitionBy("hour").option("compression", "gzip").text(path + "-landing")
            stream = archive.read_archive_stream(spark, path + "-landing", max_files=1000)
            ingest.start(stream, batch, path + "-checkpoint").awaitTermination()

    return A.once(spark, sf_dir, "stream-ingest", write)


@query("r1_incremental_events", MANY_ORGS + _EVENTS)
def incremental_events(spark, sf_dir):
    return shown(ingest.stored_rows(spark, _streamed(spark, sf_dir) + "/gharchive_event", schemas.TABLES["gharchive_event"]), EVENT_COLUMNS)


@query("r2_incremental_commits", MANY_ORGS + _COMMITS)
def incremental_commits(spark, sf_dir):
    return shown(ingest.stored_rows(spark, _streamed(spark, sf_dir) + "/commit_activity", schemas.TABLES["commit_activity"]), COMMIT_COLUMNS)


@query("r3_incremental_panel", LOGIN_PANEL + "select * from panel")
def incremental_panel(spark, sf_dir):
    def write(path: str) -> None:
        # The month table as a stream of files.
        schema = f"{schemas.RAW_EVENT}, event_month int"
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 250).parquet(A.month_table(spark, sf_dir))
        ingest.start(stream.drop("event_month"), stream_panel.panel_batch(path), path + "-checkpoint").awaitTermination()

    rows = stream_panel.read_panel(spark, A.once(spark, sf_dir, "stream-panel", write))
    return rows.select("org_login", "month", *C.LOGIN_PANEL_METRICS)


@query("r1_stateful_events", ALL_ORGS + """
select event_id, type as event_type, actor_login, repo_id, repo_name as repo_full_name, org_login,
  case when json_type(payload, '$.action') = 'VARCHAR' then json_extract_string(payload, '$.action') end as action,
  created_at, payload, archive_hour, timestamp '2024-03-01' as collected_at from kept_event""")
def stateful_events(spark, sf_dir):
    def write(path: str) -> None:
        # Hours land in order, five days at a time, so a delay of six days loses none of them.
        lines = spark.read.text(archive_landing(spark, sf_dir))
        five_days = F.floor(F.substring(F.col("hour"), 9, 2).cast("int") / 5)
        for part in range(7):
            lines.where(five_days == part).write.mode("append").partitionBy("hour").option("compression", "gzip").text(path + "/landing")
        landing, events = path + "/landing", path + "/events"
        stream = archive_types(archive.read_archive_stream(spark, landing, max_files=200))
        dedup.start_settling(stream, events, "6 days", path + "/checkpoint", F.lit(COLLECTED)).awaitTermination()
        # The last days are still in the state.
        last = view(spark, sf_dir, "archive_event").agg(F.max("archive_hour").alias("h")).first()["h"]
        tail = archive_types(archive.read_hours(spark, landing, last - timedelta(days=8), last + timedelta(hours=1)))
        for _ in range(2):
            dedup.catch_up(tail, events, "last-days", F.lit(COLLECTED))

    rows = dedup.read_events(spark, A.once(spark, sf_dir, "stream-settled", write) + "/events")
    return shown(rows, ("event_id", "event_type", "actor_login", "repo_id", "repo_full_name", "org_login", "action", "created_at", "payload",
                        "archive_hour", "collected_at"))


@query("r3_delta_panel", LOGIN_PANEL + "select * from panel")
def delta_panel(spark, sf_dir):
    def write(path: str) -> None:
        schema = f"{schemas.RAW_EVENT}, event_month int"
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 30).parquet(A.month_table(spark, sf_dir))
        stream_panel.create_deltas(spark, path)
        ingest.start(stream.drop("event_month"), stream_panel.delta_batch(path), path + "-checkpoint").awaitTermination()

    return stream_panel.summed_panel(spark, A.once(spark, sf_dir, "stream-deltas", write)).select("org_login", "month", *C.LOGIN_PANEL_METRICS)
