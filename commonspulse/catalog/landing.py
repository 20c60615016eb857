"""API objects made from the given tables, in the landed envelope."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commonspulse import schemas
from commonspulse.catalog.adapter import base, once
from commonspulse.session import pin_utc
from commonspulse.sources.landed import typed_objects

ISO = "date_format({}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
OWNER = "concat('Customer#', lpad(cast(o_custkey as string), 9, '0'))"

# Columns of the envelope per kind; the table they come from is the key's comment.
OBJECTS = {
    # customer, seen twice when the balance is high
    "organization": ("customer", f"""
        c_name as target_login, cast(null as bigint) as repo_id,
        timestamp '2024-01-01 00:00:00' + make_interval(0, 0, 0, seen) as observed_at,
        to_json(named_struct('id', c_custkey, 'login', c_name,
          'type', if(c_acctbal < 0, 'User', 'Organization'),
          'name', if(seen = 0, c_name, concat(c_name, ' II')), 'description', if(seen = 0, c_mktsegment, null),
          'public_repos', c_nationkey, 'created_at', '2015-01-01T00:00:00Z')) as object"""),
    "repository": ("orders", f"""
        {OWNER} as target_login, o_orderkey as repo_id, timestamp '2024-01-01 00:00:00' as observed_at,
        to_json(named_struct('id', o_orderkey, 'name', concat('Repo-', o_orderkey),
          'full_name', concat({OWNER}, '/Repo-', o_orderkey), 'description', o_orderpriority,
          'created_at', {ISO.format('o_orderdate')}, 'updated_at', {ISO.format('o_orderdate')},
          'language', if(o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM'), 'Python', 'Go'),
          'license', if(o_orderstatus = 'P', null, named_struct('spdx_id', 'MIT')),
          'fork', if(o_orderstatus = 'P', null, o_orderstatus = 'F'),
          'parent', if(o_orderstatus = 'F', named_struct('full_name', concat('up/Repo-', o_orderkey)), null),
          'archived', o_totalprice > 400000, 'visibility', 'public',
          'owner', named_struct('login', {OWNER}, 'type', 'Organization'),
          'stargazers_count', cast(floor(o_totalprice / 1000) as int), 'forks_count', cast(o_custkey % 100 as int),
          'default_branch', 'main')) as object"""),
    "commit": ("lineitem where l_returnflag = 'N'", f"""
        'any' as target_login, l_orderkey as repo_id, cast(l_shipdate as timestamp) as observed_at,
        to_json(named_struct('sha', cast(l_linenumber as string),
          'author', if(l_linenumber = 2, null, named_struct('login', concat('dev-', lpad(l_suppkey, 6, '0')))),
          'commit', named_struct('message', concat('m-', lpad(l_partkey, 9, '0')),
            'author', named_struct('name', concat('Dev ', lpad(l_suppkey, 6, '0')), 'date', {ISO.format('l_shipdate')}),
            'committer', named_struct('date', {ISO.format('l_shipdate')})),
          'parents', if(l_linenumber % 3 = 0, null, array_repeat(named_struct('sha', 'p'), l_linenumber % 3)))) as object"""),
    # two of the line numbers are pull requests in disguise, one with a null value
    "issue": ("lineitem where l_returnflag = 'R'", f"""
        'any' as target_login, l_orderkey as repo_id, cast(l_shipdate as timestamp) as observed_at,
        concat(substring(plain, 1, length(plain) - 1),
          case l_linenumber when 3 then ',"pull_request":null}}' when 4 then ',"pull_request":{{"url":"x"}}}}' else '}}' end) as object"""),
    "pull": ("lineitem where l_returnflag = 'A'", f"""
        'any' as target_login, l_orderkey as repo_id, cast(l_shipdate as timestamp) as observed_at,
        to_json(named_struct('id', l_orderkey * 10 + l_linenumber, 'number', l_linenumber,
          'user', named_struct('login', concat('dev-', lpad(l_suppkey, 6, '0'))),
          'state', if(l_linestatus = 'F', 'closed', 'open'), 'draft', l_linenumber = 1,
          'title', concat('t-', lpad(l_partkey, 9, '0')),
          'head', named_struct('repo', if(l_linenumber = 2, null, named_struct('full_name', concat('fork/', l_partkey)))),
          'base', named_struct('repo', named_struct('full_name', concat('base/', l_orderkey))),
          'commits', l_linenumber, 'additions', cast(l_quantity as int), 'deletions', 1, 'changed_files', 2,
          'comments', 3, 'created_at', {ISO.format('l_shipdate')})) as object"""),
    "setup": ("part", """
        'any' as target_login, p_partkey as repo_id, timestamp '2024-01-01 00:00:00' as observed_at,
        if(p_size % 5 = 0, null, to_json(named_struct('encoding', if(p_size % 7 = 0, 'none', 'base64'),
          'content', base64(cast(concat('reqs = ["', replace(p_name, ' ', '_'), '>=', p_size, '", "', p_brand, '"]',
            chr(10), 'setup(install_requires=reqs)') as binary))))) as object"""),
}

ISSUE_PLAIN = f"""to_json(named_struct('id', l_orderkey * 10 + l_linenumber, 'number', l_linenumber,
  'user', named_struct('login', concat('dev-', lpad(l_suppkey, 6, '0'))),
  'assignees', if(l_linenumber = 5, null, array(named_struct('login', 'lead'))),
  'state', if(l_linestatus = 'F', 'closed', 'open'), 'title', concat('t-', lpad(l_partkey, 9, '0')),
  'labels', if(l_linenumber = 6, null, array(named_struct('name', 'bug'), named_struct('name', if(l_linenumber = 1, null, 'help')))),
  'comments', cast(l_quantity as int), 'locked', l_linestatus = 'F', 'created_at', {ISO.format('l_shipdate')}))"""


def landed_text(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Envelope rows of one kind."""
    pin_utc(spark)
    source, columns = OBJECTS[kind]
    table, _, condition = source.partition(" where ")
    rows = base(spark, sf_dir, table)
    if kind == "organization":
        rows = rows.withColumn("seen", F.explode(F.expr("if(c_acctbal > 5000, array(0, 1), array(0))")))
    if kind == "issue":
        rows = rows.withColumn("plain", F.expr(ISSUE_PLAIN))
    if condition:
        rows = rows.where(condition)
    rows.createOrReplaceTempView("landing_source")
    return spark.sql(f"select {columns} from landing_source")


def landed(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return typed_objects(landed_text(spark, sf_dir, kind), kind)


def all_landed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {kind: landed(spark, sf_dir, kind) for kind in schemas.API_OBJECTS}


# Lines of a landed file: a gzip file is read by one task.
FILE_LINES = 250_000


def landing_folder(spark: SparkSession, sf_dir: str, kinds: Iterable[str] = tuple(OBJECTS)) -> str:
    """The same objects as gzip JSON lines, one folder per kind; a kind lands when it is first asked for."""
    root = once(spark, sf_dir, "api-landing", lambda path: None)

    def write(kind: str) -> None:
        rows = landed_text(spark, sf_dir, kind)
        plain = F.to_json(F.struct("target_login", "repo_id", "observed_at"))
        text = F.concat(F.expr("substring(plain, 1, length(plain) - 1)"), F.lit(',"object":'),
                        F.coalesce("object", F.lit("null")), F.lit("}"))
        lines = rows.withColumn("plain", plain).select(text.alias("value"))
        lines.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", FILE_LINES).text(f"{root}/{kind}")

    for kind in kinds:
        once(spark, sf_dir, f"api-landing-{kind}", lambda _, kind=kind: write(kind))
    return root
