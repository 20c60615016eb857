"""Batch load of landed API objects into the relational tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commonspulse import schemas
from commonspulse.functions.expressions import decode_base64_text
from commonspulse.operators import filters, projections
from commonspulse.operators.dependencies import parsed_dependencies
from commonspulse.operators.merge import insert_ignore, last_per_key, upsert
from commonspulse.sources.landed import read_api_json

# Fixed value: encoding a setup file must be landed in to be read.
SETUP_ENCODING = "base64"

TARGETS = "login string, repositories array<string>, since timestamp"


def read_landing(spark: SparkSession, root: str, kinds: Iterable[str] = tuple(schemas.API_OBJECTS)) -> dict[str, DataFrame]:
    """The landed folders, one per object kind; those of other kinds need not be there."""
    return {kind: read_api_json(spark, kind, f"{root}/{kind}") for kind in kinds}


def setup_files(landed: DataFrame) -> DataFrame:
    """Landed setup files as ``(repo_id, source)``; an absent file has a null source."""
    source = F.when(F.col("o.encoding") == SETUP_ENCODING, decode_base64_text(F.col("o.content")))
    return landed.select("repo_id", "observed_at", source.alias("source"))


def load_landing(landed: Mapping[str, DataFrame], targets: DataFrame, stored: Mapping[str, DataFrame],
                 until=None, include_archived: bool = True, include_forks: bool = True,
                 setup_dependencies: bool = True, keep: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """The tables after taking in everything that landed for ``targets``.

    ``targets`` has the columns of ``TARGETS``; no repository names means all,
    no ``since`` means from the beginning.  Accounts that are not
    organizations are skipped with all they own; see ``rejected_accounts``.
    ``keep`` stores rows that several tables are made from, for callers that
    write more than one of them.
    """
    keep = keep or (lambda rows: rows)
    wanted = targets.select(F.lower(F.btrim("login")).alias("target"), "repositories", "since")

    def of_targets(kind: str) -> DataFrame:
        rows = landed[kind].withColumn("target", F.lower("target_login"))
        return rows.join(wanted, "target")

    accounts = filters.organizations_only(of_targets("organization"))
    owners = accounts.groupBy("target").agg(F.max_by("o.id", "observed_at").alias("org_id"))

    files = setup_files(landed["setup"])
    latest_files = last_per_key(files, ["repo_id"], ["observed_at", "source"])
    chosen = keep(filters.select_repositories(
        of_targets("repository").join(owners, "target"), F.col("repositories"),
        include_archived, include_forks, prefix="o.",
    ))
    if setup_dependencies:
        latest_files = keep(latest_files)
        parsed = keep(parsed_dependencies(latest_files.select("repo_id", "source")))
        facts = latest_files.select("repo_id", F.col("source").isNotNull().alias("setup_py_present")).join(
            parsed, "repo_id"
        )
        repos = chosen.drop("repo_id").join(facts, F.col("o.id") == facts["repo_id"], "left").select(
            *[c for c in chosen.columns if c != "repo_id"],
            F.coalesce("setup_py_present", F.lit(False)).alias("setup_py_present"),
            "dependencies",
            F.coalesce(F.size("dependencies"), F.lit(0)).alias("dependency_count"),
        )
    else:
        repos = chosen.drop("repo_id").select(
            "*", F.lit(None).cast("boolean").alias("setup_py_present"),
            F.lit(None).cast("array<struct<package_name: string, requirement: string>>").alias("dependencies"),
            F.lit(0).alias("dependency_count"),
        )

    selected = keep(chosen.groupBy(F.col("o.id").alias("repo_id")).agg(F.when(F.count_if(F.col("since").isNull()) == 0, F.min("since")).alias("since")))

    def of_selected(kind: str) -> DataFrame:
        return landed[kind].join(selected, "repo_id")

    def windowed(kind: str, column: str) -> DataFrame:
        return filters.in_window(of_selected(kind), F.col("since"), until, column)

    def newest(rows: DataFrame, table: str) -> DataFrame:
        return upsert(stored[table], last_per_key(rows, schemas.KEYS[table], ["collected_at"]), schemas.KEYS[table])

    # What a setup file tells is the same for all rows of its repository: it joins the row that is picked.
    unread = [F.lit(None).cast("boolean").alias("setup_py_present"), F.lit(0).alias("dependency_count")]
    newest_repos = last_per_key(projections.repository_rows(chosen.drop("repo_id").select("*", *unread)), schemas.KEYS["repository"], ["collected_at"])
    if setup_dependencies:
        newest_repos = projections.with_setup_facts(newest_repos, facts.select("repo_id", "setup_py_present", F.size("dependencies").alias("dependency_count")))

    listed = repos.select(F.col("o.id").alias("repo_id"), "dependencies", "observed_at")
    dependencies = projections.dependency_rows(listed, F.col("observed_at"))
    return {
        "organization": newest(projections.organization_rows(accounts), "organization"),
        "repository": upsert(stored["repository"], newest_repos, schemas.KEYS["repository"]),
        "repository_metric_snapshot": insert_ignore(
            stored["repository_metric_snapshot"], projections.snapshot_rows(chosen),
            schemas.KEYS["repository_metric_snapshot"], ["stargazers_count", "forks_count"],
        ),
        "setup_dependency": newest(dependencies, "setup_dependency"),
        "commit_activity": newest(
            projections.commit_rows(windowed("commit", "o.commit.committer.date")), "commit_activity"
        ),
        "issue": newest(
            projections.issue_rows(filters.without_pull_requests(windowed("issue", "o.created_at"))), "issue"
        ),
        "pull_request": newest(projections.pull_rows(windowed("pull", "o.created_at")), "pull_request"),
    }
