"""Nested source objects to typed rows.

Operators on landed objects read the typed object ``o`` and the envelope
columns ``repo_id`` and ``observed_at``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commonspulse import constants as C
from commonspulse.functions.expressions import (
    as_bigint,
    json_scalars,
    month_of,
    push_size,
    scalar_text,
    setup_eligible,
)

COMMIT_LIST = "array<struct<sha: string, message: string, author: struct<name: string, email: string>>>"

# JSON texts that count as "nothing there".
EMPTY_JSON = ("", "{}", "[]", "0", "false")


def _present(text: Column) -> Column:
    return text.isNotNull() & ~text.isin(*EMPTY_JSON)


def event_rows(events: DataFrame, collected_at: Column | None = None) -> DataFrame:
    """Archive events as 12 flat columns; logins keep their case."""
    payload = F.coalesce(F.col("payload"), F.lit("{}"))
    issue = F.get_json_object(payload, "$.issue")
    number = F.when(_present(issue), F.get_json_object(payload, "$.issue.number")).otherwise(
        F.get_json_object(payload, "$.pull_request.number")
    )
    return events.select(
        F.col("id").alias("event_id"),
        F.col("type").alias("event_type"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"),
        F.col("repo.name").alias("repo_full_name"),
        F.col("org.login").alias("org_login"),
        F.get_json_object(payload, "$.action").alias("action"),
        number.try_cast("int").alias("entity_number"),
        "created_at",
        payload.alias("payload"),
        "archive_hour",
        _now(collected_at).alias("collected_at"),
    )


def archive_commit_rows(events: DataFrame, collected_at: Column | None = None,
                        keep: Sequence[str] = ()) -> DataFrame:
    """One row per commit carried by a push.

    The author time is unknown; the push time is the event time.  Commits
    without sha and pushes without repository id are skipped.  ``keep`` names
    event columns to carry along, for example for ordering.
    """
    pushes = events.where((F.col("type") == "PushEvent") & (F.coalesce("repo.id", F.lit(0)) != 0))
    commits = F.from_json(F.get_json_object("payload", "$.commits"), COMMIT_LIST)
    exploded = pushes.select(
        F.col("repo.id").alias("repo_id"),
        F.col("created_at").alias("event_time"),
        *keep,
        F.posexplode(commits).alias("position", "c"),
    ).where(F.coalesce("c.sha", F.lit("")) != "")
    text, moment = F.lit(None).cast("string"), F.lit(None).cast("timestamp")
    return exploded.select(
        "repo_id",
        F.col("c.sha").alias("sha"),
        text.alias("author_login"),
        text.alias("committer_login"),
        F.col("c.author.name").alias("author_name"),
        F.col("c.author.email").alias("author_email"),
        moment.alias("author_time"),
        moment.alias("committer_time"),
        F.col("c.message").alias("message"),
        F.lit(None).cast("int").alias("parents_count"),
        F.lit(C.SOURCE_ARCHIVE).alias("source"),
        "event_time",
        F.lit(C.PRECISION_PUSH).alias("timestamp_precision"),
        _now(collected_at).alias("collected_at"),
        "position",
        *keep,
    )


def _now(moment: Column | None) -> Column:
    return F.current_timestamp() if moment is None else moment


def _fields(*names: str) -> list[Column]:
    return [F.col(f"o.{n}").alias(n) for n in names]


def organization_rows(landed: DataFrame) -> DataFrame:
    return landed.select(
        F.col("o.id").alias("org_id"),
        F.lower("o.login").alias("login"),
        *_fields("name", "description", "company", "blog", "location", "email", "html_url",
                 "public_repos", "followers", "created_at", "updated_at"),
        F.col("observed_at").alias("collected_at"),
    )


def repository_rows(landed: DataFrame) -> DataFrame:
    """Repository dimension; needs ``org_id``, ``setup_py_present`` and ``dependency_count``."""
    def yes(name: str) -> Column:
        return F.coalesce(F.col(f"o.{name}"), F.lit(False))

    return landed.select(
        F.col("o.id").alias("repo_id"),
        "org_id",
        *_fields("name", "full_name", "html_url", "description", "created_at", "updated_at",
                 "pushed_at", "default_branch", "language"),
        F.col("o.license.spdx_id").alias("license_spdx"),
        yes("fork").alias("is_fork"),
        F.col("o.parent.full_name").alias("parent_full_name"),
        F.col("o.source.full_name").alias("source_full_name"),
        yes("archived").alias("archived"),
        yes("disabled").alias("disabled"),
        *_fields("visibility"),
        "setup_py_present",
        F.col("dependency_count").cast("int").alias("dependency_count"),
        setup_eligible(
            F.col("o.language"), F.col("setup_py_present"), F.col("dependency_count")
        ).alias("python_setup_eligible"),
        F.col("observed_at").alias("collected_at"),
    )


def with_setup_facts(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """``repository_rows`` with what ``facts``, at most one row a repository, tell of its setup file."""
    joined = rows.drop("setup_py_present", "dependency_count", "python_setup_eligible").join(facts, "repo_id", "left").withColumns({
        "setup_py_present": F.coalesce("setup_py_present", F.lit(False)),
        "dependency_count": F.coalesce("dependency_count", F.lit(0)).cast("int"),
    })
    return joined.withColumn("python_setup_eligible", setup_eligible(
        F.col("language"), F.col("setup_py_present"), F.col("dependency_count"))).select(*rows.columns)


def snapshot_rows(landed: DataFrame) -> DataFrame:
    return landed.select(
        F.col("o.id").alias("repo_id"),
        "observed_at",
        *_fields("stargazers_count", "forks_count", "watchers_count", "open_issues_count",
                 "subscribers_count", "network_count"),
    )


def commit_rows(landed: DataFrame) -> DataFrame:
    detail = "o.commit."
    return landed.select(
        "repo_id",
        F.col("o.sha").alias("sha"),
        F.col("o.author.login").alias("author_login"),
        F.col("o.committer.login").alias("committer_login"),
        F.col(detail + "author.name").alias("author_name"),
        F.col(detail + "author.email").alias("author_email"),
        F.col(detail + "author.date").alias("author_time"),
        F.col(detail + "committer.date").alias("committer_time"),
        F.col(detail + "message").alias("message"),
        F.coalesce(F.size("o.parents"), F.lit(0)).alias("parents_count"),
        F.lit(C.SOURCE_API).alias("source"),
        F.lit(None).cast("timestamp").alias("event_time"),
        F.lit(C.PRECISION_COMMIT).alias("timestamp_precision"),
        F.col("observed_at").alias("collected_at"),
    )


def _names(items: str, field: str) -> Column:
    values = F.transform(F.col(items), lambda item: item[field])
    return F.coalesce(values, F.array().cast("array<string>"))


def issue_rows(landed: DataFrame) -> DataFrame:
    return landed.select(
        F.col("o.id").alias("issue_id"),
        "repo_id",
        *_fields("number"),
        F.col("o.user.login").alias("author_login"),
        _names("o.assignees", "login").alias("assignee_logins"),
        *_fields("state", "state_reason", "title", "body"),
        _names("o.labels", "name").alias("labels"),
        F.col("o.comments").alias("comments_count"),
        *_fields("locked", "created_at", "updated_at", "closed_at"),
        F.col("observed_at").alias("collected_at"),
    )


def pull_rows(landed: DataFrame) -> DataFrame:
    return landed.select(
        F.col("o.id").alias("pull_id"),
        "repo_id",
        *_fields("number"),
        F.col("o.user.login").alias("author_login"),
        *_fields("state", "draft", "title", "body"),
        F.col("o.head.repo.full_name").alias("head_repo_full_name"),
        F.col("o.base.repo.full_name").alias("base_repo_full_name"),
        F.col("o.commits").alias("commits_count"),
        *_fields("additions", "deletions", "changed_files"),
        F.col("o.comments").alias("comments_count"),
        F.col("o.review_comments").alias("review_comments_count"),
        *_fields("created_at", "updated_at", "closed_at", "merged_at"),
        F.col("observed_at").alias("collected_at"),
    )


def typed_events(events: DataFrame) -> DataFrame:
    """Eleven typed columns per event; write them once and the JSON is parsed once."""
    kind = F.col("type")

    def of(event: str, path: str) -> Column:
        return F.when(kind == event, F.get_json_object("payload", path))

    found = json_scalars(events, "payload", event_action="$.action", ref_type="$.ref_type").withColumns({
        "_size": of("PushEvent", "$.size"),
        "_owner": of("ForkEvent", "$.forkee.owner.id"),
        "_merged": of("PullRequestEvent", "$.pull_request.merged"),
    })
    return found.select(
        F.col("id").alias("event_id"),
        kind.alias("event_type"),
        F.col("actor.id").alias("actor_id"),
        F.col("repo.id").alias("repo_id"),
        as_bigint(F.col("org.id")).alias("event_org_id"),
        # Text of an object or array is no number, so the cast needs no guard.
        as_bigint(F.col("_owner")).alias("fork_destination_org_id"),
        "event_action",
        "ref_type",
        push_size(kind, F.col("_size"), F.col("payload")).alias("commits_in_push"),
        F.lower(scalar_text(F.col("_merged"))).alias("pull_request_merged"),
        month_of(F.col("created_at")).alias("month"),
    )


def panel_rows(panel: DataFrame, collected_at: Column | None = None) -> DataFrame:
    """Panel rows in table form: lower-case login, no null metric, provenance stamped."""
    return panel.select(
        F.lower("org_login").alias("org_login"),
        "month",
        *[F.coalesce(F.col(m).cast("bigint"), F.lit(0)).alias(m) for m in C.LOGIN_PANEL_METRICS],
        F.lit(C.SOURCE_PANEL).alias("source"),
        _now(collected_at).alias("collected_at"),
    )


def dependency_rows(parsed: DataFrame, collected_at: Column | None = None) -> DataFrame:
    """Table rows from ``(repo_id, dependencies array<struct<package_name, requirement>>)``."""
    moment = _now(collected_at).alias("collected_at")
    return parsed.select("repo_id", moment, F.inline("dependencies")).select(
        "repo_id", "package_name", "requirement", F.lit(C.SOURCE_SETUP).alias("source"), "collected_at"
    )
