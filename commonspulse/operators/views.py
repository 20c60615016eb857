"""Portfolio and activity views over the relational tables.

Facts are counted per repository before they meet the repository table, so a
repository with very many commits is one row in the join.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commonspulse import constants as C
from commonspulse.operators.filters import keyword_matches


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """The newest snapshot row of each repository; at most one row per repository and time."""
    counts = [c for c in snapshots.columns if c not in ("repo_id", "observed_at")]
    # One number per column keeps this a hash aggregate; a struct would need a sort.
    newest = [F.max_by(c, "observed_at").alias(c) for c in counts]
    return snapshots.groupBy("repo_id").agg(*newest, F.max("observed_at").alias("observed_at"))


def repository_current(repositories: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Repositories with their latest counts; null counts when never observed."""
    return repositories.join(latest_snapshot(snapshots), "repo_id", "left")


def _tagged(name: str, facts: DataFrame, moment: str | None = None) -> DataFrame:
    """Facts as ``repo_id``, their time if wanted, and a mark in the column of their kind."""
    columns = [F.col("repo_id"), F.lit(1).alias(name)]
    if moment is not None:
        columns.append(F.date_trunc("month", moment).alias("month"))
    return facts.select(*columns)


def _stacked(*parts: DataFrame) -> DataFrame:
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows


def organization_monthly_activity(commits: DataFrame, issues: DataFrame, pulls: DataFrame,
                                  repositories: DataFrame, organizations: DataFrame) -> DataFrame:
    """Commits, issues and pull requests per organization and month.

    Commits are dated by author time only, so commits known from pushes alone
    do not appear.
    """
    facts = _stacked(
        _tagged("commits", commits, "author_time"),
        _tagged("issues", issues, "created_at"),
        _tagged("pull_requests", pulls, "created_at"),
    ).where(F.col("month").isNotNull())
    counts = ("commits", "issues", "pull_requests")
    per_repo = facts.groupBy("repo_id", "month").agg(*[F.count(c).alias(c) for c in counts])
    per_org = (
        per_repo.join(repositories.select("repo_id", "org_id"), "repo_id")
        .groupBy("org_id", "month").agg(*[F.sum(c).alias(c) for c in counts])
    )
    return (
        per_org.join(organizations.select("org_id", "login"), "org_id")
        .groupBy("login", "month").agg(*[F.sum(c).alias(c) for c in counts])
    )


def innovation_summary(organizations: DataFrame, repositories: DataFrame, snapshots: DataFrame,
                       commits: DataFrame, issues: DataFrame, pulls: DataFrame) -> DataFrame:
    """Portfolio and activity totals, one row per organization, silent ones with zeros.

    Facts and snapshots shrink to one row per repository in a single grouping;
    that row joins the repository table, and the organization sums follow.
    """
    facts = ("commits", "issues", "pull_requests")
    per_repo = _stacked(
        _tagged("commits", commits), _tagged("issues", issues), _tagged("pull_requests", pulls),
        snapshots.select("repo_id", "observed_at", "stargazers_count"),
    ).groupBy("repo_id").agg(
        *[F.count(c).alias(c) for c in facts],
        F.max_by("stargazers_count", "observed_at").alias("stars"),
    )
    fork = F.col("is_fork")
    per_org = (
        repositories.select("repo_id", "org_id", "is_fork").join(per_repo, "repo_id", "left")
        .groupBy("org_id").agg(
            F.count(F.lit(1)).alias("repositories"),
            F.count_if(~fork).alias("original_repositories"),
            F.count_if(fork).alias("forked_repositories"),
            *[F.sum(c).alias(c) for c in facts],
            F.sum("stars").alias("current_stars"),
        )
    )
    columns = ("repositories", "original_repositories", "forked_repositories", *facts, "current_stars")
    return organizations.select("org_id", "login").join(per_org, "org_id", "left").select(
        "login", *[F.coalesce(c, F.lit(0)).alias(c) for c in columns]
    )


def portfolio_listing(current: DataFrame, organizations: DataFrame) -> DataFrame:
    """Repositories with their origin and latest counts."""
    origin = F.when(F.col("is_fork"), F.lit("forked")).otherwise(F.lit("original"))
    return current.join(organizations.select("org_id", "login"), "org_id").select(
        "login", "name", origin.alias("origin"), "created_at", "license_spdx",
        "stargazers_count", "forks_count", "python_setup_eligible",
    )


def eligible_dependencies(repositories: DataFrame, organizations: DataFrame,
                          dependencies: DataFrame) -> DataFrame:
    """Repositories passing the setup screen, with their requirements ordered by package."""
    pair = F.struct("package_name", "requirement")
    chosen = repositories.where("python_setup_eligible")
    listed = dependencies.join(chosen.select("repo_id"), "repo_id", "left_semi").groupBy("repo_id").agg(F.array_sort(F.collect_list(pair)).alias("pairs"))
    return (
        chosen.join(listed, "repo_id")
        .join(organizations.select("org_id", "login"), "org_id")
        .select("login", "full_name", "dependency_count",
                F.transform("pairs", lambda p: p["requirement"]).alias("dependencies"))
    )


def keyword_repositories(repositories: DataFrame, organizations: DataFrame,
                         phrases: Iterable[str] = C.SCREEN_PHRASES) -> DataFrame:
    matches = keyword_matches(repositories, phrases)
    return matches.join(organizations.select("org_id", "login"), "org_id").select(
        "login", "full_name", "description"
    )


def top_repositories(current: DataFrame, k: int = 20, by: str = "stargazers_count") -> DataFrame:
    return current.orderBy(F.col(by).desc_nulls_last(), "repo_id").limit(k)
