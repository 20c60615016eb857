"""Research measures strictly before a cutoff, for many (organization, cutoff) pairs at once.

A fact is never paired with every cutoff of its organization.  Facts are
counted per organization and day, and a running sum over days is read off at
each cutoff.  Only days that a cutoff splits keep exact times, which are summed
within the day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commonspulse.functions.expressions import dummy, log_plus_one

# What is counted, one kind per counted row; the repository counts come first.
PORTFOLIO = ("original_repos", "forked_repos", "other_repos")
FACTS = ("commits", "issues", "pulls")
KINDS = (*PORTFOLIO, *FACTS)
COUNTS = ("repos", "original_repos", "forked_repos", *FACTS)


def _kind(name: str) -> Column:
    """A kind as a small number, which sorts and shuffles better than its name."""
    return F.lit(KINDS.index(name))


def cutoff_measures(targets: DataFrame, organizations: DataFrame, repositories: DataFrame,
                    commits: DataFrame, issues: DataFrame, pulls: DataFrame) -> DataFrame:
    """Twelve measures per row of ``targets(login, cutoff)``.

    Logins match ignoring case, organizations whose logins differ only in case
    are pooled, and a login that is not stored still gets its row: zeros, with
    ``open_source_washer`` one.
    """
    wanted = targets.select(F.lower("login").alias("org_key"), "cutoff").distinct()
    orgs = organizations.select("org_id", F.lower("login").alias("org_key"))
    marks = wanted.join(orgs, "org_key").select("org_key", "org_id", F.col("cutoff").alias("moment"))
    scoped = repositories.select("repo_id", "org_id").join(marks.select("org_id"), "org_id", "left_semi")
    facts = _timed(repositories, commits, issues, pulls)
    counted = _before(marks, _per_moment(scoped, facts, _split_days(marks)))
    # A fork flag is required; a row without one still counts as a repository.
    counted = counted.withColumn("repos", sum((F.col(c) for c in PORTFOLIO), F.lit(0)))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS]
    measured = (
        targets.withColumn("org_key", F.lower("login"))
        .join(counted, ["org_key", "cutoff"], "left")
        .select("login", "cutoff", *zero)
    )
    return measured.select(
        "login", "cutoff", *COUNTS,
        log_plus_one(F.col("pulls")).alias("pull_log"),
        log_plus_one(F.col("issues")).alias("issues_log"),
        dummy(F.col("pulls") > 0).alias("pull_dummy"),
        dummy(F.col("issues") > 0).alias("issues_dummy"),
        dummy(F.col("commits") == 0).alias("open_source_washer"),
        dummy(F.col("commits") > 0).alias("open_source_producer"),
    )


def _timed(repositories: DataFrame, commits: DataFrame, issues: DataFrame, pulls: DataFrame) -> DataFrame:
    """All facts, the creation of repositories among them, as ``repo_id``, kind and time."""
    def of_kind(rows: DataFrame, kind: Column, moment: Column) -> DataFrame:
        return rows.select("repo_id", kind.alias("kind"), moment.alias("moment"))

    created = F.when(F.col("is_fork"), _kind("forked_repos")).when(~F.col("is_fork"), _kind("original_repos"))
    return (
        of_kind(commits, _kind("commits"), F.coalesce("author_time", "event_time"))
        .unionByName(of_kind(issues, _kind("issues"), F.col("created_at")))
        .unionByName(of_kind(pulls, _kind("pulls"), F.col("created_at")))
        .unionByName(of_kind(repositories, created.otherwise(_kind("other_repos")), F.col("created_at")))
        .where(F.col("moment").isNotNull())
    )


def _split_days(marks: DataFrame) -> DataFrame:
    """Days of an organization on which a cutoff falls between midnights."""
    return (
        marks.where(F.col("moment") > F.to_date("moment").cast("timestamp"))
        .select("org_id", F.to_date("moment").alias("day"), F.lit(True).alias("split")).distinct()
    )


def _coarse(rows: DataFrame, days: DataFrame, keys: list[str]) -> DataFrame:
    """Times cut down to their day, but for the days in ``days``."""
    moment = F.when(F.col("split"), F.col("moment")).otherwise(F.to_date("moment").cast("timestamp"))
    return rows.withColumn("day", F.to_date("moment")).join(days, keys, "left").withColumn("moment", moment).drop("day", "split")


def _per_moment(scoped: DataFrame, facts: DataFrame, split_days: DataFrame) -> DataFrame:
    """Counts per organization, kind and day; by exact time on days that a cutoff of the organization splits.

    Facts shrink per repository and day before the join.
    """
    # At most one row per calendar day, so this side is always small.
    any_day = F.broadcast(split_days.select("day", "split").distinct())
    shrunk = _coarse(facts, any_day, ["day"]).groupBy("repo_id", "kind", "moment").agg(F.count(F.lit(1)).alias("n"))
    owned = shrunk.join(scoped, "repo_id").select("org_id", "kind", "moment", "n")
    return _coarse(owned, split_days, ["org_id", "day"]).groupBy("org_id", "kind", "moment").agg(F.sum("n").alias("n"))


def _before(marks: DataFrame, per_moment: DataFrame) -> DataFrame:
    """Counts strictly before each mark, one column per kind.

    The running sum of an organization sees one row per day, the distinct times of its split days and its marks.
    """
    # At equal times the mark, which has no count, comes first: it is exclusive.
    earlier = (
        Window.partitionBy("org_id", "kind").orderBy("moment", F.col("n").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    asked = marks.withColumn("kind", F.explode(F.array(*map(_kind, KINDS))))
    summed = per_moment.unionByName(asked, allowMissingColumns=True).select(
        "*", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return (
        summed.where(F.col("n").isNull()).groupBy("org_key", F.col("moment").alias("cutoff"))
        .agg(*[F.coalesce(F.sum(F.when(F.col("kind") == _kind(k), F.col("before"))), F.lit(0)).alias(k) for k in KINDS])
    )
