"""Row filters."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commonspulse import constants as C
from commonspulse.functions.expressions import phrase_screen
from commonspulse.operators import bloom
from commonspulse.sources.months import month_bounds


def archive_types(events: DataFrame) -> DataFrame:
    return events.where(F.col("type").isin(*C.ARCHIVE_EVENT_TYPES))


def login_panel_types(events: DataFrame) -> DataFrame:
    return events.where(F.col("type").isin(*C.LOGIN_PANEL_EVENT_TYPES))


def with_org_login(events: DataFrame) -> DataFrame:
    """Events that name an organization; an empty login counts as named."""
    return events.where(F.col("org.login").isNotNull())


def of_organization(events: DataFrame, org: str) -> DataFrame:
    """Events in a repository owned by ``org`` or tagged with it, ignoring case."""
    wanted = org.lower()
    repo = F.lower(F.coalesce(F.col("repo.name"), F.lit("")))
    tag = F.lower(F.coalesce(F.col("org.login"), F.lit("")))
    return events.where(repo.startswith(wanted + "/") | (tag == wanted))


def _owner_and_tag() -> tuple[Column, Column]:
    name = F.lower(F.col("repo.name"))
    owner = F.when(F.instr(name, "/") > 0, F.substring_index(name, "/", 1))
    return owner, F.lower(F.col("org.login"))


def of_organizations(events: DataFrame, logins: DataFrame) -> DataFrame:
    """The same match for a table of logins: one row per event and matched login.

    Owner and tag of an event are at most two different keys, so the events
    grow by at most two before an equality join.
    """
    keys = F.array_compact(F.array_distinct(F.array(*_owner_and_tag())))
    wanted = logins.select(F.lower("login").alias("matched_org")).distinct()
    return events.withColumn("matched_org", F.explode(keys)).join(wanted, "matched_org", "left_semi")


def of_any_organization(events: DataFrame, logins: DataFrame) -> DataFrame:
    """Events that match at least one login, each once.

    Events without a tag look up their owner twice, so they do not meet on one
    null key.
    """
    owner, tag = _owner_and_tag()
    wanted = logins.select(F.lower("login").alias("_login")).distinct()
    by_owner, by_tag = (wanted.select(F.col("_login").alias(k), F.lit(True).alias(f"{k}_hit")) for k in ("_owner", "_tag"))
    keyed = events.withColumns({"_owner": F.coalesce(owner, tag), "_tag": F.coalesce(tag, owner)})
    return (
        keyed.join(by_owner, "_owner", "left").join(by_tag, "_tag", "left")
        .where(F.coalesce("_owner_hit", "_tag_hit", F.lit(False)))
        .select(*events.columns)
    )


def of_any_organization_of_many(events: DataFrame, logins: DataFrame, megabytes: float = 8) -> DataFrame:
    """The same rows for more logins than can be sent to every task.

    A Bloom filter of at most ``megabytes`` is tested on owner and tag first, so
    the joins shuffle next to nothing but events that match.
    """
    wanted = logins.select(F.lower("login").alias("login"))
    words = bloom.bloom_words(wanted, "login", megabytes)
    owner, tag = _owner_and_tag()
    near = bloom.might_hold(words, owner, megabytes) | bloom.might_hold(words, tag, megabytes)
    return of_any_organization(events.where(near), wanted)


def in_window(rows: DataFrame, since: Column | datetime | None, until: Column | datetime | None,
              column: str = "created_at") -> DataFrame:
    """Drop rows before ``since`` or after ``until``; both bounds and null times stay."""
    moment = F.col(column)
    if since is not None:
        low = since if isinstance(since, Column) else F.lit(since)
        rows = rows.where(~F.coalesce(moment < low, F.lit(False)))
    if until is not None:
        high = until if isinstance(until, Column) else F.lit(until)
        rows = rows.where(~F.coalesce(moment > high, F.lit(False)))
    return rows


def without_pull_requests(issues: DataFrame, text: str = "object") -> DataFrame:
    """Issue objects without a ``pull_request`` key, whatever the key's value."""
    return issues.where(
        ~F.coalesce(F.array_contains(F.json_object_keys(text), "pull_request"), F.lit(False))
    )


def select_repositories(repos: DataFrame, names: Column | Iterable[str] | None = None,
                        include_archived: bool = True, include_forks: bool = True,
                        prefix: str = "") -> DataFrame:
    """Keep repositories by name (case ignored; no names means all) and by kind.

    ``names`` may be an array column, for a different selection per row.
    """
    name = F.lower(F.col(f"{prefix}name"))
    if isinstance(names, Column):
        wanted = F.transform(names, F.lower)
        rows = repos.where(F.coalesce(F.size(wanted) == 0, F.lit(True)) | F.array_contains(wanted, name))
    else:
        chosen = [n.lower() for n in names or []]
        rows = repos.where(name.isin(*chosen)) if chosen else repos
    if not include_archived:
        rows = rows.where(~F.coalesce(F.col(f"{prefix}archived"), F.lit(False)))
    if not include_forks:
        rows = rows.where(~F.coalesce(F.col(f"{prefix}fork"), F.lit(False)))
    return rows


def organizations_only(objects: DataFrame, kind: str = "o.type") -> DataFrame:
    return objects.where(F.col(kind) == C.ORGANIZATION_TYPE)


def rejected_accounts(objects: DataFrame, kind: str = "o.type") -> DataFrame:
    """Objects that are not organization accounts, a missing type included."""
    return objects.where(~F.col(kind).eqNullSafe(F.lit(C.ORGANIZATION_TYPE)))


def keyword_matches(rows: DataFrame, phrases: Iterable[str] = C.SCREEN_PHRASES) -> DataFrame:
    return rows.where(phrase_screen(F.col("name"), F.col("description"), phrases))


def before_cutoff(rows: DataFrame, moment: Column, cutoff: Column) -> DataFrame:
    """Strictly before the cutoff; an unknown time is never before it."""
    return rows.where(moment < cutoff)


def months_between(panel: DataFrame, start: str | date, end: str | date) -> DataFrame:
    first, last = month_bounds(start, end)
    return panel.where(F.col("month").between(F.lit(first), F.lit(last)))


def login_equals(rows: DataFrame, login: str, column: str = "login") -> DataFrame:
    return rows.where(F.lower(column) == login.lower())
