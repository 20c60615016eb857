"""Organization-by-month panels and their period summaries.

Counts and sums shrink to one row per organization and month before any
shuffle.  The two distinct counts are a second, narrow pass that reads ids only
and groups by (organization, month, id) first, so the rows of one busy
organization spread over all tasks.  In one grouping Spark would instead carry
every count along with every id.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commonspulse import constants as C
from commonspulse.functions.expressions import as_bigint, month_of, month_text, push_commits, push_size, scalar_text
from commonspulse.operators import bloom
from commonspulse.operators.filters import login_panel_types, months_between, with_org_login
from commonspulse.sources.months import month_bounds


def _counted(rows: DataFrame, keys: Sequence[str], counts: dict[str, Column], distinct: dict[str, str],
             order: Sequence[str], held: DataFrame | None = None) -> DataFrame:
    """Aggregates per key, and how many different non-null values each ``distinct`` column has.

    ``held`` are narrower rows that hold all the values of the ``distinct``
    columns, where ``rows`` would need more to be read.
    """
    added = rows.groupBy(*keys).agg(*[value.alias(name) for name, value in counts.items()])
    names = list(distinct)
    ids = F.array(*[F.struct(F.lit(n).alias("slot"), F.col(distinct[n]).alias("id")) for n in names])
    different = (rows if held is None else held).select(*keys, F.inline(ids)).where(F.col("id").isNotNull()).distinct()
    counted = different.groupBy(*keys).agg(*[F.count_if(F.col("slot") == n).alias(n) for n in names])
    counted = counted.select(*[F.col(k).alias(f"_{k}") for k in keys], *names)
    same = [added[k].eqNullSafe(counted[f"_{k}"]) for k in keys]  # a null month is a group like any other
    whole = added.join(counted, same, "left")
    return whole.select(*keys, *[F.coalesce(m, F.lit(0)).alias(m) if m in names else m for m in order])


def login_month_panel(events: DataFrame) -> DataFrame:
    """Eleven metrics per lower-case organization login and month.

    Counts seven event types of events that name an organization.  Event ids
    are not deduplicated here.
    """
    return login_panel_of_rows(login_panel_rows(events))


def login_panel_rows(events: DataFrame) -> DataFrame:
    """What the panel counts of each event, narrow enough to be stored: the payload is read here and not again."""
    kind, payload = F.col("type"), F.col("payload")
    # One JSON path per event type, so each payload is parsed at most once.
    detail = (
        F.when(kind == "CreateEvent", F.get_json_object(payload, "$.ref_type"))
        .when(kind.isin("IssuesEvent", "PullRequestEvent", "WatchEvent", "ReleaseEvent"),
              F.get_json_object(payload, "$.action"))
    )
    return with_org_login(login_panel_types(events)).select(
        F.lower("org.login").alias("org_login"),
        month_of(F.col("created_at")).alias("month"),
        F.col("repo.id").alias("repo_id"),
        F.col("actor.id").alias("actor_id"),
        kind.alias("kind"),
        detail.alias("detail"),
        push_commits(kind, payload).alias("commits"),
    )


def login_panel_of_rows(rows: DataFrame) -> DataFrame:
    """The panel of ``login_panel_rows``."""
    kind, detail = F.col("kind"), F.col("detail")

    def seen(event: str, value: str | None = None) -> Column:
        hit = kind == event
        return F.count_if(hit if value is None else hit & (detail == value))

    return _counted(rows, ["org_login", "month"], {
        "public_events": F.count(F.lit(1)),
        "push_events": seen("PushEvent"),
        "commits_in_pushes": F.sum("commits"),
        "issues_opened": seen("IssuesEvent", "opened"),
        "pull_requests_opened": seen("PullRequestEvent", "opened"),
        "repositories_created": seen("CreateEvent", "repository"),
        "fork_events": seen("ForkEvent"),
        "star_events": seen("WatchEvent", "started"),
        "release_events": seen("ReleaseEvent", "published"),
    }, {"active_repositories": "repo_id", "distinct_actors": "actor_id"}, C.LOGIN_PANEL_METRICS)


def attribute_forks(typed: DataFrame) -> DataFrame:
    """One row per event and organization it counts for.

    A fork counts for the organization of its source and for the owner of its
    destination, for both even when they are the same.  Other events count
    once; events without organization id vanish.
    """
    roles = F.array(
        F.struct(F.col("event_org_id").alias("organization_id"),
                 F.lit(C.ROLE_ACTIVITY).alias("attribution_type")),
        F.struct(F.col("fork_destination_org_id").alias("organization_id"),
                 F.lit(C.ROLE_FORK_DESTINATION).alias("attribution_type")),
    )
    known = F.filter(roles, lambda r: r["organization_id"].isNotNull())
    return typed.select("*", F.inline(known)).drop("event_org_id", "fork_destination_org_id")


def of_targets(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows of target organizations; Spark broadcasts the ids when they are small."""
    ids = targets.select("organization_id").distinct()
    return rows.join(ids, "organization_id", "left_semi")


def targeted_events(typed: DataFrame, targets: DataFrame) -> DataFrame:
    """Attributed events whose organization or fork destination is a target."""
    return of_targets(attribute_forks(typed), targets)


def targeted_events_of_many(typed: DataFrame, targets: DataFrame, megabytes: float = 8) -> DataFrame:
    """The same rows for millions of targets.

    A Bloom filter of at most ``megabytes`` is tested on the organization and on
    the fork's owner of each event first, so that next to no row of others is
    unfolded or shuffled.
    """
    words = bloom.bloom_words(targets, "organization_id", megabytes)
    near = (
        bloom.might_hold(words, F.col("event_org_id"), megabytes)
        | bloom.might_hold(words, F.col("fork_destination_org_id"), megabytes)
    )
    return targeted_events(typed.where(near), targets)


def target_month_panel(events: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """Sixteen metrics per organization id and month, over events of every type.

    ``targets`` limits the panel to its ids, before the aggregation; Spark
    chooses how to join them from their size.
    """
    return typed_target_panel(_panel_columns(events), targets)


def typed_target_panel(typed: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """The same panel from typed events, such as those of the typed month table.

    Only what an organization did itself has repositories and actors to tell
    apart, so the distinct counts leave fork destinations alone: in a panel of
    raw events their pass reads no payload.
    """
    attributed = attribute_forks(typed)
    held = typed.where(F.col("event_org_id").isNotNull()).select(
        F.col("event_org_id").alias("organization_id"), "month", "repo_id", "actor_id")
    if targets is not None:
        attributed, held = of_targets(attributed, targets), of_targets(held, targets)
    return _target_metrics(attributed, held)


def _panel_columns(events: DataFrame) -> DataFrame:
    """The typed columns the target panel needs, with at most one JSON path for most event types."""
    kind, payload = F.col("type"), F.col("payload")

    def at(path: str, *kinds: str) -> Column:
        return F.when(kind.isin(*kinds), F.get_json_object(payload, path))

    found = events.select(
        kind.alias("event_type"), "payload", "created_at", "actor", "repo", "org",
        at("$.action", "IssuesEvent", "IssueCommentEvent", "PullRequestEvent", "WatchEvent", "ReleaseEvent").alias("event_action"),
        at("$.ref_type", "CreateEvent").alias("ref_type"),
        at("$.pull_request.merged", "PullRequestEvent").alias("merged"),
        at("$.forkee.owner.id", "ForkEvent").alias("owner"),
        at("$.size", "PushEvent").alias("size"),
    )
    return found.select(
        "event_type", "event_action", "ref_type",
        F.col("actor.id").alias("actor_id"),
        F.col("repo.id").alias("repo_id"),
        as_bigint(F.col("org.id")).alias("event_org_id"),
        as_bigint(scalar_text(F.col("owner"))).alias("fork_destination_org_id"),
        push_size(F.col("event_type"), scalar_text(F.col("size")), F.col("payload")).alias("commits_in_push"),
        F.lower("merged").alias("pull_request_merged"),
        month_of(F.col("created_at")).alias("month"),
    )


def _target_metrics(attributed: DataFrame, held: DataFrame) -> DataFrame:
    own = F.col("attribution_type") == C.ROLE_ACTIVITY
    # A fork destination contributes nothing but the fork itself.
    rows = attributed.select(
        "organization_id", "month", own.alias("own"),
        *[F.when(own, F.col(c)).alias(c) for c in ("event_type", "event_action", "ref_type", "commits_in_push", "pull_request_merged")],
    )
    kind = F.col("event_type")
    detail = F.when(kind == "CreateEvent", F.col("ref_type")).otherwise(F.col("event_action"))

    def seen(event: str, value: str | None = None) -> Column:
        hit = kind == event
        return F.count_if(hit if value is None else hit & (detail == value))

    return _counted(rows, ["organization_id", "month"], {
        "public_events": F.count_if("own"),
        "push_events": seen("PushEvent"),
        "commits_in_pushes": F.coalesce(F.sum("commits_in_push"), F.lit(0)),
        "issues_opened": seen("IssuesEvent", "opened"),
        "issues_closed": seen("IssuesEvent", "closed"),
        "issue_comments_created": seen("IssueCommentEvent", "created"),
        "pull_requests_opened": seen("PullRequestEvent", "opened"),
        "pull_requests_closed": seen("PullRequestEvent", "closed"),
        "pull_requests_merged": F.count_if(
            (kind == "PullRequestEvent") & (detail == "closed") & (F.col("pull_request_merged") == "true")),
        "original_repositories_created": seen("CreateEvent", "repository"),
        "forked_repositories_created": F.count_if(~F.col("own")),
        "forks_received": seen("ForkEvent"),
        "stars_received": seen("WatchEvent", "started"),
        "releases_published": seen("ReleaseEvent", "published"),
    }, {"active_repositories": "repo_id", "distinct_actors": "actor_id"}, C.TARGET_PANEL_METRICS, held)


def months_seen(observed: DataFrame, keys: Sequence[str], metrics: Sequence[str],
                *more: Column) -> DataFrame:
    """One row per entity: a map from month to metrics, never larger than the months there are."""
    entry = F.struct(F.col("month"), F.struct(*[F.coalesce(m, F.lit(0)).alias(m) for m in metrics]))
    return observed.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("seen"), *more)


def filled_months(first: date, last: date, metrics: Sequence[str], text: bool = False) -> Column:
    """Array of one struct per month of the range from ``seen``, zero where nothing was observed."""
    def found(month: Column) -> Column:
        return F.struct(month.alias("month"), F.col("seen")[month].alias("values"))

    def item(entry: Column) -> Column:
        month = entry["month"]
        return F.struct(
            (month_text(month) if text else month).alias("month"),
            *[F.coalesce(entry["values"][m], F.lit(0).cast("bigint")).alias(m) for m in metrics],
        )

    # One lookup per month, then the metrics of what it found.
    months = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month"))
    return F.transform(F.transform(months, found), item)


def dense_panel(observed: DataFrame, keys: Sequence[str], metrics: Sequence[str], start: str | date,
                end: str | date, entities: DataFrame | None = None) -> DataFrame:
    """Every entity in every month of the range; months without a row are zero.

    Without ``entities`` they are those of the panel.  The months of an entity
    are filled in within its row and then unfolded: nothing is crossed, and the
    only join is one row per entity.
    """
    first, last = month_bounds(start, end)
    rows = months_seen(months_between(observed, first, last), keys, metrics)
    names = list(keys)
    if entities is not None:
        rows, names = entities.join(rows, list(keys), "left"), entities.columns
    return rows.select(*names, F.inline(filled_months(first, last, metrics)))


def period_totals(panel: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Sums over the period; pass only metrics that may be summed."""
    wrong = set(metrics) & set(C.NON_ADDITIVE_METRICS)
    if wrong:
        raise ValueError(f"Monthly distinct counts do not add up over months: {sorted(wrong)}")
    return panel.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in metrics])


def activity_summary_columns() -> list[Column]:
    """Aggregates over the months of one organization for what must not be summed as unique."""
    columns = [F.count_if(F.col("public_events") > 0).alias("months_with_activity")]
    for metric in C.NON_ADDITIVE_METRICS:
        columns.append(F.sum(metric).alias(f"sum_monthly_{metric}"))
        columns.append(F.greatest(F.max(metric), F.lit(0)).alias(f"max_monthly_{metric}"))
    return columns


def activity_summary(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    return panel.groupBy(*keys).agg(*activity_summary_columns())


def activity_totals(panel: DataFrame) -> DataFrame:
    """First and last month seen and the additive sums of each organization."""
    return panel.groupBy("org_login").agg(
        F.min("month").alias("first_active_month"),
        F.max("month").alias("last_active_month"),
        *[F.sum(m).alias(m) for m in C.LOGIN_ADDITIVE_METRICS],
    )


def month_rollup(panel: DataFrame) -> DataFrame:
    """Organizations seen and public events per month."""
    return panel.groupBy("month").agg(
        F.count(F.lit(1)).alias("organizations"), F.sum("public_events").alias("public_events")
    )


def daily_counts(event_table: DataFrame) -> DataFrame:
    """Events per organization login (null is its own group), day and type."""
    return event_table.groupBy(
        "org_login", F.date_trunc("day", "created_at").alias("day"), "event_type"
    ).agg(F.count(F.lit(1)).alias("events"))


def top_organizations(totals: DataFrame, k: int = 100) -> DataFrame:
    return totals.orderBy(F.desc("public_events"), "org_login").limit(k)
