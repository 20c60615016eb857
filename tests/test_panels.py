"""Panels on hand-written events: attribution, JSON and counting rules."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from commonspulse import constants as C
from commonspulse import schemas
from commonspulse.functions import expressions as X
from commonspulse.operators import panels, projections
from commonspulse.plans import documents
from commonspulse.sources import archive


def event(id, type, payload, org=(1, "Acme"), repo=10, actor=5, at=datetime(2020, 2, 3)):
    return (id, type, at, (actor, "u"), (repo, "acme/r"), None if org is None else (str(org[0]), org[1]), payload)


@pytest.fixture
def events(rows):
    return rows(
        schemas.RAW_EVENT,
        event("1", "PushEvent", '{"commits":[{"sha":"a"},{"sha":"b"}]}'),
        event("2", "PushEvent", '{"size":"3","commits":[{"sha":"a"}]}', org=(1, "ACME"), repo=11),
        event("3", "PushEvent", '{"commits":{"sha":"a"}}', repo=None),
        event("4", "PushEvent", '{"size":3.0,"commits":[]}'),
        event("5", "IssuesEvent", '{"action":"opened"}', actor=None),
        event("6", "IssuesEvent", '{"action":{"name":"opened"}}'),
        event("7", "IssueCommentEvent", '{"action":"created"}', actor=6),
        event("8", "ForkEvent", '{"forkee":{"owner":{"id":1}}}'),
        event("9", "ForkEvent", '{"forkee":{"owner":{"id":2}}}', org=None),
        event("10", "CreateEvent", '{"ref_type":"repository"}', org=(1, "")),
        event("11", "CreateEvent", '{"ref_type":null}'),
        event("12", "PullRequestEvent", '{"action":"closed","pull_request":{"merged":true}}'),
        event("12", "PullRequestEvent", '{"action":"closed","pull_request":{"merged":true}}'),
        event("13", "WatchEvent", '{"action":"started"}', at=datetime(2020, 3, 31, 23, 59, 59)),
        event("14", "ReleaseEvent", None),
    )


def one(frame, **key):
    found = [r for r in frame.collect() if all(r[k] == v for k, v in key.items())]
    assert len(found) == 1
    return found[0]


def test_login_panel(events):
    panel = panels.login_month_panel(events)
    feb = one(panel, org_login="acme", month=date(2020, 2, 1))
    # Both spellings are one organization; comments do not count; replays do.
    assert feb["public_events"] == 11
    assert feb["push_events"] == 4
    # The list length only: an object or an empty list is no commit.
    assert feb["commits_in_pushes"] == 3
    assert feb["issues_opened"] == 1
    assert (feb["active_repositories"], feb["distinct_actors"]) == (2, 1)
    assert feb["fork_events"] == 1 and feb["repositories_created"] == 0
    assert one(panel, org_login="", month=date(2020, 2, 1))["repositories_created"] == 1
    assert one(panel, org_login="acme", month=date(2020, 3, 1))["star_events"] == 1


def test_target_panel(events, rows):
    targets = rows("organization_id bigint, historical_login string", (1, "acme"), (2, None), (9, "silent"))
    panel = panels.target_month_panel(events, targets)
    feb = one(panel, organization_id=1, month=date(2020, 2, 1))
    # Every event type counts, with or without login.
    assert feb["public_events"] == 13
    # "3" is a number, 3.0 is not: then the list counts.
    assert feb["commits_in_pushes"] == 2 + 3 + 0 + 0
    assert feb["issue_comments_created"] == 1 and feb["pull_requests_merged"] == 2
    # A fork into itself counts in both roles.
    assert feb["forks_received"] == 1 and feb["forked_repositories_created"] == 1
    fork_only = one(panel, organization_id=2)
    assert fork_only["public_events"] == 0 and fork_only["forked_repositories_created"] == 1
    assert fork_only["active_repositories"] == 0
    assert {r["organization_id"] for r in panel.collect()} == {1, 2}


def test_typed_events_drop_nested_values(events):
    typed = {r["event_id"]: r for r in projections.typed_events(events).collect()}
    assert typed["6"]["event_action"] is None and typed["5"]["event_action"] == "opened"
    assert typed["11"]["ref_type"] is None
    assert typed["12"]["pull_request_merged"] == "true"


def test_scalar_text_keeps_text_that_only_looks_nested(rows):
    found = X.json_scalars(rows("p string", ('{"a":"[draft] x"}',), ('{"a":[1]}',), ('{"a":false}',), ('{"a":null}',)),
                           "p", a="$.a")
    assert [r["a"] for r in found.collect()] == ["[draft] x", None, "false", None]


def test_dense_panel_has_every_month_and_keeps_sums(events):
    panel = panels.login_month_panel(events)
    dense = panels.dense_panel(panel, ["org_login"], C.LOGIN_PANEL_METRICS, "2020-01", "2020-12")
    assert dense.count() == 2 * 12
    assert dense.agg(F.sum("public_events")).first()[0] == panel.agg(F.sum("public_events")).first()[0]
    assert dense.where("month = '2020-07-01'").agg(F.sum("public_events")).first()[0] == 0


def test_totals_refuse_distinct_counts(events):
    with pytest.raises(ValueError):
        panels.period_totals(panels.login_month_panel(events), ["org_login"], C.LOGIN_PANEL_METRICS)


def test_login_documents_sum_what_adds_up_and_summarise_the_rest(rows):
    chance = random.Random(29)
    metrics = C.LOGIN_PANEL_METRICS
    held = {(login, month): [chance.randrange(1, 90) for _ in metrics]
            for login in ("Birch.Lab", "cedar") for month in (2, 3, 6, 11) if (login, month) != ("cedar", 6)}
    panel = rows("org_login string, month date, " + ", ".join(f"{m} bigint" for m in metrics),
                 *[(login, date(2022, month, 1), *values) for (login, month), values in held.items()],
                 ("silent", date(2021, 12, 1), *[5] * len(metrics)))
    found = {d["safe_login"]: d for d in documents.login_documents(panel, "2022-02", "2022-07").collect()}
    assert {name: d["shard"] for name, d in found.items()} == {"birch-lab": "bi", "cedar": "ce"}
    for login, name in (("Birch.Lab", "birch-lab"), ("cedar", "cedar")):
        document = found[name]["document"]
        own = {m: dict(zip(metrics, v, strict=True)) for (o, m), v in held.items() if o == login and m <= 7}
        assert [m["month"] for m in document["monthly"]] == [f"2022-{k:02d}" for k in range(2, 8)]
        for k, month in enumerate(document["monthly"], 2):
            assert {m: month[m] for m in metrics} == own.get(k, dict.fromkeys(metrics, 0))
        for metric in C.LOGIN_ADDITIVE_METRICS:
            assert document["totals"][metric] == sum(v[metric] for v in own.values())
        summary = document["monthly_activity_summary"]
        assert summary["months_with_activity"] == len(own)
        for metric in C.NON_ADDITIVE_METRICS:
            assert summary[f"max_monthly_{metric}"] == max(v[metric] for v in own.values())
            assert summary[f"sum_monthly_{metric}"] == sum(v[metric] for v in own.values())


def test_file_names(rows):
    logins = rows("l string", ("A__b",), ("-x-",), ("!!",), ("É",), ("ab",))
    safe = X.safe_login(F.col("l"))
    assert [tuple(r) for r in logins.select(safe, X.shard_of(safe)).collect()] == [
        ("a-b", "a-"), ("x", "x_"), ("unknown", "un"), ("unknown", "un"), ("ab", "ab")]


def test_colliding_names_leave_every_login_a_file(rows):
    panel = rows("org_login string, month date, " + ", ".join(f"{m} bigint" for m in C.LOGIN_PANEL_METRICS),
                 *[(login, date(2025, 1, 1), *[1] * 11) for login in ("a.b", "a_b", "c")])
    named = {r["org_login"]: r["safe_login"] for r in documents.named_apart(
        documents.login_documents(panel, "2025-01", "2025-01")).collect()}
    assert named["a_b"] == "a-b" and named["c"] == "c"
    assert named["a.b"].startswith("a-b-") and len(set(named.values())) == 3


def test_null_month_keeps_its_distinct_counts(events):
    undated = events.withColumn("created_at", F.lit(None).cast("timestamp"))
    found = panels.target_month_panel(undated).collect()
    assert found and all(r["month"] is None for r in found)
    assert any(r["distinct_actors"] > 0 for r in found)


def test_hot_organization_equals_brute_force(rows):
    """More than a third of all events on one organization, many repositories and actors."""
    chance = random.Random(3)
    kinds = ("PushEvent", "IssuesEvent", "ForkEvent", "WatchEvent", "GollumEvent")
    many = []
    for i in range(3000):
        org = 0 if i % 2 else chance.randrange(20)
        many.append(event(str(i), chance.choice(kinds), chance.choice(('{"action":"opened"}', '{"action":"started"}', "{}")),
                          org=(org, f"Org{org}"), repo=chance.choice((None, *range(50))), actor=chance.randrange(200),
                          at=datetime(2020, 1 + i % 3, 1 + i % 28)))
    found = {(r["org_login"], r["month"]): r for r in panels.login_month_panel(rows(schemas.RAW_EVENT, *many)).collect()}
    groups = {}
    for e in many:
        if e[1] in C.LOGIN_PANEL_EVENT_TYPES:
            groups.setdefault((e[5][1].lower(), e[2].date().replace(day=1)), []).append(e)
    assert set(found) == set(groups)
    for key, own in groups.items():
        row = found[key]
        assert row["public_events"] == len(own)
        assert row["active_repositories"] == len({e[4][0] for e in own} - {None})
        assert row["distinct_actors"] == len({e[3][0] for e in own})
        assert row["star_events"] == sum(e[1] == "WatchEvent" and "started" in e[6] for e in own)


def test_panel_plan_combines_before_the_shuffle(events):
    plan = panels.login_month_panel(events)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Expand" not in plan and "Window" not in plan


def test_target_panel_reads_the_payload_once(spark, events, rows, tmp_path):
    events.write.parquet(str(tmp_path / "raw"))
    targets = rows("organization_id bigint", (1,), (2,))
    panel = panels.target_month_panel(spark.read.parquet(str(tmp_path / "raw")), targets)
    plan = panel._jdf.queryExecution().executedPlan().toString()
    read = [part.split("\n")[0] for part in plan.split("ReadSchema: ")[1:]]
    assert len(read) == 2 and sum("payload" in part for part in read) == 1
    assert sorted(map(tuple, panel.collect())) == sorted(map(tuple, panels.target_month_panel(events, targets).collect()))


def test_typed_months_give_the_panel_of_the_raw_events(spark, events, rows, tmp_path):
    many = events.unionByName(events.where("id in ('1', '8', '9')").withColumn("created_at", F.lit(None).cast("timestamp")))
    targets = rows("organization_id bigint", (1,), (2,), (9,))
    typed = projections.typed_events(many)
    path = str(tmp_path / "typed")
    archive.write_typed_months(typed, path)
    stored = archive.scan_typed_months(spark, path)
    assert stored.columns == typed.columns
    assert sorted(map(str, stored.collect())) == sorted(map(str, typed.collect()))
    for chosen in (targets, None):
        expected = sorted(map(str, panels.target_month_panel(many, chosen).collect()))
        panel = panels.typed_target_panel(stored, chosen)
        assert sorted(map(str, panel.collect())) == expected and len(expected) >= 3
        assert "get_json_object" not in panel._jdf.queryExecution().executedPlan().toString()
    march = archive.scan_typed_months(spark, path, "2020-03", "2020-03")
    assert {r["month"] for r in march.collect()} == {date(2020, 3, 1)}
    assert "PartitionFilters: [isnotnull(event_month" in march._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        archive.scan_typed_months(spark, path, "2020-03")


def test_a_month_of_the_typed_table_is_renewed_alone(spark, events, tmp_path):
    typed, path = projections.typed_events(events), str(tmp_path / "typed")
    archive.write_typed_months(typed, path)
    february = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "typed").glob("event_month=202002/*.parquet")}
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        archive.write_typed_months(typed.where("event_id = '13'").withColumn("event_id", F.lit("renewed")), path)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert {str(f): f.stat().st_mtime_ns for f in (tmp_path / "typed").glob("event_month=202002/*.parquet")} == february
    assert [r["event_id"] for r in archive.scan_typed_months(spark, path, "2020-03", "2020-03").collect()] == ["renewed"]


def test_typed_panel_of_no_events(spark, events, rows):
    none = projections.typed_events(events.limit(0))
    assert panels.typed_target_panel(none, rows("organization_id bigint", (1,))).count() == 0
