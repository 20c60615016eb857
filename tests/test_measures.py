"""Cutoff measures, views and screens on hand-written tables."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from commonspulse.functions import expressions as X
from commonspulse.operators import filters, measures, views

T = datetime


@pytest.fixture
def facts(rows):
    return {
        "organizations": rows("org_id bigint, login string", (1, "acme"), (2, "ACME"), (3, "quiet")),
        "repositories": rows("repo_id bigint, org_id bigint, is_fork boolean, created_at timestamp",
                             (10, 1, False, T(2020, 1, 1)), (11, 2, True, T(2020, 6, 1)), (12, 1, False, None)),
        "commits": rows("repo_id bigint, author_time timestamp, event_time timestamp",
                        (10, T(2020, 2, 1), None), (10, None, T(2020, 3, 1)), (11, None, None), (99, T(2020, 1, 1), None)),
        "issues": rows("repo_id bigint, created_at timestamp", (10, T(2020, 6, 1)), (12, T(2020, 5, 1))),
        "pulls": rows("repo_id bigint, created_at timestamp", (11, T(2020, 6, 1, 12)), (11, T(2020, 6, 1, 13))),
    }


def measure(rows, facts, *targets):
    frame = measures.cutoff_measures(rows("login string, cutoff timestamp", *targets), **facts)
    return {(r["login"], r["cutoff"]): r for r in frame.collect()}


def test_strictly_before_and_pooled_logins(rows, facts):
    midnight, noon = T(2020, 6, 1), T(2020, 6, 1, 13)
    found = measure(rows, facts, ("Acme", midnight), ("acme", noon))
    early, late = found["Acme", midnight], found["acme", noon]
    assert (early["repos"], early["original_repos"], early["forked_repos"]) == (1, 1, 0)
    # The event time stands in for a missing author time; no time is never before.
    assert early["commits"] == 2
    # Issues of a repository with unknown creation time count.
    assert (early["issues"], early["pulls"]) == (1, 0)
    assert (late["repos"], late["issues"], late["pulls"]) == (2, 2, 1)
    assert late["pull_log"] == pytest.approx(0.6931471805599453)
    assert (late["pull_dummy"], late["open_source_washer"], late["open_source_producer"]) == (1, 0, 1)


def test_unknown_and_silent_logins_get_a_row(rows, facts):
    found = measure(rows, facts, ("nobody", T(2021, 1, 1)), ("quiet", T(2021, 1, 1)))
    for row in found.values():
        assert row["repos"] == row["commits"] == row["pulls"] == 0
        assert (row["open_source_washer"], row["open_source_producer"], row["pull_log"]) == (1, 0, 0.0)


def test_many_cutoffs_of_a_hot_organization_equal_brute_force(spark, rows):
    """Half of all facts and cutoffs belong to one organization, many within a day."""
    chance = random.Random(7)
    def moment():
        return T(2020, 1, 1) + timedelta(minutes=chance.randrange(60 * 24 * 20) // 30 * 30)
    orgs = [(i, f"org{i}") for i in range(6)]
    repos = [(r, 0 if r % 2 else chance.randrange(6), bool(r % 3), moment()) for r in range(60)]
    commits = [(chance.randrange(60), moment() if chance.random() < .5 else None, moment()) for _ in range(3000)]
    issues = [(chance.randrange(60), moment()) for _ in range(800)]
    pulls = [(chance.randrange(60), moment()) for _ in range(800)]
    targets = sorted({("org0" if i % 2 else f"ORG{chance.randrange(6)}", moment()) for i in range(200)})
    frame = measures.cutoff_measures(
        rows("login string, cutoff timestamp", *targets),
        rows("org_id bigint, login string", *orgs),
        rows("repo_id bigint, org_id bigint, is_fork boolean, created_at timestamp", *repos),
        rows("repo_id bigint, author_time timestamp, event_time timestamp", *commits),
        rows("repo_id bigint, created_at timestamp", *issues),
        rows("repo_id bigint, created_at timestamp", *pulls))
    owner = {r[0]: f"org{r[1]}" for r in repos}
    for row in frame.collect():
        org, cutoff = row["login"].lower(), row["cutoff"]
        own = [r for r in repos if owner[r[0]] == org and r[3] < cutoff]
        assert (row["repos"], row["forked_repos"]) == (len(own), sum(r[2] for r in own))
        assert row["commits"] == sum(owner[r] == org and (a or e) < cutoff for r, a, e in commits)
        assert row["issues"] == sum(owner[r] == org and t < cutoff for r, t in issues)
        assert row["pulls"] == sum(owner[r] == org and t < cutoff for r, t in pulls)


def test_monthly_activity_leaves_out_commits_without_author_time(rows, facts):
    found = views.organization_monthly_activity(
        facts["commits"], facts["issues"], facts["pulls"], facts["repositories"], facts["organizations"])
    by_key = {(r["login"], r["month"]): (r["commits"], r["issues"], r["pull_requests"]) for r in found.collect()}
    assert by_key == {("acme", T(2020, 2, 1)): (1, 0, 0), ("acme", T(2020, 6, 1)): (0, 1, 0),
                      ("acme", T(2020, 5, 1)): (0, 1, 0), ("ACME", T(2020, 6, 1)): (0, 0, 2)}


def test_summary_takes_latest_stars_and_keeps_silent_organizations(rows, facts):
    snaps = rows("repo_id bigint, observed_at timestamp, stargazers_count int",
                 (10, T(2020, 1, 1), 5), (10, T(2021, 1, 1), 7), (11, T(2020, 1, 1), None))
    found = views.innovation_summary(facts["organizations"], facts["repositories"], snaps, facts["commits"],
                                     facts["issues"], facts["pulls"])
    by_login = {r["login"]: tuple(r)[1:] for r in found.collect()}
    assert by_login == {"acme": (2, 2, 0, 2, 2, 0, 7), "ACME": (1, 0, 1, 1, 0, 2, 0), "quiet": (0,) * 7}


def test_latest_snapshot_keeps_nulls_of_the_newest(rows):
    repos = rows("repo_id bigint, name string", (1, "a"), (2, "b"))
    snaps = rows("repo_id bigint, observed_at timestamp, stargazers_count int, forks_count int",
                 (1, T(2020, 1, 1), 5, 1), (1, T(2021, 1, 1), None, 2))
    found = {r["repo_id"]: (r["stargazers_count"], r["forks_count"], r["observed_at"])
             for r in views.repository_current(repos, snaps).collect()}
    assert found == {1: (None, 2, T(2021, 1, 1)), 2: (None, None, None)}


def test_eligibility_is_three_valued(rows):
    frame = rows("l string, p boolean, d int", ("Python", None, 5), ("Go", None, 5), (None, None, 5),
                 ("Python", True, 2), ("Python", True, 1), ("Python", False, 9))
    found = frame.select(X.setup_eligible(F.col("l"), F.col("p"), F.col("d")))
    assert [r[0] for r in found.collect()] == [None, False, False, True, False, False]


def test_default_phrases(rows):
    frame = rows("name string, description string", ("Deep", "learning"), ("x", "Speech Recognition kit"), (None, None),
                 ("predictive api", None), ("predictiveXapi", ""))
    assert [r["name"] for r in filters.keyword_matches(frame).collect()] == ["Deep", "x", "predictive api"]


def test_phrases_are_plain_text(rows):
    frame = rows("name string, description string", ("a.b", ""), ("axb", ""))
    assert [r["name"] for r in filters.keyword_matches(frame, ["a.b"]).collect()] == ["a.b"]


def test_window_bounds_are_inclusive_and_null_times_stay(rows):
    frame = rows("id int, created_at timestamp", (1, T(2020, 1, 1)), (2, T(2020, 2, 1)), (3, T(2020, 2, 2)), (4, None),
                 (5, T(2019, 12, 31)))
    kept = filters.in_window(frame, T(2020, 1, 1), T(2020, 2, 1))
    assert [r["id"] for r in kept.collect()] == [1, 2, 4]
    assert filters.in_window(frame, None, None).count() == 5
