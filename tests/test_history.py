"""Snapshots before cutoffs, coverage, many targets, undecodable lines."""

import gzip
import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from commonspulse.operators import bloom, coverage, history, panels
from commonspulse.sources import archive

SNAPSHOTS = "repo_id bigint, observed_at timestamp, stargazers_count int, forks_count int"
START = datetime(2023, 5, 30)


def test_snapshots_equal_brute_force_with_a_hot_repository(rows):
    chance = random.Random(11)
    taken, pairs = [], []
    for i in range(900):
        repo = 0 if i % 2 else chance.choice([None, *range(1, 12)])
        moment = START + timedelta(minutes=30 * chance.randrange(400))
        taken.append((repo, moment, chance.choice([None, *range(50)]), i))
        pairs.append((chance.choice([None, *range(14)]), None if i % 50 == 0 else START + timedelta(minutes=30 * chance.randrange(-20, 420)), f"p{i % 300}"))
    frame = rows("repo_id bigint, cutoff timestamp, note string", *pairs, *pairs[:5])

    def expected(pair):
        own = [t for t in taken if t[0] is not None and t[0] == pair[0] and pair[1] is not None and t[1] < pair[1]]
        # A null is less than any number.
        best = max(own, key=lambda t: (t[1], -1 if t[2] is None else t[2], t[3]), default=(None,) * 4)
        return (*pair, *best[1:])

    for grain in ("hour", "day", "year"):
        found = history.snapshots_before(rows(SNAPSHOTS, *taken), frame, grain=grain)
        assert sorted(map(repr, map(tuple, found.collect()))) == sorted(repr(expected(p)) for p in [*pairs, *pairs[:5]])


def test_snapshots_keep_the_pair_columns_and_empty_tables(rows):
    pairs = rows("found string, repo_id bigint, cutoff timestamp, own int, range int", ("x", 1, START, 2, 3))
    got = history.snapshots_before(rows(SNAPSHOTS, (1, START, 4, 4), (1, START - timedelta(days=400), 9, 8)), pairs).collect()
    assert [tuple(r) for r in got] == [("x", 1, START, 2, 3, START - timedelta(days=400), 9, 8)]
    assert [tuple(r)[5:] for r in history.snapshots_before(rows(SNAPSHOTS), pairs).collect()] == [(None, None, None)]
    assert history.snapshots_before(rows(SNAPSHOTS, (1, START, 4, 4)), pairs.limit(0)).collect() == []


def test_gaps_are_runs_within_a_month(rows):
    lost = {datetime(2024, 1, 31, h) for h in (4, 5, 9, 22, 23)} | {datetime(2024, 2, 1)}
    every = [datetime(2024, 1, 1) + timedelta(hours=i) for i in range((31 + 29) * 24)]
    seen = rows("archive_hour timestamp", *[(h + timedelta(minutes=3),) for h in every if h not in lost], (None,), (every[0],))
    found = coverage.gaps(seen, "2024-01", "2024-02").orderBy("gap_start").collect()
    assert [(r["gap_start"], r["gap_end"], r["hours"]) for r in found] == [
        (datetime(2024, 1, 31, 4), datetime(2024, 1, 31, 6), 2), (datetime(2024, 1, 31, 9), datetime(2024, 1, 31, 10), 1),
        (datetime(2024, 1, 31, 22), datetime(2024, 2, 1), 2), (datetime(2024, 2, 1), datetime(2024, 2, 1, 1), 1)]
    months = coverage.month_coverage(seen, "2024-01", "2024-03").orderBy("month").collect()
    assert [tuple(r)[1:] for r in months] == [
        (744, 739, 2, "partly observed"), (696, 695, 1, "partly observed"), (744, 0, 744, "not observed")]


def test_panel_rows_tell_zero_from_unobserved(rows):
    seen = rows("archive_hour timestamp", *[(datetime(2021, 2, 1) + timedelta(hours=i),) for i in range(28 * 24)])
    panel = rows("org string, month date, n bigint", ("a", date(2021, 2, 1), 0), ("a", date(2021, 3, 1), 0), ("a", None, 0))
    found = coverage.with_coverage(panel, coverage.month_coverage(seen, "2021-02", "2021-03")).collect()
    assert {r["month"]: (r["observed_hours"], r["coverage"]) for r in found} == {
        date(2021, 2, 1): (672, "observed"), date(2021, 3, 1): (0, "not observed"), None: (0, "not observed")}


def test_bloom_filter_holds_every_target_and_few_strangers(spark, rows):
    targets = spark.range(0, 40000, 2).select((F.col("id") * 7919 - 5).alias("t")).union(rows("t bigint", (None,)))
    words = bloom.bloom_words(targets, "t", 0.05)
    asked = spark.range(40000).select((F.col("id") * 7919 - 5).alias("t"), (F.col("id") % 2 == 0).alias("target"))
    passed = asked.where(bloom.might_hold(words, F.col("t"), 0.05)).groupBy("target").count().collect()
    counts = {r["target"]: r["count"] for r in passed}
    assert counts[True] == 20000 and counts.get(False, 0) < 1000
    assert asked.where(bloom.might_hold(bloom.bloom_words(targets.limit(0), "t", 0.01), F.col("t"), 0.01)).count() == 0
    assert rows("t bigint", (None,)).where(bloom.might_hold(words, F.col("t"), 0.05)).count() == 0


def test_many_targets_are_filtered_below_the_exchange(spark, rows):
    typed = rows("event_id string, event_org_id bigint, fork_destination_org_id bigint",
                 *[(f"e{i}", i % 7 or None, i % 5 or None) for i in range(200)])
    targets = rows("organization_id bigint", (3,), (4,), (4,))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = panels.targeted_events_of_many(typed, targets, 0.01)
        plain = panels.targeted_events(typed, targets)
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    tested = next(i for i, line in enumerate(lines) if "Filter" in line and "getbit" in line)
    assert any("Exchange" in line for line in lines[:tested]) and any("Generate" in line for line in lines[:tested])


def test_ledger_counts_lines_and_what_is_dropped(spark, tmp_path):
    good, mistyped = '{"id":"8","type":"ForkEvent","created_at":"2022-03-01T05:10:00Z","payload":{}}', '{"id":"9","type":"PushEvent","repo":{"id":"no"}}'
    for name, lines in {"2022-03-01-5": [good, "{", "", "nothing", mistyped], "2022-03-01-14": [good], "2022-03-02-0": [""]}.items():
        with gzip.open(tmp_path / f"{name}.json.gz", "wt") as handle:
            handle.write("\n".join(lines))
    found = archive.line_ledger(spark, str(tmp_path)).collect()
    assert {(r["archive_hour"], r["lines"], r["dropped"]) for r in found} == {
        (datetime(2022, 3, 1, 5), 4, 2), (datetime(2022, 3, 1, 14), 1, 0)}
    events, seen = archive.read_archive_counted(spark, str(tmp_path))
    assert events.count() == 3 and seen.get == {"lines": 5, "dropped": 2}


def test_many_logins_are_filtered_below_the_joins(spark, rows):
    from commonspulse.operators import filters

    chance = random.Random(11)
    names = ["Elm/a", "elm/b", "oak/c", "noslash", None, "/x"]
    events = rows("id bigint, repo struct<id: bigint, name: string>, org struct<id: string, login: string>, payload string",
                  *[(i, (i, chance.choice(names)), chance.choice([None, ("1", "ELM"), ("2", "ash"), ("3", ""), ("4", None)]), "{}") for i in range(300)])
    logins = rows("login string", ("eLm",), ("ASH",), ("ash",), (None,), ("none",))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = filters.of_any_organization_of_many(events, logins, 0.01)
        plain = filters.of_any_organization(events, logins)
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert found.columns == events.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
        assert 0 < found.count() < 300
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    tested = next(i for i, line in enumerate(lines) if "Filter" in line and "getbit" in line)
    assert any("Exchange" in line for line in lines[:tested])
    assert filters.of_any_organization_of_many(events, logins.limit(0), 0.01).count() == 0
