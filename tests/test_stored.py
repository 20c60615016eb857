"""Tables kept up to date in place: settled streams, panels by deltas, merges that touch a few folders."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from commonspulse.catalog import adapter, landing
from commonspulse.operators import merge, panels
from commonspulse.plans import landing_load
from commonspulse.sources import archive, tables
from commonspulse.streaming import dedup, ingest, panel

DAY = datetime(2023, 5, 10, 6)


def event(number, created, org="Orchard", repo=11, actor=21, kind="WatchEvent", **payload):
    return {"id": f"n{number}", "type": kind, "created_at": (DAY + timedelta(hours=created)).isoformat() + "Z", "actor": {"id": actor, "login": f"u{actor}"},
            "repo": {"id": repo, "name": f"orchard/r{repo}"}, "org": {"id": 5, "login": org} if org else None, "payload": payload or {"action": "started"}}


def land(folder, hour, *events):
    at = DAY + timedelta(hours=hour)
    (folder / f"{at:%Y-%m-%d}-{at.hour}.json").write_text("\n".join(json.dumps(e) for e in events))


def stored(spark, root):
    return sorted((r["event_id"], r["archive_hour"], r["day"], r["action"]) for r in dedup.read_events(spark, root).collect())


def test_settled_stream_keeps_the_earliest_and_restarts(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "events")
    landing.mkdir()

    def settle():
        query = dedup.start_settling(archive.read_archive_stream(spark, str(landing), max_files=1), root, "3 hours", str(tmp_path / "cp"), F.lit(DAY))
        query.awaitTermination()
        return query

    # The replay of an hour later has the larger action; number 3 replays inside one file.
    land(landing, 0, event(1, 0, action="a"), event(2, 0), event(3, 0, action="z"), event(3, 0, action="b"))
    land(landing, 1, event(1, 0, action="0"), event(4, 1))
    settle()
    assert stored(spark, root) == []  # all of it is younger than the watermark
    land(landing, 2, event(2, 0, action="late"), event(5, 2))
    land(landing, 9, event(6, 9))
    settle()  # from the checkpoint
    first = stored(spark, root)
    hour = lambda k: DAY + timedelta(hours=k)
    assert first == [("n1", hour(0), "2023-05-10", "a"), ("n2", hour(0), "2023-05-10", "started"), ("n3", hour(0), "2023-05-10", "b"),
                     ("n4", hour(1), "2023-05-10", "started"), ("n5", hour(2), "2023-05-10", "started")]
    # A file long after its time: its rows are counted as dropped, and caught up by the look-up.
    land(landing, 3, event(1, 0, action="again"), event(7, 3))
    assert dedup.dropped_rows(settle()) >= 1
    tail = archive.read_archive(spark, str(landing))
    for _ in range(2):
        dedup.catch_up(tail, root, "tail", F.lit(DAY))
    whole = stored(spark, root)
    assert whole == sorted([*first, ("n6", hour(9), "2023-05-10", "started"), ("n7", hour(3), "2023-05-10", "started")])
    # What was caught up and settles afterwards is not written twice.
    land(landing, 30, event(8, 30))
    settle()
    assert stored(spark, root) == whole


def test_undated_events_are_caught_up(spark, tmp_path):
    rows = spark.createDataFrame([("q1", "WatchEvent", None, None, None, None, "{}", DAY)] * 2,
                                 "id string, type string, created_at timestamp, actor struct<id: bigint, login: string>, repo struct<id: bigint, name: string>, "
                                 "org struct<id: string, login: string>, payload string, archive_hour timestamp")
    root = str(tmp_path / "events")
    dedup.catch_up(rows, root, "one")
    dedup.catch_up(rows, root, "two")
    assert stored(spark, root) == [("q1", DAY, dedup.UNDATED, None)]


def test_look_up_reads_the_days_of_the_batch_only(spark, tmp_path, capsys):
    root, landing = str(tmp_path / "events"), tmp_path / "landing"
    landing.mkdir()
    for k in range(4):
        land(landing, 24 * k, event(k, 24 * k))
    dedup.catch_up(archive.read_archive(spark, str(landing)), root, "all")
    rows = dedup.stored_of_days(spark, root, ["2023-05-11"], "other")
    assert [r["event_id"] for r in rows.collect()] == ["n1"]
    rows.explain("formatted")
    filters = next(line for line in capsys.readouterr().out.splitlines() if "PartitionFilters" in line)
    assert "day" in filters and "batch" in filters


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_delta_panel_adds_only_its_own_groups(spark, tmp_path):
    root, landing = str(tmp_path / "panel"), tmp_path / "landing"
    landing.mkdir()
    panel.create_deltas(spark, root)
    batch = panel.delta_batch(root)
    one = [event(1, 0), event(2, 1, repo=12, actor=22), event(3, 2, org="ORCHARD", kind="PushEvent", commits=[{"sha": "s"}]), event(4, 900, repo=13), event(5, 0, org="Mill", actor=None)]
    two = [event(6, 3, repo=12, actor=23), event(7, 5, org=None)]  # one late event of the first month
    frames = []
    for k, events in enumerate((one, two)):
        land(landing, k, *events)
        at = DAY + timedelta(hours=k)
        frames.append(archive.read_archive(spark, str(landing / f"{at:%Y-%m-%d}-{at.hour}.json")))

    def equal(*parts):
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        expected = panels.login_month_panel(whole)
        assert sorted(map(str, panel.summed_panel(spark, root).select(*expected.columns).collect())) == sorted(map(str, expected.collect()))

    batch(frames[0], 0)
    equal(frames[0])
    before = files(root)
    batch(frames[1], 1)
    equal(*frames)
    after = files(root)
    assert before.items() <= after.items()  # nothing that was there is written again
    counts = spark.read.parquet(f"{root}/counts").where("batch = 1").collect()
    assert [(r["org_login"], r["month"].isoformat(), r["active_repositories"], r["distinct_actors"]) for r in counts] == [("orchard", "2023-05-01", 0, 1)]
    batch(frames[1], 1)  # repeated after a loss
    equal(*frames)
    batch(frames[0], 2)  # replayed files: counts add up again as in the batch panel, ids do not
    equal(*frames, frames[0])


SCHEMA = "key bigint, name string, note string"


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([(k, f"n{k}", "old") for k in range(200)], SCHEMA)
    tables.write_bucketed(rows, path, ["key"], 16)
    return rows, path


def test_merge_touches_only_the_folders_it_hits(spark, table):
    rows, path = table
    incoming = spark.createDataFrame([(3, None), (1003, "new")], "key int, name string")
    before = files(path)
    hit = tables.merge_into(spark, path, SCHEMA, incoming, ["key"], 16, defaults={"note": "fresh"})
    assert 1 <= len(hit) <= 2
    after = files(path)
    untouched = {f for f in before if not any(f"{tables.BUCKET}={b}/" in f for b in hit)}
    assert {f: after[f] for f in untouched} == {f: before[f] for f in untouched} and untouched
    expected = sorted(map(str, merge.upsert(rows, incoming.select(F.col("key").cast("bigint"), "name"), ["key"], {"note": "fresh"}).collect()))
    read = lambda: sorted(map(str, tables.read_bucketed(spark, path, SCHEMA).drop(tables.BUCKET).collect()))
    assert read() == expected
    tables.merge_into(spark, path, SCHEMA, incoming, ["key"], 16, defaults={"note": "fresh"})
    assert read() == expected  # twice is once
    assert tables.merge_into(spark, path, SCHEMA, incoming.limit(0), ["key"], 16) == [] and read() == expected


def test_merge_with_repeated_keys_and_stored_first(spark, table):
    _, path = table
    incoming = spark.createDataFrame([(3, "late", 2), (3, "early", 1), (2000, "b", 2), (2000, "a", 1)], "key bigint, name string, moment int")
    tables.merge_into(spark, path, SCHEMA, incoming, ["key"], 16, order=["moment"], keep_stored=True)
    found = {r["key"]: (r["name"], r["note"]) for r in tables.read_bucketed(spark, path, SCHEMA).collect()}
    assert found[3] == ("n3", "old") and found[2000] == ("a", None) and len(found) == 201
    tables.merge_into(spark, path, SCHEMA, incoming, ["key"], 16, order=["moment"])
    found = {r["key"]: (r["name"], r["note"]) for r in tables.read_bucketed(spark, path, SCHEMA).collect()}
    assert found[3] == ("late", "old") and found[2000] == ("b", None) and len(found) == 201


def test_copartitioned_tables_join_without_exchange(spark, rows, tmp_path):
    from commonspulse.operators import views

    repositories = spark.range(500).select(F.col("id").alias("repo_id"), F.concat(F.lit("r"), "id").alias("name"))
    snapshots = spark.range(2000).select(
        (F.col("id") % 400).alias("repo_id"), F.timestamp_seconds("id").alias("observed_at"), F.col("id").cast("int").alias("stargazers_count"))
    plain = sorted(map(tuple, views.repository_current(repositories, snapshots).collect()))
    stored = tables.write_copartitioned({"co_repository": repositories, "co_snapshot": snapshots}, str(tmp_path), "repo_id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = views.repository_current(stored["co_repository"], stored["co_snapshot"])
        assert sorted(map(tuple, joined.collect())) == plain
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    again = tables.write_copartitioned({"co_repository": repositories.limit(3)}, str(tmp_path / "again"), "repo_id", 2)
    assert again["co_repository"].count() == 3


def test_a_kind_lands_when_asked_for(spark, tmp_path):
    """Only what is read lands, compressed, in files of a bounded number of lines; other kinds land later beside it."""
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    spark.createDataFrame([(1, "a", 2, 9000.0, "m"), (2, None, None, -1.0, None), (2, "b", 3, None, "x")], schema).coalesce(1).write.parquet(
        str(tmp_path / "customer.parquet"))
    spark.createDataFrame([(5, "n", "b", "t", 10, 1.0), (6, "n", "b", "t", 11, 1.0)], adapter.BASE_TABLES["part"]).write.parquet(str(tmp_path / "part.parquet"))
    root = landing.landing_folder(spark, str(tmp_path), ("organization",))
    assert sorted(os.listdir(root)) == ["organization"]
    assert all(f.endswith(".txt.gz") for f in os.listdir(f"{root}/organization") if f.startswith("part-"))
    read = landing_load.read_landing(spark, root, ("organization",))
    assert list(read) == ["organization"]
    columns = ["target_login", "repo_id", "observed_at", "o"]
    assert sorted(map(str, read["organization"].select(columns).collect())) == sorted(
        map(str, landing.landed(spark, str(tmp_path), "organization").select(columns).collect()))
    assert landing.landing_folder(spark, str(tmp_path), ("organization", "setup")) == root
    assert sorted(os.listdir(root)) == ["organization", "setup"]
