"""Streams give what the batch gives, also when batches repeat."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from commonspulse import constants as C
from commonspulse import schemas
from commonspulse.operators import panels
from commonspulse.plans import archive_load
from commonspulse.sources import archive
from commonspulse.streaming import ingest, panel

START = datetime(2024, 1, 31, 20)


def line(i, hour):
    kind = ("PushEvent", "IssuesEvent", "WatchEvent")[i % 3]
    payload = {"commits": [{"sha": f"s{i % 7}", "message": f"{hour}-{i}"}]} if i % 3 == 0 else {"action": "opened"}
    at = START + timedelta(hours=hour, minutes=i)
    return json.dumps({"id": str(i if i % 5 else 0), "type": kind, "created_at": at.isoformat() + "Z", "actor": {"id": i % 4},
                       "repo": {"id": 1 + i % 2, "name": "acme/r"}, "org": {"id": 9, "login": "Acme"}, "payload": payload})


@pytest.fixture
def root(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for hour in range(6):
        at = START + timedelta(hours=hour)
        path = folder / f"{at:%Y-%m-%d}-{at.hour}.json"
        path.write_text("\n".join(line(i, hour) for i in range(hour * 6, hour * 6 + 8)))
        # Files land hour by hour: a stream takes them in the order of their times.
        os.utime(path, (at.timestamp(), at.timestamp()))
    return str(folder)


def test_incremental_ingest_equals_batch(spark, root, tmp_path):
    out = str(tmp_path / "tables")
    ingest.create(spark, out)
    batch = ingest.ingest_batch(out, spark.createDataFrame([("ACME",)], "login string"), F.lit(START))
    ingest.start(archive.read_archive_stream(spark, root, max_files=2), batch, str(tmp_path / "cp")).awaitTermination()

    empty = {n: spark.createDataFrame([], schemas.table_schema(n)) for n in ("gharchive_event", "commit_activity")}
    load = archive_load.load_archive(archive.read_archive(spark, root), empty, "acme", F.lit(START))
    for name, whole, key in (("gharchive_event", load.new_events, "event_id"), ("commit_activity", load.new_commits, "sha")):
        stored = ingest.stored_rows(spark, f"{out}/{name}", schemas.TABLES[name])
        assert stored.groupBy(key).count().where("count > 1").count() == (0 if key == "event_id" else
                                                                          whole.groupBy(key).count().where("count > 1").count())
        columns = [c for c in stored.columns if c not in ("payload", "message")]
        assert sorted(map(str, stored.select(columns).collect())) == sorted(map(str, whole.select(columns).collect()))


def test_repeated_batch_writes_the_same_rows(spark, root, tmp_path):
    out = str(tmp_path / "tables")
    ingest.create(spark, out)
    batch = ingest.ingest_batch(out, None, F.lit(START))
    events = archive.read_archive(spark, root)
    first, second = events.where("archive_hour < '2024-01-31 22:00:00'"), events.where("archive_hour >= '2024-01-31 22:00:00'")
    batch(first, 0)
    batch(second, 1)
    def state():
        return sorted(map(str, ingest.stored_rows(spark, f"{out}/gharchive_event", schemas.TABLES["gharchive_event"]).collect()))
    before = state()
    batch(second, 1)
    assert state() == before
    # The same files again in a new batch add nothing.
    batch(events, 2)
    assert state() == before


def test_incremental_panel_equals_batch(spark, root, tmp_path):
    out = str(tmp_path / "panel")
    stream = archive.read_archive_stream(spark, root, max_files=1).drop("archive_hour")
    ingest.start(stream, panel.panel_batch(out), str(tmp_path / "cp")).awaitTermination()
    whole = panels.login_month_panel(archive.read_archive(spark, root))
    found = panel.read_panel(spark, out).select(*whole.columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))
    assert found.select("month").distinct().count() == 2


def test_additive_counts_on_a_stream(spark, root, tmp_path):
    counts = panel.additive_counts(archive.read_archive_stream(spark, root))
    running = counts.writeStream.outputMode("complete").format("memory").queryName("additive").option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    running.awaitTermination()
    whole = panels.login_month_panel(archive.read_archive(spark, root))
    expected = {(r["month"], r["public_events"], r["push_events"]) for r in whole.collect()}
    assert {(r["month"], r["public_events"], r["push_events"]) for r in spark.table("additive").collect()} == expected


def test_panel_stream_stores_what_it_counts_and_few_files(spark, root, tmp_path):
    """No payload is kept for the months to be computed again, and new ids are a file a month, not one a task and month."""
    stored, deltas = str(tmp_path / "panel"), str(tmp_path / "deltas")
    events = archive.read_archive(spark, root).drop("archive_hour")
    panel.panel_batch(stored)(events, 0)
    assert not {"payload", "repo", "actor"} & set(spark.read.parquet(f"{stored}/events").columns)
    panel.create_deltas(spark, deltas)
    panel.delta_batch(deltas)(events, 0)
    months = [d for d in os.listdir(f"{deltas}/ids") if d.startswith("month=2024")]
    files = [f for m in months for f in os.listdir(f"{deltas}/ids/{m}/batch=0") if f.startswith("part-")]
    assert len(months) == 2 == len(files)
    whole = sorted(map(tuple, panels.login_month_panel(events).collect()))
    for found in (panel.read_panel(spark, stored), panel.summed_panel(spark, deltas)):
        assert sorted(map(tuple, found.select("org_login", "month", *C.LOGIN_PANEL_METRICS).collect())) == whole
