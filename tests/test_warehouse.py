"""Named views through SQL, loads into stored tables, key rules."""

from datetime import date, datetime

import pytest

from commonspulse import schemas
from commonspulse.plans import warehouse
from commonspulse.plans.queries import run_query
from commonspulse.sources import tables


def test_named_views_over_an_empty_folder(spark, tmp_path):
    root = str(tmp_path / "store")
    tables.create_tables(spark, root)
    opened = warehouse.with_views(warehouse.stored_tables(spark, root))
    assert set(warehouse.VIEWS) <= set(opened)
    for name in warehouse.VIEWS:
        assert run_query(spark, f"select * from {name}", opened).count() == 0


def test_views_need_their_tables(spark):
    panel = spark.createDataFrame([], schemas.table_schema("organization_public_monthly"))
    assert set(warehouse.with_views({"organization_public_monthly": panel})) == {
        "organization_public_monthly", "organization_public_activity_totals"}


def test_panel_load_twice_is_the_same_as_once(spark, tmp_path):
    events = spark.createDataFrame(
        [("e1", "WatchEvent", datetime(2020, 5, 3), (1, "ann"), (7, "Blue/x"), ("9", "Blue"), '{"action":"started"}')],
        "id string, type string, created_at timestamp, actor struct<id: bigint, login: string>, "
        "repo struct<id: bigint, name: string>, org struct<id: string, login: string>, payload string")
    stored = spark.createDataFrame([], schemas.table_schema("organization_public_monthly"))
    log, found = str(tmp_path / "runs"), []
    for n in range(2):
        path = str(tmp_path / f"panel{n}")
        warehouse.load_panel(events, stored, path, log)
        stored = spark.read.schema(stored.schema).parquet(path)
        found.append([tuple(r) for r in stored.select("org_login", "month", "public_events", "star_events").collect()])
    assert found[0] == found[1] == [("blue", date(2020, 5, 1), 1, 1)]
    runs = spark.read.schema(schemas.table_schema("collection_run")).parquet(log)
    assert runs.where("status = 'succeeded' and rows_written = 1").count() == 2


@pytest.mark.parametrize(("rows", "rules"), [
    ([(1, "a"), (2, "b")], set()),
    ([(1, "a"), (1, "b")], {"unique(org_id)"}),
    ([(1, "a"), (2, "a")], {"unique(login)"}),
    ([(1, None), (2, "b")], {"not null"}),
])
def test_key_rules(spark, rows, rules):
    organizations = spark.createDataFrame([(*r, datetime(2020, 1, 1)) for r in rows], "org_id bigint, login string, collected_at timestamp")
    assert {r["rule"] for r in warehouse.broken_rules({"organization": organizations}).collect()} == rules
