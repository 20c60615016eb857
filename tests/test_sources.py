"""Months, hours, target files, archive files and partition pruning."""

import gzip
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from commonspulse import schemas
from commonspulse.operators.panels import login_month_panel
from commonspulse.sources import archive, landed, months, tables, targets


@pytest.mark.parametrize("start, end, count", [("2019-06", "2019-06", 1), ("2015-01", "2024-12", 120), ("2023-10", "2024-09", 12)])
def test_months_include_both_ends(spark, start, end, count):
    found = sorted(r["month"] for r in months.month_range(spark, start, end).collect())
    assert len(found) == len(set(found)) == count and all(m.day == 1 for m in found)
    assert (f"{found[0]:%Y-%m}", f"{found[-1]:%Y-%m}") == (start, end)
    assert all((b.year - a.year) * 12 + b.month - a.month == 1 for a, b in zip(found, found[1:], strict=False))


@pytest.mark.parametrize("value", ["2014-12", "2031-00", "2025-13", "2025-1", "Jan 2025", "2025-01\n"])
def test_bad_months(value):
    with pytest.raises(ValueError):
        months.as_month(value)


def test_reversed_months():
    with pytest.raises(ValueError):
        months.month_bounds("2025-02", "2025-01")


def test_hours_start_inclusive_end_exclusive(rows):
    start, end = datetime(2025, 1, 1, 0, 45), datetime(2025, 1, 1, 2)
    assert [h.hour for h in archive.archive_hours(start, end)] == [0, 1]
    assert archive.archive_hours(end, start) == []
    assert [h.hour for h in archive.archive_hours(start, datetime(2025, 1, 1, 2, 1, tzinfo=UTC))] == [0, 1, 2]
    bounds = rows("start timestamp, end timestamp", (start, end), (end, start))
    assert [r[0].hour for r in archive.hours_in(bounds).collect()] == [0, 1]
    assert archive.archive_paths("/a", start, end) == ["/a/2025-01-01-0.json.gz", "/a/2025-01-01-1.json.gz"]


@pytest.fixture
def archive_root(tmp_path):
    lines = {
        "2025-01-01-0": ['{"id":"1","type":"PushEvent","created_at":"2025-01-01T00:01:00Z","repo":{"id":7,"name":"acme/app"},'
                         '"payload":{"commits":[{"sha":"a"}]}}', "{broken", ""],
        "2025-01-01-1": ['{"id":2,"type":"IssuesEvent","created_at":"2025-01-01T01:01:00Z","payload":{}}'],
        "2025-01-01-10": ['{"id":"3","type":"ForkEvent","created_at":"2025-01-01T10:01:00Z","payload":{}}'],
    }
    for name, content in lines.items():
        with gzip.open(tmp_path / f"{name}.json.gz", "wt") as handle:
            handle.write("\n".join(content))
    return str(tmp_path)


def test_archive_skips_broken_lines_and_keeps_payload_text(spark, archive_root):
    found = {r["id"]: r for r in archive.read_archive(spark, archive_root).collect()}
    assert set(found) == {"1", "2", "3"}
    assert found["1"]["payload"] == '{"commits":[{"sha":"a"}]}'
    assert found["3"]["archive_hour"] == datetime(2025, 1, 1, 10)


def test_archive_hours_read_whole_files_only(spark, archive_root):
    start, end = datetime(2025, 1, 1, 0, 30), datetime(2025, 1, 1, 2)
    rows = archive.read_hours(spark, archive_root, start, end)
    assert sorted(r["id"] for r in rows.collect()) == ["1", "2"]
    hours = archive.hours_in(spark.range(1).select(
        F.lit(start).alias("start"), F.lit(datetime(2025, 1, 1, 4)).alias("end")))
    assert [r[0].hour for r in archive.missing_hours(hours, rows).collect()] == [2, 3]


def test_month_scan_reads_its_partitions_only(spark, rows, tmp_path):
    events = rows(schemas.RAW_EVENT, *[
        (str(i), "PushEvent", datetime(2024, 1 + i % 12, 1), (1, "a"), (1, "r"), ("1", "o"), "{}") for i in range(36)])
    archive.write_month_table(events, str(tmp_path / "m"))
    found = archive.scan_months(spark, str(tmp_path / "m"), "2024-03", "2024-05")
    assert found.count() == 9
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan and "PushedFilters: []" in plan


def write(tmp_path, text):
    path = tmp_path / "targets.csv"
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("mark", ["", "\ufeff"])
@pytest.mark.parametrize("head", ["organization_id,login", "ORG_ID,Historical_Login", "organization_id , historical_login"])
def test_target_file_header_forms(spark, tmp_path, mark, head):
    path = write(tmp_path, f"{mark}note,{head},stars\n,86,birch,1\n\"a, b\",87,,2\n")
    assert dict(targets.read_targets(spark, path).collect()) == {86: "birch", 87: None}


def test_target_file_last_row_wins(spark, tmp_path):
    path = write(tmp_path, " Org_ID , LOGIN\n7,first\n8, \n7,\n +9 ,x\n")
    assert dict(targets.read_targets(spark, path).collect()) == {7: None, 8: None, 9: "x"}


@pytest.mark.parametrize("bad", ["x", "", "0", "-3", "1.0", "1_000"])
def test_target_file_names_the_bad_line(spark, tmp_path, bad):
    with pytest.raises(ValueError, match="line 3"):
        targets.read_targets(spark, write(tmp_path, f"organization_id,login\n5,a\n{bad},b\n6,c\n"))


def test_target_file_needs_an_id_column_and_rows(spark, tmp_path):
    with pytest.raises(ValueError):
        targets.read_targets(spark, write(tmp_path, "login\na\n"))
    with pytest.raises(ValueError):
        targets.read_targets(spark, write(tmp_path, "organization_id\n"))


def test_landed_objects(spark, tmp_path):
    (tmp_path / "o.json").write_text(
        '{"target_login":"acme","observed_at":"2024-01-01T00:00:00Z","object":{"id":3,"login":"Acme","type":"Organization"}}\n')
    row = landed.read_api_json(spark, "organization", str(tmp_path)).first()
    assert (row["o"]["id"], row["o"]["login"], row["object"][:8]) == (3, "Acme", '{"id":3,')


def test_tables_are_created_once(spark, tmp_path):
    root = str(tmp_path)
    tables.create_tables(spark, root, ["setup_dependency"])
    row = spark.createDataFrame([(1, "a", "a>1", "setup.py", datetime(2024, 1, 1))],
                                schemas.table_schema("setup_dependency"))
    tables.write_tables({"setup_dependency": row}, root)
    tables.create_tables(spark, root, ["setup_dependency"])
    assert tables.read_table(spark, root, "setup_dependency").count() == 1


def test_archive_hours_outside_the_range_are_not_opened(spark, archive_root):
    rows = archive.read_hours(spark, archive_root, datetime(2025, 1, 1), datetime(2025, 1, 1, 2))
    rows.collect()
    read = rows._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().get("numFiles").get().value()
    assert read == 2


def test_panel_reads_the_payload_once(spark, rows, tmp_path):
    events = rows(schemas.RAW_EVENT, ("1", "PushEvent", datetime(2024, 1, 1), (1, "a"), (1, "r"), ("1", "o"), "{}"))
    archive.write_month_table(events, str(tmp_path / "m"))
    panel = login_month_panel(archive.scan_months(spark, str(tmp_path / "m"), "2024-01", "2024-01"))
    plan = panel._jdf.queryExecution().executedPlan().toString()
    schemas_read = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert len(schemas_read) == 2 and sum("payload#" in line for line in schemas_read) == 1
    assert all("PartitionFilters: [isnotnull(event_month" in line for line in schemas_read)


def test_mistyped_fields_do_not_lose_the_line(spark, tmp_path):
    (tmp_path / "2025-01-01-3.json").write_text(
        '{"id":"1","type":"PushEvent","created_at":"2025-01-01T03:00:00Z","repo":{"id":"x","name":"a/b"},"payload":{"a":1}}\n')
    row = archive.read_archive(spark, str(tmp_path)).first()
    assert (row["id"], row["repo"]["name"], row["repo"]["id"], row["payload"]) == ("1", "a/b", None, '{"a":1}')


def test_target_file_with_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "wanted.csv"
    path.write_text('login,org_id\n"a ""b"" c",31\n"one\ntwo",32\n', encoding="utf-8")
    found = {r["organization_id"]: r["historical_login"] for r in targets.read_targets(spark, str(path)).collect()}
    assert found == {31: 'a "b" c', 32: "one\ntwo"}
