"""Upsert, insert-if-absent, reconciliation and key checks, with a hot key."""

from datetime import datetime

from pyspark.sql import functions as F

from commonspulse.operators import merge

OLD = "org_id bigint, login string, name string, note string"


def as_dict(frame, key):
    return {r[key]: tuple(r) for r in frame.collect()}


def test_upsert_overwrites_supplied_columns_nulls_included(rows):
    existing = rows(OLD, (1, "a", "Old", "n1"), (2, "b", "Keep", "n2"))
    incoming = rows("org_id bigint, login string, name string", (1, "a", None), (3, "c", "New"))
    assert as_dict(merge.upsert(existing, incoming, ["org_id"], {"note": "default"}), "org_id") == {
        1: (1, "a", None, "n1"), 2: (2, "b", "Keep", "n2"), 3: (3, "c", "New", "default")}


def test_upsert_of_keys_only_changes_nothing(rows):
    existing = rows(OLD, (1, "a", "Old", "n1"))
    result = merge.upsert(existing, rows("org_id bigint", (1,), (2,)), ["org_id"])
    assert as_dict(result, "org_id") == {1: (1, "a", "Old", "n1"), 2: (2, None, None, None)}


def test_later_row_of_a_batch_wins(rows):
    existing = rows(OLD, (1, "a", "Old", "n1"))
    batch = rows("org_id bigint, name string, seq int", (1, "first", 1), (1, "second", 2), (5, "x", 1), (5, None, 3))
    result = merge.upsert_many(existing, batch, ["org_id"], ["seq"])
    assert as_dict(result, "org_id") == {1: (1, "a", "second", "n1"), 5: (5, None, None, None)}


def test_merges_can_be_repeated(rows):
    existing = rows("k int, v string, t int", (1, "a", 0))
    incoming = rows("k int, v string, t int", (1, "b", 1), (2, "c", 2), (2, "d", 1))
    once = merge.insert_ignore(existing, incoming, ["k"], ["t"])
    assert as_dict(once, "k") == {1: (1, "a", 0), 2: (2, "d", 1)}
    assert as_dict(merge.insert_ignore(once, incoming, ["k"], ["t"]), "k") == as_dict(once, "k")
    small = merge.absent_rows(existing, incoming, ["k"], ["t"], small_increment=True)
    assert as_dict(small, "k") == {2: (2, "d", 1)}
    single = merge.last_per_key(incoming, ["k"], ["t"])
    up = merge.upsert(existing, single, ["k"])
    assert as_dict(merge.upsert(up, single, ["k"]), "k") == as_dict(up, "k")


def test_reconciliation_order(rows):
    schema = "repo_id int, sha string, event_time timestamp, source string, note string"
    t = datetime(2024, 1, 1)
    existing = rows(schema, (1, "a", t, "gharchive", "kept"), (1, "b", t, "gharchive", "lost"))
    api = rows(schema + ", seen int", (1, "b", None, "github_api", None, 1), (1, "b", None, "github_api", "later", 2))
    archive = rows(schema, (1, "a", t, "gharchive", "new"), (1, "c", datetime(2024, 1, 2), "gharchive", "second"),
                   (1, "c", t, "gharchive", "first"), (1, "b", t, "gharchive", "ignored"))
    found = merge.reconcile_commits(existing, api, archive, ["seen"], ["event_time", "note"])
    assert as_dict(found, "sha") == {
        "a": (1, "a", t, "gharchive", "kept"), "b": (1, "b", None, "github_api", "later"),
        "c": (1, "c", t, "gharchive", "first")}


def test_key_violations(rows):
    frame = rows("a int, b string, c string", (1, "x", "v"), (1, "x", None), (2, "y", "v"), (None, "z", "v"))
    found = {(r["rule"], r["subject"]): r["rows"] for r in merge.key_violations(frame, ["a", "b"], ["c"]).collect()}
    assert found == {("unique(a, b)", '{"a":1,"b":"x"}'): 2, ("not null", "c"): 1, ("not null", "a"): 1}
    assert merge.key_violations(frame.where("b = 'y'"), ["a", "b"], ["c"]).count() == 0


def test_hot_key_is_combined_before_the_shuffle(spark):
    """A third of all rows on one key: one row per task leaves the map side."""
    rows = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("t"),
        F.concat(F.lit("v"), "id").alias("v"))
    last = merge.last_per_key(rows, ["k"], ["t"])
    assert last.count() == 20_001
    assert last.where("k = 0").first()["v"] == "v29997"
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan
