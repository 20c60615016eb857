"""Sizes of tasks."""

from commonspulse import session
from commonspulse.catalog import adapter
from commonspulse.sources import archive

READ, SHUFFLED = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_given_tables_are_read_in_small_tasks(spark, tmp_path):
    """Also in a session with Spark's own sizes; what its builder chose stays."""
    path = str(tmp_path / "supplier.parquet")
    spark.range(1).selectExpr("id as s_suppkey", "'a' as s_name", "1 as s_nationkey", "cast(2 as double) as s_acctbal").write.parquet(path)
    other = spark.newSession()
    other.conf.set(READ, "134217728b")
    other.conf.set(SHUFFLED, "1m")
    adapter._opened.clear()
    assert adapter.base(other, str(tmp_path), "supplier").count() == 1
    assert (other.conf.get(READ), other.conf.get(SHUFFLED)) == ("16m", "1m")
    adapter._opened.clear()


def test_tables_that_are_kept_have_files_of_the_usual_size(spark, rows, tmp_path, monkeypatch):
    sizes, hint = [], type(spark.range(1)).hint
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda self, *a: sizes.append(spark.conf.get(SHUFFLED)) or hint(self, *a))
    typed = rows("month date, organization_id bigint", (None, 1), (None, 2))
    archive.write_typed_months(typed, str(tmp_path / "typed"))
    assert sizes == [session.FILE_SIZE]
    assert spark.conf.get(SHUFFLED) == session.TASK_SIZES[SHUFFLED] and spark.read.parquet(str(tmp_path / "typed")).count() == 2


def test_large_rows_are_read_a_few_at_a_time(spark):
    keys = list(session.LARGE_ROWS)
    other = spark.newSession()
    before = other.conf.get(keys[0])
    other.conf.set(keys[1], "9m")
    with session.large_rows(other):
        assert [other.conf.get(k) for k in keys] == [session.LARGE_ROWS[keys[0]], "9m"]
    assert [other.conf.get(k) for k in keys] == [before, "9m"]
