from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.context import AUDIT_FIELDS, RunContext
from martloom.operators import history as H
from martloom.plans.runner import IncrementalJob
from martloom.session import scratch_path
from martloom.sources.state import Bookmark, HistoryTable
from martloom.sources.tables import Folder

FIRST, SECOND = RunContext(datetime(2024, 1, 1), 11), RunContext(datetime(2024, 1, 2), 12)
SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("payload", T.StringType()), *AUDIT_FIELDS])
OLD = datetime(2020, 1, 1)


@pytest.fixture
def history(spark):
    return spark.createDataFrame(
        [
            ("a", "1", "Y", OLD, OLD, 1, 1),
            ("a", "0", "N", OLD, OLD, 1, 1),
            ("b", "2", "Y", OLD, OLD, 1, 1),
            (None, "3", "Y", OLD, OLD, 1, 1),
            ("a", "4", None, OLD, OLD, 1, 1),
        ],
        SCHEMA,
    )


@pytest.fixture
def stage(spark):
    return spark.createDataFrame([("a", "new"), ("a", "new too"), ("c", "first"), (None, "keyless")], "k string, payload string")


def test_close_touches_active_rows_of_staged_keys_only(history, stage, rows):
    closed = H.close_history(history, stage, "k", FIRST)
    assert rows(closed, "k", "payload", "is_active", "updated_ts", "updated_by_job_exec_id") == [
        (None, "3", "Y", OLD, 1),
        ("a", "0", "N", OLD, 1),
        ("a", "1", "N", FIRST.run_ts, 1),
        ("a", "4", None, OLD, 1),
        ("b", "2", "Y", OLD, 1),
    ]
    stamped = H.close_history(history, stage, "k", FIRST, stamp_exec=True)
    assert rows(stamped.filter("payload = '1'"), "updated_by_job_exec_id", "created_by_job_exec_id") == [(11, 1)]


def test_apply_appends_every_staged_row(history, stage):
    applied = H.apply_history(history, stage, "k", FIRST)
    assert applied.columns == history.columns
    assert applied.count() == history.count() + stage.count()
    runs = applied.filter("is_active = 'Y' and k is not null").groupBy("k").agg(F.countDistinct("created_by_job_exec_id").alias("n"))
    assert {r["n"] for r in runs.collect()} == {1}, "a key is active in one run at most"


def test_rollback_does_not_reopen(history, stage, rows):
    back = H.rollback_history(H.apply_history(history, stage, "k", FIRST), 11)
    assert rows(back) == rows(H.close_history(history, stage, "k", FIRST))


def test_columns_the_stage_lacks_are_null(spark, history):
    wider = history.withColumn("extra", F.lit(1).cast("int"))
    stage = spark.createDataFrame([("z", "p")], "K string, payload string")
    added = H.new_rows(wider.schema, stage, FIRST).head()
    assert (added["k"], added["extra"], added["is_active"]) == ("z", None, "Y")


@pytest.fixture
def table(spark):
    return HistoryTable(spark, scratch_path(spark, "test-history"), SCHEMA, "k")


def test_table_equals_the_pure_function(spark, table, stage, rows):
    second = spark.createDataFrame([("c", "again"), ("d", "x")], "k string, payload string")
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(table.read()) == []
    assert table.publish(stage, FIRST) == 1
    assert table.publish(second, SECOND) == 2
    once = H.apply_history(empty, stage, "k", FIRST)
    assert rows(table.read()) == rows(H.apply_history(once, second, "k", SECOND))


def test_table_rollback_then_same_run_again(spark, table, stage, rows):
    second = spark.createDataFrame([("c", "again")], "k string, payload string")
    table.publish(stage, FIRST, token="t1")
    table.publish(second, SECOND, token="t2")
    table.rollback(SECOND.exec_id)
    assert rows(table.read().filter("k = 'c'"), "payload", "is_active") == [("first", "N")]
    table.publish(second, SECOND, token="t2")
    assert rows(table.read().filter("k = 'c'"), "payload", "is_active") == [("again", "Y"), ("first", "N")]
    table.publish(second, SECOND, token="t2")
    assert table.read().filter("k = 'c'").count() == 2, "a published token is not published twice"


def fail_before_commit(table, stage, run, monkeypatch):
    def fail(*args):
        raise OSError("lost before the commit")

    with monkeypatch.context() as patch:
        patch.setattr(HistoryTable, "_commit", fail)
        with pytest.raises(OSError):
            table.publish(stage, run)


def test_uncommitted_segment_is_not_read(table, stage, rows, monkeypatch):
    table.publish(stage, FIRST)
    before = rows(table.read())
    fail_before_commit(table, stage, SECOND, monkeypatch)
    assert table.version() == 1
    assert rows(table.read()) == before
    table.publish(stage.filter("k = 'c'"), SECOND)
    assert table.read().count() == len(before) + 1


def test_rollback_of_a_failed_run_publishes_nothing(table, stage, rows, monkeypatch):
    table.publish(stage, FIRST)
    before = rows(table.read())
    fail_before_commit(table, stage, SECOND, monkeypatch)
    table.rollback(SECOND.exec_id)
    assert rows(table.read()) == before


def test_second_writer_of_a_version_fails(table, stage):
    table.publish(stage, FIRST)
    with pytest.raises(Exception, match="FileAlreadyExists"):
        table._commit(1, 99, None, None, "other")
    assert table.version() == 1


def test_bookmark_default_and_last_value(spark):
    bookmark = Bookmark(spark, scratch_path(spark, "test-bookmark"))
    assert bookmark.read("never") == "never"
    bookmark.commit("9", 1)
    bookmark.commit("10", 2)
    assert bookmark.read("never") == "10"


def job(spark, extract, base):
    return IncrementalJob(
        extract,
        Bookmark(spark, f"{base}/bookmark"),
        "0",
        Folder(f"{base}/stage"),
        "t",
        HistoryTable(spark, f"{base}/history", SCHEMA, "k"),
    )


def test_bookmark_moves_only_after_a_whole_run(spark, stage):
    base = scratch_path(spark, "test-run")

    def broken(after, until):
        raise ValueError("no source")

    with pytest.raises(ValueError):
        job(spark, broken, base).run(spark, "1", FIRST)
    assert job(spark, broken, base).bookmark.read("0") == "0"
    seen = []

    def working(after, until):
        seen.append((after, until))
        return stage

    runner = job(spark, working, base)
    runner.run(spark, "1", FIRST)
    runner.run(spark, "2", SECOND)
    assert seen == [("0", "1"), ("1", "2")]
    assert runner.history.read().filter("is_active = 'Y' and k = 'a'").count() == 2


def test_retry_stages_the_same_window_again(spark, stage, rows):
    base = scratch_path(spark, "test-retry")
    windows = []

    def extract(after, until):
        windows.append((after, until))
        return stage.limit(0) if after == until else stage

    runner = job(spark, extract, base)
    runner.run(spark, "1", FIRST)
    published = rows(runner.history.read())
    for _ in range(2):
        assert runner.run(spark, "1", FIRST) == ("0", "1")
        assert spark.read.parquet(f"{base}/stage/t").count() == stage.count()
        assert rows(runner.history.read()) == published
    assert runner.run(spark, "2", FIRST) == ("1", "2"), "a later bound of the same run is a window of its own"
    assert runner.history.version() == 2
    assert runner.run(spark, "2", FIRST) == ("1", "2")
    assert runner.history.version() == 2


def test_publishing_reads_no_history(spark, table, stage, monkeypatch):
    """A run costs what it stages, however long the history is."""
    table.publish(stage, FIRST)
    monkeypatch.setattr(HistoryTable, "_part", lambda *args: pytest.fail("the history was read"))
    assert table.publish(stage, SECOND) == 2


def test_hot_key_over_many_versions(spark, table, rows):
    expected = spark.createDataFrame([], SCHEMA)
    for number in range(5):
        run = RunContext(datetime(2024, 2, 1 + number), 20 + number)
        step = spark.range(300).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % (50 + number))).alias("k"),
            F.col("id").cast("string").alias("payload"),
        )
        table.publish(step, run)
        expected = H.apply_history(expected, step, "k", run)
    assert rows(table.read()) == rows(expected)
    assert table.read().filter("k = 'hot' and is_active = 'Y'").count() == 100


def test_seeded_history_goes_on(table, history, stage, rows):
    table.seed(history)
    assert rows(table.read()) == rows(history)
    table.publish(stage, FIRST)
    assert rows(table.read()) == rows(H.apply_history(history, stage, "k", FIRST))
    with pytest.raises(ValueError):
        table.seed(history)
