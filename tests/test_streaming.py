from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.context import AUDIT_FIELDS, RunContext
from martloom.operators import history as H
from martloom.session import scratch_path
from martloom.sources.landing import landing_rejects, read_landing
from martloom.sources.state import HistoryTable
from martloom.streaming.history import stream_history
from martloom.streaming.landing import ingest_landing, landing_stream

RUN = RunContext(datetime(2024, 1, 1), 5)
COLUMNS = ["k", "payload"]
SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("payload", T.StringType()), *AUDIT_FIELDS])


def land(spark, folder, name, data):
    spark.createDataFrame(data, "k string, payload string").write.json(f"{folder}/{name}")


def test_each_landed_file_is_taken_once(spark, rows):
    base = scratch_path(spark, "test-stream")

    def ingest():
        query = ingest_landing(landing_stream(spark, f"{base}/landing", COLUMNS), f"{base}/table", f"{base}/check")
        query.awaitTermination()
        return rows(spark.read.schema("k string, payload string").parquet(f"{base}/table"))

    land(spark, f"{base}/landing", "1", [("a", "1"), ("b", "2")])
    assert ingest() == [("a", "1"), ("b", "2")]
    assert ingest() == [("a", "1"), ("b", "2")]
    land(spark, f"{base}/landing", "2", [("a", "3")])
    assert ingest() == rows(read_landing(spark, f"{base}/landing", COLUMNS)) == [("a", "1"), ("a", "3"), ("b", "2")]


def test_lines_that_do_not_parse_are_told(spark, rows):
    base = scratch_path(spark, "test-landing")
    good, bad = '{"k": "a", "payload": "1"}', '{"k":"2"'
    spark.createDataFrame([(good,), (bad,), ("no json",)], "value string").write.text(f"{base}/landing")
    assert rows(read_landing(spark, f"{base}/landing", COLUMNS)) == [("a", "1")]
    assert rows(landing_rejects(spark, f"{base}/landing", COLUMNS), "line") == [("no json",), (bad,)]
    ingest_landing(landing_stream(spark, f"{base}/landing", COLUMNS), f"{base}/table", f"{base}/check").awaitTermination()
    assert rows(spark.read.parquet(f"{base}/table")) == [("a", "1")]


def test_streamed_history_equals_batches(spark, rows):
    base = scratch_path(spark, "test-stream")
    table = HistoryTable(spark, f"{base}/history", SCHEMA, "k")
    steps = [[("a", "1"), ("b", "2")], [("a", "3")], [("c", "4"), ("b", "5")]]
    expected = spark.createDataFrame([], SCHEMA)
    for number, step in enumerate(steps):
        land(spark, f"{base}/landing", str(number), step)
        stream_history(landing_stream(spark, f"{base}/landing", COLUMNS), table, RUN, f"{base}/check").awaitTermination()
        expected = H.apply_history(expected, spark.createDataFrame(step, "k string, payload string"), "k", RUN)
    assert rows(table.read()) == rows(expected)
    assert table.version() == len(steps)


def test_new_checkpoint_publishes_what_it_reads(spark):
    base = scratch_path(spark, "test-stream")
    table = HistoryTable(spark, f"{base}/history", SCHEMA, "k")
    for check, folder, value in (("first", "landing", "1"), ("second", "other", "2")):
        land(spark, f"{base}/{folder}", "0", [("a", value)])
        stream_history(landing_stream(spark, f"{base}/{folder}", COLUMNS), table, RUN, f"{base}/{check}").awaitTermination()
    assert table.version() == 2
    assert [r["payload"] for r in table.read().filter(F.col("is_active") == "Y").collect()] == ["2"]


def test_replayed_batch_is_published_once(spark):
    """The commit of the batch in the checkpoint is lost, so that Spark gives the batch out again."""
    base = scratch_path(spark, "test-stream")
    table = HistoryTable(spark, f"{base}/history", SCHEMA, "k")
    land(spark, f"{base}/landing", "0", [("a", "1")])

    def run():
        stream_history(landing_stream(spark, f"{base}/landing", COLUMNS), table, RUN, f"{base}/check").awaitTermination()

    run()
    for part in Path(f"{base}/check/commits").iterdir():
        part.unlink()
    run()
    assert table.version() == 1
    assert table.read().count() == 1
