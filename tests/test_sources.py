from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martloom.plans.replicate import bulk_replicate
from martloom.session import partitions_for, scratch_path, size_shuffle
from martloom.sources.landing import latest_file, read_landing
from martloom.sources.sinks import export_delimited, export_single_file, read_delimited, write_stage
from martloom.sources.tables import Database, Folder, Split, read_table, read_tables, run_queries, run_query


def files(folder):
    return sorted(p for p in Path(folder).glob("part-*") if p.suffix != ".crc")


def test_landing_reads_all_files_or_the_last(spark, rows):
    folder = scratch_path(spark, "test-landing")
    spark.createDataFrame([("1", "a")], "Id string, Name string").coalesce(1).write.json(f"{folder}/2024-01-01")
    spark.createDataFrame([("2", "b")], "Id string, Name string").coalesce(1).write.json(f"{folder}/2024-01-02")
    assert rows(read_landing(spark, folder, ["Id", "Name", "Other"])) == [("1", "a", None), ("2", "b", None)]
    assert "2024-01-02" in latest_file(spark, folder)
    assert rows(read_landing(spark, folder, ["Id"], latest_only=True)) == [("2",)]


def test_missing_landing_is_an_error(spark):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        read_landing(spark, scratch_path(spark, "test-none"), ["Id"]).count()


def test_stage_is_replaced_and_lower_case(spark, rows):
    target = Folder(scratch_path(spark, "test-stage"))
    write_stage(spark.createDataFrame([(1, "x"), (2, "y")], "ID int, Name string"), target, "t")
    write_stage(spark.createDataFrame([(3, "z")], "ID int, Name string"), target, "t")
    back = read_table(spark, target, "t")
    assert back.columns == ["id", "name"] and rows(back) == [(3, "z")]
    assert list(read_tables(spark, target, {"alias": "t"})) == ["alias"]


def test_export_keeps_values(spark, rows):
    values = [("a,b", ' "quoted" ', None, "1"), ("tab\there", "", "#N/A", "2"), ("  lead", "trail  ", "ü", "3")]
    df = spark.createDataFrame(values, "A string, B string, C string, D string")
    for sep in (",", "\t"):
        targets = [scratch_path(spark, "test-export") for _ in range(2)]
        export_delimited(df, targets, sep=sep)
        expected = [tuple(v or None for v in r) for r in values]
        for target in targets:
            assert rows(read_delimited(spark, target, df.columns, sep)) == sorted(expected, key=lambda t: t[0])
        assert files(targets[0])[0].read_text().splitlines()[0] == sep.join("ABCD")


def test_export_doubles_quotes(spark):
    target = scratch_path(spark, "test-export")
    export_delimited(spark.createDataFrame([('say "x", y',)], "A string").coalesce(1), [target], max_rows=10)
    assert files(target)[0].read_text() == 'A\n"say ""x"", y"\n'


def test_export_of_nothing_leaves_a_header(spark):
    target = scratch_path(spark, "test-export")
    export_delimited(spark.createDataFrame([], "A string, B int"), [target])
    assert [f.read_text() for f in files(target)] == ["A,B\n"]


def test_export_is_cut_into_files(spark):
    target = scratch_path(spark, "test-export")
    df = spark.range(1000).coalesce(1).select(F.lpad(F.col("id").cast("string"), 9, "0").alias("a"))
    export_delimited(df, [target], file_bytes=1000)
    parts = files(target)
    assert 10 <= len(parts) <= 20 and max(p.stat().st_size for p in parts) <= 1002
    assert read_delimited(spark, target, ["a"]).distinct().count() == 1000


def test_wide_rows_after_narrow_ones_keep_files_small(spark):
    base = scratch_path(spark, "test-export")
    width = F.when(F.col("id") < 20_000, 2).otherwise(700)
    df = spark.range(20_400).coalesce(1).select(F.col("id").cast("string").alias("a"), F.repeat(F.lit('"x'), width).alias("b"))
    targets = [f"{base}/one", f"{base}/two"]
    before = set(Path(base).parent.glob("export-*"))
    export_delimited(df, targets, file_bytes=64_000)
    for target in targets:
        assert max(p.stat().st_size for p in files(target)) <= 64_000 + 10
        assert read_delimited(spark, target, ["a", "b"]).exceptAll(df).count() == 0
        assert read_delimited(spark, target, ["a", "b"]).count() == 20_400
    assert set(Path(base).parent.glob("export-*")) == before, "the copy is removed"


def test_files_of_an_export_are_half_full_and_its_copy_is_read_once_a_target(spark):
    target = scratch_path(spark, "test-export")
    df = spark.range(6_000).repartition(3).select(F.repeat(F.lit("x"), (F.col("id") % 50 * 7).cast("int")).alias("a"), "id")
    wide = spark.createDataFrame([("y" * 5_000, -1), ("z" * 30_000, -2)], "a string, id long")
    export_delimited(df.unionByName(wide), [target], file_bytes=20_000)
    sizes = [p.stat().st_size for p in files(target) if "\nzzz" not in p.read_text()]
    assert max(sizes) <= 20_000 + 10
    assert sum(size < 10_000 for size in sizes) <= 3 + 1 + 2, "the last file of each partition, and wide rows"
    assert read_delimited(spark, target, ["a", "id"]).count() == 6_002


@pytest.mark.parametrize("rows_out", [0, 1, 5_000])
def test_one_file_has_one_header_and_all_rows_in_order(spark, rows_out):
    target = f"{scratch_path(spark, 'test-single')}/one.csv"
    df = spark.range(rows_out).repartition(5).select("id", F.concat(F.lit('q"'), F.col("id")).alias("t"))
    export_single_file(df, target, order_by=["id"])
    lines = Path(target.removeprefix("file:")).read_text().splitlines()
    assert lines == ["id,t", *[f'{k},"q""{k}"' for k in range(rows_out)]]


def test_query_arguments_are_bound(spark, rows):
    df = spark.createDataFrame([(1, "x", date(2020, 1, 1)), (2, "y'; --", date(2021, 1, 1))], "id int, c string, d date")
    text = "SELECT id FROM {t} WHERE d > :d AND array_contains(:codes, c);"
    args = {"d": date(2019, 1, 1), "codes": F.array(F.lit("y'; --"), F.lit("q"))}
    assert rows(run_query(spark, text, {"t": df}, args)) == [(2,)]
    both = run_queries(spark, {"one": text, "two": "SELECT c FROM {t}"}, {"t": df}, args)
    assert {k: v.columns for k, v in both.items()} == {"one": ["id"], "two": ["c"]}


def test_jdbc_options():
    database = Database("jdbc:x", "s", {"user": "u"}, {"big": Split("id", "0", "100", 8)})
    assert database.options("small") == {"url": "jdbc:x", "dbtable": "s.small", "fetchsize": "10000", "user": "u"}
    assert database.options("big")["numPartitions"] == "8" and database.options("big")["partitionColumn"] == "id"
    assert database.query_options(" SELECT 1 ; ")["query"] == "SELECT 1 "


def test_replication_counts_and_carries_on(spark):
    source, target = Folder(scratch_path(spark, "test-source")), Folder(scratch_path(spark, "test-target"))
    write_stage(spark.range(10), source, "a")
    write_stage(spark.range(20), source, "c")
    report = bulk_replicate(spark, source, target, ["a", "b", "c"], fail_fast=False)
    assert [(r.table, r.rows, r.error is None) for r in report] == [("a", 10, True), ("b", None, False), ("c", 20, True)]
    assert read_table(spark, target, "c").count() == 20
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        bulk_replicate(spark, source, target, ["a", "b"])


def test_shuffle_is_sized_by_input(spark, settings):
    assert partitions_for(0) == 1
    assert partitions_for(100 * 2**40) == 3 * 100 * 2**40 // 2**27 + 1
    settings(spark__sql__shuffle__partitions="8")
    assert size_shuffle(spark, ["/root/testdata/sf0.001"]) == 8


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://cluster:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        scratch_path(Session(), "x")
