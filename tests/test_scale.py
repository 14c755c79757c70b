"""What bounds the work of one task, and what is not shuffled."""

import time
from pathlib import Path

from helpers import exchange_columns, planned
from pyspark.sql import functions as F

from martloom.catalog import inputs as catalog_inputs
from martloom.catalog.inputs import Inputs
from martloom.catalog.queries import QUERIES
from martloom.plans import products
from martloom.session import REMOVE_SHUFFLES
from martloom.sources import sinks

SMALL = "/root/testdata/sf0.001"


def test_tables_that_are_repeated_are_dealt_to_tasks(spark, tmp_path, monkeypatch):
    keys = [(k, "N") for k in [*range(2_000), 7, 7, None]]
    spark.createDataFrame(keys, "p_partkey long, p_name string").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    inputs = Inputs(spark, str(tmp_path))
    monkeypatch.setattr(catalog_inputs, "SHARE_BYTES", 1_000)
    dealt = inputs["in_groups"].sparkSession.read.parquet(inputs.path("part"))
    repeated = inputs.dealt("part")
    sizes = [r["n"] for r in repeated.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 4 and max(sizes) < 1_000, "one small file is not one task"
    assert repeated.exceptAll(dealt).count() == 0 and repeated.count() == 2_003
    monkeypatch.setattr(catalog_inputs, "SHARE_BYTES", 1 << 30)
    assert "Exchange" not in planned(Inputs(spark, str(tmp_path)).dealt("part"))


def test_eligibility_shuffles_no_descriptive_master_columns(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    shuffles = exchange_columns(QUERIES["product_eligibility"](Inputs(spark, SMALL)))
    assert shuffles and not any({"mtrl_nbr", "prod_nm"} & set(columns) for columns in shuffles)


def test_an_export_shuffles_widths_to_find_its_files(spark):
    placed = spark.range(10).select(
        F.lit(0).alias("_export_part"), F.col("id").alias("_export_position"), F.lit(10).cast("long").alias("_export_width")
    )
    starts = sinks._cut_into_files(placed, 40)
    assert sorted(tuple(r) for r in starts.collect()) == [(0, False, 0), (0, False, 3), (0, False, 6), (0, False, 9)]
    assert all(set(columns) <= {"_export_part", "_export_position", "_export_width", "_export_wide", "_export_file", "min"} for columns in exchange_columns(starts))


def test_value_lines_are_compared_where_they_are_made(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    for name in ("value_lines", "spend_export"):
        shuffles = exchange_columns(QUERIES[name](Inputs(spark, SMALL)))
        assert not any({"value_amount", "val_typ_cd"} & set(columns) for columns in shuffles), "lines are not shuffled"


def test_day_values_are_shuffled_once(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    shuffles = exchange_columns(QUERIES["spend_value_stage"](Inputs(spark, SMALL)))
    assert sum("meeting_day_date_merc__c" in columns for columns in shuffles) == 1


def test_many_small_partitions_do_not_leave_as_many_files(spark, tmp_path):
    df = spark.range(2_000).repartition(40).select("id", F.lit("x" * 10).alias("t"))
    sinks.export_delimited(df, [f"{tmp_path}/out"], file_bytes=1_000_000)
    assert len(list(tmp_path.glob("out/part-*"))) == 1
    assert sinks.read_delimited(spark, f"{tmp_path}/out", ["id", "t"]).distinct().count() == 2_000


def test_rows_are_dealt_by_product_once_for_its_lookups(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__requireAllClusterKeysForCoPartition="false")
    for name in ("date_reconcile", "product_feed", "product_feed_touched"):
        shuffles = exchange_columns(QUERIES[name](Inputs(spark, SMALL)))
        assert not any({"start_dt_trn", "altrnt_id_type_cd__c"} & set(c) and "_wanted_type" in c for c in shuffles), name
        assert not any({"trnsltd_dsply_nm", "altrnt_id"} <= set(c) and "min" not in c and "_incomplete" not in c for c in shuffles if "recordtype" not in c), name


def test_only_rows_with_parameters_of_their_country_are_kept(spark):
    params = spark.createDataFrame([("C1", "BRND", "EN", "T1"), ("C1", "MKTP", "EN", "T0"), (None, "BRND", "FR", "T1")], "cntry_cd string, grp_prps_cd string, dialect_nm string, altrnt_id_type_cd string")
    found = spark.createDataFrame([(1, "C1", "EN"), (1, "C1", "EN"), (2, "C1", "FR"), (3, "C2", "EN"), (4, None, "FR")], "prod_id long, cntry_cd string, dialect_nm string")
    t = {"params": params, "translations": found}
    ids = lambda by_country: sorted(r["prod_id"] for r in products.with_parameters(t, ["translations"], by_country)["translations"].collect())
    assert ids(False) == [1, 1] and ids(True) == [1, 1, 2]


def test_stored_rows_meet_their_files_without_a_shuffle(spark, tmp_path, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    placed = spark.range(40).select(
        F.concat(F.lit("r"), "id").alias("t"),
        F.floor(F.col("id") / 20).cast("int").alias("_export_part"),
        F.col("id").alias("_export_position"),
        F.lit(10).cast("long").alias("_export_width"),
    )
    placed.write.parquet(f"{tmp_path}/stored")
    stored = sinks._joined_parts(spark.read.parquet(f"{tmp_path}/stored"), 100)
    starts = sinks._cut_into_files(stored, 100).collect()
    numbered = sinks._numbered(stored, starts, 100)
    assert exchange_columns(numbered) == [], "rows are shuffled by their file only"
    assert numbered.groupBy("_export_file").count().count() == len(starts) > 2 and numbered.count() == 40


def test_an_export_leaves_no_shuffle_files(spark, tmp_path):
    jvm = spark.sparkContext._jvm
    folders = [Path(d.getPath()) for d in jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    kept = lambda: {f.name for d in folders for f in d.rglob("shuffle_*.data")}
    before = kept()
    df = spark.range(3_000).repartition(5).groupBy((F.col("id") % 700).alias("k")).agg(F.count("*").alias("n"))
    sinks.export_delimited(df, [f"{tmp_path}/one", f"{tmp_path}/two"], file_bytes=2_000)
    until = time.time() + 20
    while kept() - before and time.time() < until:
        time.sleep(0.2)
    assert not kept() - before
    assert spark.conf.get(REMOVE_SHUFFLES) == "false", "the setting is as it was"
    assert [sinks.read_delimited(spark, f"{tmp_path}/{t}", ["k", "n"]).count() for t in ("one", "two")] == [700, 700]
    assert df.count() == 700, "the query can run again"


def test_spend_rows_travel_once_by_event_and_once_by_participant(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    for name in ("spend_export", "value_lines"):
        shuffles = exchange_columns(QUERIES[name](Inputs(spark, SMALL)))
        attendees = [c for c in shuffles if "copay_hotel_merc__c" in c or "_copay_hotel_merc__c" in c]
        assert len(attendees) == 3 + 1, f"{name}: by meeting, by account, by event, by participant"
        assert not any({"valuepaiddt", "_owner"} & set(c) for c in shuffles), f"{name}: rows joined with their days stay"
        assert sum("owner_master_id_merc__c" in c and "id1" not in c for c in shuffles) == 1, f"{name}: events travel once"
