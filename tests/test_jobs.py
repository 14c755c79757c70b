"""Whole jobs over stored tables and landed files."""

from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import planned
from martloom.catalog import queries as Q
from martloom.catalog.inputs import Inputs
from martloom.context import RunContext
from martloom.plans import columns as C
from martloom.plans import jobs, products, spend
from martloom.session import scratch_path
from martloom.sources.sinks import read_delimited, write_stage
from martloom.sources.state import Bookmark
from martloom.sources.tables import Folder, read_table

FIRST = RunContext(datetime(2024, 1, 2, 3, 4, 5), 77, date(2021, 6, 1))
SECOND = RunContext(datetime(2024, 1, 3, 3, 4, 5), 78, date(2021, 6, 1))


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, "/root/testdata/sf0.001")


@pytest.fixture
def places(spark):
    base = scratch_path(spark, "test-job")
    return jobs.Places(Folder(f"{base}/source"), Folder(f"{base}/stage"), f"{base}/state")


def store(inputs, places, tables, bundle):
    for name, table in bundle.items():
        df = inputs[tables.get(name, f"in_{name}")]
        back = {new: old for old, new in jobs.PLAN_NAMES.get(name, {}).items()}
        write_stage(df.withColumnsRenamed(back), places.source, table)


def test_product_job(spark, inputs, places, rows):
    store(inputs, places, {}, jobs.PRODUCT_TABLES)
    assert jobs.stage_products(spark, places, "OWN", Q.SINCE, FIRST) == (Q.SINCE, "2024-01-02 03:04:05")
    staged = read_table(spark, places.stage, "product_stage")
    expected = products.product_feed(Q.product_tables(inputs), Q.SINCE, "OWN", FIRST)
    assert rows(staged) == rows(expected) and staged.count() > 100
    assert jobs.stage_products(spark, places, "OWN", Q.SINCE, SECOND)[0] == "2024-01-02 03:04:05"
    assert read_table(spark, places.stage, "product_stage").count() == 0, "nothing was published since"
    target = scratch_path(spark, "test-export")
    jobs.stage_products(spark, jobs.Places(places.source, places.stage, f"{places.state}/again"), "OWN", Q.SINCE, FIRST)
    jobs.export_stage(spark, places.stage, "product_stage", "product", target)
    names = [C.EXPORT_PRODUCT_NAMES.get(c, c) for c in staged.columns] + ["Name"]
    out = read_delimited(spark, target, names)
    assert out.count() == expected.count()
    assert out.filter(F.col("Cease_pblsh_dt__c") > "4000-12-31").count() == 0


@pytest.mark.parametrize("since", ["2021-06-01", "2021-09-25", "2019-06-01", "2030-01-01"])
def test_touched_products_give_the_whole_result(spark, inputs, rows, since):
    t = Q.product_tables(inputs)
    touched = products.touched_products(t, since)
    assert touched.count() == touched.distinct().count()
    restricted = products.product_feed(products.restrict(t, touched), since, "OWN", FIRST)
    assert rows(restricted) == rows(products.product_feed(t, since, "OWN", FIRST))


def test_few_touched_products_are_broadcast(spark, inputs, places):
    store(inputs, places, {}, jobs.PRODUCT_TABLES)
    tables = jobs.load_bundle(spark, places.source, jobs.PRODUCT_TABLES, None)
    touched = jobs._stored(products.touched_products(tables, "2021-09-25"), "test-touched")
    plan = planned(products.restrict(tables, touched)["links"])
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan and "hashpartitioning" not in plan


def test_group_and_indication_jobs(spark, inputs, places):
    store(inputs, places, {"translations": "in_source_translations", "dialects": "in_dialects", "parents": "in_parents"}, jobs.GROUP_TABLES)
    seen = []

    def groups_since(after):
        seen.append(after)
        return inputs["in_group_source"]

    jobs.stage_groups(spark, places, groups_since, Q.GROUP_TYPES, "2020-01-01", FIRST)
    assert read_table(spark, places.stage, "product_group_stage").count() > 500
    jobs.stage_groups(spark, places, groups_since, Q.GROUP_TYPES, "2020-01-01", SECOND)
    assert seen[0] == "2020-01-01" and seen[-1] == "2024-01-02 03:04:05"
    store(
        inputs,
        places,
        {"translations": "in_indication_translations", "dialects": "in_dialects", "replicated_groups": "in_indication_groups"},
        jobs.INDICATION_TABLES,
    )
    jobs.stage_indications(spark, places, lambda after: inputs["in_indication"], "OWN", "2020-01-01", FIRST)
    assert read_table(spark, places.stage, "indication_stage").count() > 500


def test_spend_jobs(spark, inputs, places, rows):
    landing = jobs.Landing(*[scratch_path(spark, f"test-{n}") for n in ("meeting", "participant", "account", "day")])
    for folder, name in zip((landing.meetings, landing.participants, landing.accounts, landing.day_values), ("meeting", "participant", "account", "day_value"), strict=True):
        inputs[f"in_{name}"].write.json(folder)
    run = RunContext(datetime(2000, 6, 30), 77)
    windows = jobs.stage_spend(spark, places, landing, Q.RULES, run)
    assert set(windows.values()) == {(Q.AFTER, Q.UNTIL)}
    targets = [scratch_path(spark, "test-export") for _ in range(2)]
    jobs.export_spend(spark, places.stage, Q.IDENTITY, targets)
    expected = spend.spend_export(Q.staged_spend(inputs), Q.IDENTITY)
    as_text = expected.select([F.col(c).cast("string") for c in expected.columns])
    for target in targets:
        found = read_delimited(spark, target, C.SPEND_EXPORT, "\t")
        assert found.count() == as_text.count() > 1000
        assert found.exceptAll(as_text).count() == 0
    assert Bookmark(spark, f"{places.state}/bookmark/spend_event_stage").read("") == Q.UNTIL
    # the next window starts where this one ended
    later = RunContext(datetime(2001, 6, 30), 78)
    windows = jobs.stage_spend(spark, places, landing, Q.RULES, later)
    assert set(windows.values()) == {(Q.UNTIL, "2001-06-30T00:00:00.000Z")}
    rules = replace(Q.RULES, after=Q.UNTIL, until="2001-06-30T00:00:00.000Z")
    direct = spend.day_value_stage(inputs["in_day_value"], inputs["in_participant"], inputs["in_meeting"], rules, later)
    assert rows(read_table(spark, places.stage, "spend_day_value_stage")) == rows(direct)


def test_written_back_ids_are_numbers(spark, places):
    ids = spark.createDataFrame([("S1", "12.0", "1C1"), ("S2", "x", "2C1")], "SFDC_ID string, PROD_ID_GLBL__C string, PRODUCT_EXTERNAL_ID__C string")
    write_stage(ids, places.source, "ids")
    bundle = jobs.load_bundle(spark, places.source, {"replicated_products": "replaced below"}, {"replicated_products": "ids"})
    found = bundle["replicated_products"]
    assert found.columns == ["sfdc_id", "prod_id", "product_external_id"]
    assert {r["sfdc_id"]: r["prod_id"] for r in found.collect()} == {"S1": 12, "S2": None}


def test_a_second_writer_of_a_bookmark_fails(spark):
    bookmark = Bookmark(spark, scratch_path(spark, "test-bookmark"))
    bookmark.commit("2024", 1, "2023")
    after, _ = bookmark.window("2023", "2025", 2)
    bookmark.commit("2025", 3, after)
    with pytest.raises(RuntimeError, match="another run"):
        bookmark.commit("2026", 2, after)
    assert bookmark.read("2023") == "2025"


def test_a_failed_run_leaves_the_stage_as_it_was(spark):
    target = Folder(scratch_path(spark, "test-stage"))
    write_stage(spark.range(5), target, "t")
    broken = spark.range(3).select(F.raise_error(F.lit("stopped")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="stopped"):
        write_stage(broken, target, "t")
    assert read_table(spark, target, "t").count() == 5
    write_stage(read_table(spark, target, "t").filter("id > 2"), target, "t")
    assert read_table(spark, target, "t").count() == 2
