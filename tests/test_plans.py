"""Reference-data plans on small literal frames: the cases where the rules surprise."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import exchange_columns, planned
from martloom.catalog.inputs import Inputs
from martloom.catalog.queries import FEED_TYPES, SINCE, product_tables
from martloom.context import RunContext
from martloom.plans import columns as C
from martloom.plans import exports, groups, indications, products, writeback
from martloom.session import scratch_path

RUN = RunContext(datetime(2024, 1, 2, 3, 4, 5), 7, date(2021, 6, 1))
DAYS = {c for c in C.PRODUCT_MASTER if c.endswith("_dt")}
OLD, NEW = date(2020, 1, 1), date(2022, 1, 1)


def frame(spark, ddl, *data):
    return spark.createDataFrame(list(data), ddl)


def master(spark, *products_):
    ddl = ", ".join(f"{c} {'date' if c in DAYS else 'bigint' if c == 'prod_id' else 'string'}" for c in C.PRODUCT_MASTER)
    return spark.createDataFrame([tuple(p.get(c) for c in C.PRODUCT_MASTER) for p in products_], ddl)


def product(prod_id, prod_typ="SAMPLE", lst=NEW, **more):
    return {"prod_id": prod_id, "prod_nm": f"p{prod_id}", "prod_typ": prod_typ, "lst_pblsh_dt": lst, "start_dt": OLD, "end_dt": date(2030, 1, 1), **more}


@pytest.fixture
def tables(spark):
    link = "prod_child_id bigint, prod_grp_prnt_id bigint, end_dt date, cease_pblsh_dt date, lst_pblsh_dt date"
    text = "prod_id bigint, cntry_cd string, dialect_nm string, trnsltd_dsply_nm string, trnsltd_prod_desc_txt string, start_dt date, end_dt date, cease_pblsh_dt date, lst_pblsh_dt date"
    other = "prod_id bigint, cntry_cd string, altrnt_id_type_cd string, altrnt_id string, start_dt date, end_dt date, cease_pblsh_dt date, lst_pblsh_dt date"
    return {
        "prod": master(spark, product(1), product(2, "OWN"), product(3, lst=OLD)),
        "groups": frame(spark, "prod_grp_id bigint, grp_prps_cd string", (10, "STGH"), (20, "BRND"), (30, "MKTP")),
        "links": frame(
            spark, link, (1, 20, date(2029, 1, 1), None, OLD), (2, 10, date(2028, 1, 1), date(2027, 1, 1), OLD), (3, 20, date(2029, 1, 1), None, OLD)
        ),
        "group_links": frame(
            spark, "prod_grp_id_child bigint, prod_grp_id_prnt bigint, cntry_cd string", (10, 20, "C1"), (10, 30, "C1"), (10, 30, "C9")
        ),
        "translations": frame(
            spark,
            text,
            (1, "C1", "EN", "one", None, OLD, date(2031, 1, 1), None, OLD),
            (2, "C1", "EN", None, "text", date(2021, 1, 1), date(2027, 5, 1), None, OLD),
            (2, "C2", "EN", "two", "text", OLD, date(2027, 5, 1), None, OLD),
            (3, "C1", "EN", "three", None, OLD, date(2031, 1, 1), None, OLD),
        ),
        "alternates": frame(
            spark,
            other,
            (1, "C1", "T0", "A1", date(2020, 6, 1), date(2026, 1, 1), date(2025, 1, 1), OLD),
            (2, "C1", "T0", "A2", OLD, date(2026, 1, 1), date(2025, 1, 1), OLD),
            (3, "C1", "T9", "A3", OLD, date(2026, 1, 1), None, OLD),
        ),
        "group_translations": frame(
            spark,
            "prod_grp_id bigint, cntry_cd string, dialect_nm string, end_dt date, cease_pblsh_dt date, lst_pblsh_dt date",
            (20, "C1", "EN", date(2024, 1, 1), date(2023, 1, 1), OLD),
            (20, "C1", "FR", date(2024, 1, 1), None, OLD),
        ),
        "params": frame(
            spark,
            "cntry_cd string, grp_prps_cd string, dialect_nm string, altrnt_id_type_cd string, recordtype string",
            ("C1", "BRND", "EN", "T0", "RT_B"),
            ("C1", "MKTP", "EN", "T0", "RT_M"),
        ),
        "replicated_groups": frame(
            spark, "sfdc_id string, prod_grp_id bigint, cntry_cd string", ("S20", 20, "C1"), ("S30", 30, "C1"), ("S30b", 30, "C1")
        ),
        "replicated_products": frame(
            spark, "sfdc_id string, prod_id bigint, cntry_cd string, product_external_id string", ("P", 9, "C1", "none")
        ),
    }


def test_sample_feed_takes_changed_products_of_brand_groups(tables, rows):
    feed = products.sample_feed(tables, SINCE)
    assert feed.columns == C.PRODUCT_FEED
    assert rows(feed, *C.FEED_LINKS, "prod_id") == [(20, "C1", "BRND", date(2029, 1, 1), date(9999, 12, 31), 1)]


def test_a_change_anywhere_brings_the_product_back(tables, rows):
    changed = {**tables, "links": tables["links"].withColumn("lst_pblsh_dt", F.lit(NEW))}
    assert rows(products.sample_feed(changed, SINCE), "prod_id") == [(1,), (3,)]


def test_market_feed_needs_three_countries_to_agree(tables, rows):
    assert rows(products.market_feed(tables, SINCE, FEED_TYPES), "prod_id", "prod_grp_prnt_id", "cntry_cd") == [(2, 30, "C1")]
    elsewhere = {**tables, "group_links": tables["group_links"].filter("cntry_cd = 'C9'")}
    assert products.market_feed(elsewhere, SINCE, FEED_TYPES).count() == 0


def test_brand_feed_needs_the_dialect_and_repeats_per_group_dialect(tables, rows):
    expected = [(2, 20, "C1")]
    feed = products.brand_feed(tables, SINCE, FEED_TYPES)
    assert rows(feed, "prod_id", "prod_grp_prnt_id", "cntry_cd") == expected * 2
    other = {**tables, "params": tables["params"].withColumn("dialect_nm", F.lit("DE"))}
    assert products.brand_feed(other, SINCE, FEED_TYPES).count() == 0


def test_reconciled_dates_depend_on_the_purpose(tables, rows):
    feed = products.union_feeds([products.sample_feed(tables, SINCE), products.market_feed(tables, SINCE, FEED_TYPES)])
    df = products.reconcile_dates(products.add_lookups(products.expand_feed(feed, tables["params"]), tables))
    found = {r["grp_prps_cd"]: r for r in df.collect()}
    # brand rows use the group translation, market rows the alternate id
    assert (found["BRND"]["cease_pblsh_dt"], found["BRND"]["end_dt"]) == (date(2023, 1, 1), date(2024, 1, 1))
    assert (found["MKTP"]["cease_pblsh_dt"], found["MKTP"]["end_dt"]) == (date(2025, 1, 1), date(2026, 1, 1))
    assert found["BRND"]["start_dt"] == date(2020, 6, 1)


def test_all_open_cease_dates_stay_far_future(spark, tables):
    open_ = {**tables}
    for name in ("alternates", "group_translations", "links"):
        open_[name] = tables[name].withColumn("cease_pblsh_dt", F.lit(None).cast("date"))
    staged = products.product_feed(open_, SINCE, "OWN", RUN)
    assert {r["cease_pblsh_dt__c"] for r in staged.collect()} == {date(9999, 12, 31)}


def test_product_feed(tables, rows):
    staged = products.product_feed(tables, SINCE, "OWN", RUN)
    assert staged.columns[: len(C.STAGED_PRODUCT)] == list(C.STAGED_PRODUCT.values()) and len(C.STAGED_PRODUCT) == 54
    assert rows(staged, "product_external_id__c", "product_group__c", "recordtype", "created_by_job_exec_id") == [
        ("BRND201C1T0", "S20", "RT_B", 7),
        ("BRND202C1T0", "S20", "RT_B", 7),
        ("MKTP302C1T0", "S30", "RT_M", 7),
    ]


def test_incomplete_rows_remove_no_product(spark, tables, rows):
    none = F.lit(None).cast("string")
    blank = {
        "translations": {"trnsltd_dsply_nm": none, "trnsltd_prod_desc_txt": none},
        "alternates": {"altrnt_id": none},
        "replicated_groups": {"sfdc_id": none},
    }
    more = {name: tables[name].unionByName(tables[name].withColumns(columns)) for name, columns in blank.items()}
    before = rows(products.product_feed(tables, SINCE, "OWN", RUN))
    assert before and rows(products.product_feed({**tables, **more}, SINCE, "OWN", RUN)) == before


def test_expired_products_stay_only_when_replicated(spark, tables, rows):
    late = RunContext(RUN.run_ts, 7, date(2025, 6, 1))
    assert products.product_feed(tables, SINCE, "OWN", late).count() == 0
    known = frame(spark, "sfdc_id string, prod_id bigint, cntry_cd string, product_external_id string", ("P", 1, "C1", "BRND201C1T0"))
    staged = products.product_feed({**tables, "replicated_products": known}, SINCE, "OWN", late)
    assert rows(staged, "product_external_id__c") == [("BRND201C1T0",)]


def test_without_alternate_id_the_external_id_lacks_its_type(tables, rows):
    changed = {**tables, "prod": tables["prod"].withColumn("lst_pblsh_dt", F.lit(NEW))}
    picked = products.candidates(products.sample_feed(changed, SINCE), changed)
    assert rows(picked, "product_external_id", "altrnt_id") == [("BRND201C1T0", "A1"), ("BRND203C1", None)]
    assert picked.filter(products.eligible(RUN.as_of_date)).count() == 1


def test_feeds_push_filters_and_columns_to_the_scan(spark, settings):
    settings(spark__sql__maxMetadataStringLength="4000")
    stored = scratch_path(spark, "test-prod")
    inputs = Inputs(spark, "/root/testdata/sf0.001")
    inputs["in_prod"].withColumn("unused", F.lit("x")).write.parquet(stored)
    t = {**product_tables(inputs), "prod": spark.read.parquet(stored)}
    plan = planned(products.market_feed(t, SINCE, FEED_TYPES))
    scan = next(line for line in plan.splitlines() if "test-prod" in line)
    assert "In(prod_typ, [COMPETITOR,OWN])" in scan
    assert "unused" not in scan


# Product groups

GROUP_DDL = ", ".join(
    f"{c} {'bigint' if c == 'prod_grp_id' else 'date' if c.endswith('_dt') else 'string'}" for c in C.GROUP_SOURCE
)
TYPES = groups.GroupTypes("COMPETITOR", ("OWN", "COMBO", "COLLABORATOR"))


def group(prod_grp_id, cntry_cd, end_dt, prod_grp_typ="OWN", **more):
    row = {"prod_grp_id": prod_grp_id, "cntry_cd": cntry_cd, "end_dt": end_dt, "prod_grp_typ": prod_grp_typ, "grp_nm": f"g{prod_grp_id}", **more}
    return tuple(row.get(c) for c in C.GROUP_SOURCE)


def group_tables(spark, *source):
    return {
        "source": spark.createDataFrame(list(source), GROUP_DDL),
        "dialects": frame(spark, "country_code string, dialect string", ("C1", "FR"), ("C2", "EN"), ("C3", None)),
        "translations": frame(
            spark,
            "prod_grp_id bigint, cntry_cd string, dialect_nm string, trnsltd_grp_nm string, end_dt date",
            (1, "C1", "FR", "un", date(2022, 1, 1)),
            (1, "US", "EN", "one", None),
        ),
        "parents": frame(spark, "prod_grp_id_child bigint, prod_grp_id_prnt bigint", (1, 100), (1, 100), (1, 101)),
    }


def test_router_drops_rows_without_country(spark):
    t = group_tables(spark, group(1, "ZZ", OLD), group(1, "C1", OLD), group(1, None, OLD))
    everywhere, country = groups.route(t["source"])
    assert (everywhere.count(), country.count()) == (1, 1)


def test_country_rows_need_their_dialect_or_english(spark, rows):
    t = group_tables(spark, group(1, "C1", NEW), group(2, "C1", NEW), group(2, "C2", NEW), group(2, "C3", NEW))
    kept = groups.country_rows(groups.translated_rows(t["source"], t))
    assert rows(kept, "prod_grp_prnt_id", "cntry_cd", "dialect_nm") == [(1, "C1", "FR"), (2, "C2", "EN")]


def test_synthesis_uses_the_unclipped_end(spark, rows):
    t = group_tables(spark, group(1, "C1", date(2023, 1, 1)), group(1, "C2", date(2021, 1, 1)))
    staged = groups.group_feed(t, TYPES, RUN)
    found = rows(staged, "cntry_cd_glbl__c", "end_dt_glbl__c", "glbl_parent_product_group__c", "prod_grp_external_id_glbl__c")
    assert found == [
        ("C1", date(2022, 1, 1), 100, "1C1"),
        ("C1", date(2022, 1, 1), 101, "1C1"),
        ("C2", date(2021, 1, 1), 100, "1C2"),
        ("C2", date(2021, 1, 1), 101, "1C2"),
        ("ZZ", date(2023, 1, 1), 100, "1ZZ"),
        ("ZZ", date(2023, 1, 1), 101, "1ZZ"),
    ]


def test_class_filter(spark, rows):
    kinds = ["OWN", "'COMBO'", "COLLABORATOR", "COMPETITOR", "'COMPETITOR'", None, "OTHER"]
    df = frame(spark, "prod_grp_typ_cd string, cntry_cd string", *[(k, c) for k in kinds for c in ("ZZ", "C1", None)])
    kept = rows(df.filter(groups.class_filter(TYPES)))
    assert {k for k, c in kept if c == "ZZ"} == {"OWN", "'COMBO'", "COLLABORATOR"}
    assert {k for k, c in kept if c == "C1"} == {"OWN", "'COMBO'", "COLLABORATOR", "COMPETITOR", "'COMPETITOR'", None}
    assert {k for k, c in kept if c is None} == {"OWN", "'COMBO'", "COLLABORATOR"}


def test_global_and_synthesised_rows_of_a_group_become_one(spark, rows):
    t = group_tables(spark, group(1, "ZZ", date(2020, 1, 1)), group(1, "C1", date(2023, 1, 1)))
    unique = groups.group_rows(t, TYPES)
    assert rows(unique.filter("cntry_cd = 'ZZ'"), "end_dt") == [(date(2023, 1, 1),)]


# Indications

INDICATION_DDL = ", ".join(
    f"{c} {'bigint' if c == 'prod_grp_id' else 'date' if c.endswith('_dt') else 'string'}" for c in C.INDICATION_SOURCE
)


def indication(prod_grp_id, indctn_id, cntry_cd, end_dt, prod_grp_typ="'OWN'", **more):
    row = {"prod_grp_id": prod_grp_id, "indctn_id": indctn_id, "cntry_cd": cntry_cd, "end_dt": end_dt, "prod_grp_typ": prod_grp_typ, **more}
    return tuple(row.get(c) for c in C.INDICATION_SOURCE)


def test_indication_feed(spark, rows):
    t = {
        "source": spark.createDataFrame(
            [
                indication(1, "I1", "C1", OLD, indctn_desc="z"),
                indication(1, "I1", "C1", NEW, indctn_desc="a"),
                indication(1, "I1", "C1", NEW, indctn_desc="a"),
                indication(1, "I1", "C9", NEW, indctn_desc="zz"),
                indication(1, "I2", "C1", NEW),
                indication(2, "I1", "C1", None, "COMPETITOR"),
                indication(2, "I1", "C2", NEW, "COMPETITOR"),
            ],
            INDICATION_DDL,
        ),
        "dialects": frame(spark, "country_code string, dialect string", ("C1", "FR"), ("C2", "EN")),
        "translations": frame(
            spark,
            "indctn_id string, dialect_nm string, trnsltd_indctn_desc_txt string, trnsltd_indctn_short_desc string",
            ("I1", "FR", "un", None),
            ("I1", "EN", "one", "1"),
            ("I2", "FR", None, "2"),
        ),
        "replicated_groups": frame(
            spark, "sfdc_id string, prod_grp_external_id string", ("own", "1C1"), ("global1", "1ZZ"), ("global2", "2ZZ")
        ),
    }
    staged = indications.indication_feed(t, "OWN", RUN)
    assert rows(
        staged, "indctn_ext_id_glbl__c", "indctn_desc_glbl__c", "end_dt_glbl__c", "prod_grp_prnt_id_glbl_sfdc_id", "dialect_nm_glbl__c"
    ) == [
        # the global row takes the maxima over all translated rows, also those that are not the latest
        ("1I1C1", "a", NEW, "own", "FR"),
        ("1I1ZZ", "z", NEW, "global1", "EN"),
        ("2I1C2", None, NEW, "global2", "EN"),
    ]


# Exports and write-back


def test_product_export_names_and_order(spark):
    ddl = ", ".join(f"{c.upper()} {'date' if c in C.EXPORT_PRODUCT_DATES else 'string'}" for c in C.EXPORT_PRODUCT)
    row = {"END_DT__C": date(9999, 12, 31), "LST_LOT_EXPRTN_DT__C": None, "TRNSLTD_DSPLY_NM__C": "n" * 90, "BRND_CD__C": ""}
    df = spark.createDataFrame([tuple(row.get(c.upper()) for c in C.EXPORT_PRODUCT)], ddl)
    out = exports.export_product(df)
    assert len(out.columns) == 92 and out.columns[-1] == "Name" and out.columns[0] == "Alternate_ID__c"
    first = out.head()
    assert (first["end_dt__c"], first["Lst_lot_exprtn_dt__c"], len(first["Name"])) == ("4000-12-31", "#N/A", 80)
    assert (first["Brnd_cd__c"], first["Prod_nm__c"], len(first["Trnsltd_Dsply_Nm__c"])) == ("#N/A", None, 90)


def test_group_export_name_choice(spark, rows):
    ddl = ", ".join(
        f"{c} {'date' if c.endswith('_dt_glbl__c') else 'string'}" for c in C.EXPORT_GROUP_NAMES
    )
    made = [{"cntry_cd_glbl__c": "ZZ", "trnsltd_grp_nm_glbl__c": "t"}, {"cntry_cd_glbl__c": "C1", "trnsltd_grp_nm_glbl__c": "t"}, {"cntry_cd_glbl__c": "C1"}]
    df = spark.createDataFrame([tuple({**m, "name": "base"}.get(c) for c in C.EXPORT_GROUP_NAMES) for m in made], ddl)
    out = exports.export_group(df)
    assert rows(out, "Name", "Trnsltd_Grp_Nm_GLBL__c", "Untrnsltd_Grp_Nm_GLBL__c") == [
        ("base", "#N/A", "base"),
        ("base", "t", "base"),
        ("t", "t", "base"),
    ]


def test_group_ids_are_double(spark):
    df = frame(spark, ", ".join(f"{c} string" for c in C.LANDED_GROUP_ID), ("S", "1ZZ", "ZZ", "1"), ("S", "x", "ZZ", "x"))
    ids = writeback.group_ids(df)
    assert ids.schema["prod_grp_id_glbl__c"].dataType.simpleString() == "double"
    assert sorted((r["prod_grp_id_glbl__c"] for r in ids.collect()), key=str) == [1.0, None]


def test_repeated_master_rows_are_picked_over_all_columns(spark, tables, rows):
    """Late master columns give the row that a pick over whole rows gives."""
    twins = [product(1, brnd_cd=b, mtrl_nbr=m, lst=lst) for b, m, lst in (("b", "1", NEW), ("a", "2", NEW), ("a", "1", NEW), ("A", "0", OLD))]
    t = {**tables, "prod": master(spark, *twins)}
    staged = products.product_feed(t, SINCE, "OWN", RUN)
    whole = products.candidates(products.sample_feed(t, SINCE), t).filter(products.eligible(RUN.as_of_date))
    assert rows(staged, "prod_id__c", "brnd_cd__c", "mtrl_nbr__c", "lst_pblsh_dt__c") == [(1, "a", "1", NEW)]
    assert rows(whole, "prod_id", "brnd_cd", "mtrl_nbr", "lst_pblsh_dt") == [(1, "a", "1", NEW)]


def test_staging_shuffles_whole_master_rows_only_at_the_end(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    inputs = Inputs(spark, "/root/testdata/sf0.001")
    shuffles = exchange_columns(products.product_feed(product_tables(inputs), SINCE, "OWN", RUN))
    assert len(shuffles) > 40
    assert sum("mtrl_nbr" in columns for columns in shuffles) == 1, "the master side of the last join"
    assert sum("min" in columns for columns in shuffles) == 2, "the pick over narrow rows and the one over joined rows"
