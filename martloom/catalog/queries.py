"""The registered queries: every operator and plan over the derived inputs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.catalog.inputs import GIVEN, Inputs
from martloom.context import AUDIT_FIELDS, RunContext, audit_stamp
from martloom.functions import dates, text
from martloom.operators import history as H
from martloom.operators import pick
from martloom.operators.incremental import changed_since, window_rows
from martloom.operators.lookup import group_parents, lookup, lookup_with_fallback
from martloom.operators.schema import all_text, enforce_schema, schema_of_codes
from martloom.plans import columns as C
from martloom.plans import exports, groups, indications, jobs, products, spend, writeback
from martloom.plans.replicate import bulk_replicate
from martloom.plans.runner import IncrementalJob
from martloom.session import scratch_path, size_shuffle, tune
from martloom.sources.landing import read_landing
from martloom.sources.sinks import export_delimited, export_single_file, read_delimited, write_stage
from martloom.sources.state import Bookmark, HistoryTable
from martloom.sources.tables import Folder, read_table, run_query
from martloom.streaming.history import stream_history
from martloom.streaming.landing import ingest_landing, ingest_with_rejects, landed_lines, landing_stream

SINCE = "2021-06-01"
RUN = RunContext(run_ts=datetime(2024, 1, 2, 3, 4, 5), exec_id=77, as_of=date(2021, 6, 1))
NEXT_RUN = RunContext(run_ts=datetime(2024, 1, 3, 3, 4, 5), exec_id=78, as_of=date(2021, 6, 1))
OWN = "OWN"
FEED_TYPES = (products.COMPETITOR, OWN)
GROUP_TYPES = groups.GroupTypes(competitor="COMPETITOR", everywhere=("OWN", "COMBO", "COLLABORATOR"))
AFTER, BETWEEN, UNTIL = "1996-01-01T00:00:00.000Z", "1998-03-01T00:00:00.000Z", "2000-06-30T00:00:00.000Z"
RULES = spend.SpendRules(AFTER, UNTIL, excluded_countries=("C3", "C7"), statuses=("Attended", "No Show"))
IDENTITY = spend.SpendIdentity("COMPANY", "SOURCE", "COMPANY", "EVENTS")

Query = Callable[[Inputs], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def plain(df: DataFrame) -> DataFrame:
    """Dates, timestamps and decimals as text, so that any client compares them alike."""
    as_text = (T.DateType, T.TimestampType, T.DecimalType)
    return df.select(
        [F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, as_text) else F.col(f.name) for f in df.schema]
    )


def callable_for(function: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        tune(spark)
        size_shuffle(spark, [folder])
        return plain(function(Inputs(spark, folder)))

    return run


# Bundles of inputs, by the names the plans use.


def product_tables(i: Inputs) -> products.Tables:
    names = "prod links groups group_links translations alternates group_translations params replicated_groups replicated_products"
    return {n: i[f"in_{n}"] for n in names.split()}


def group_tables(i: Inputs) -> groups.Tables:
    return {
        "source": i["in_group_source"],
        "translations": i["in_source_translations"],
        "dialects": i["in_dialects"],
        "parents": i["in_parents"],
    }


def indication_tables(i: Inputs) -> indications.Tables:
    return {
        "source": i["in_indication"],
        "dialects": i["in_dialects"],
        "translations": i["in_indication_translations"],
        "replicated_groups": i["in_indication_groups"],
    }


def whole_feed(i: Inputs, master: Sequence[str] = products.PRODUCT_MASTER) -> DataFrame:
    """The rows of the three feeds with those columns of the master."""
    t = product_tables(i)
    t["prod"] = t["prod"].select([c for c in t["prod"].columns if c in ("prod_id", *master)])
    return products.union_feeds(
        [
            products.sample_feed(t, SINCE),
            products.market_feed(t, SINCE, FEED_TYPES),
            products.brand_feed(t, SINCE, FEED_TYPES),
        ]
    )


def looked_up_feed(i: Inputs) -> DataFrame:
    t = product_tables(i)
    return products.add_lookups(products.expand_feed(whole_feed(i), t["params"]), t)


FEED_KEYS = ["prod_id", "prod_grp_prnt_id", "grp_prps_cd", "cntry_cd"]


def history_rows(i: Inputs) -> DataFrame:
    made = F.col("created_day").cast("timestamp")
    return i["in_history"].select(
        "k",
        "payload",
        "is_active",
        made.alias("created_ts"),
        made.alias("updated_ts"),
        F.col("exec_id").alias("created_by_job_exec_id"),
        F.col("exec_id").alias("updated_by_job_exec_id"),
    )


# Sources and sinks


@query("typed_scan")
def typed_scan(i: Inputs) -> DataFrame:
    landed = all_text(
        i.given("lineitem").select(
            "l_orderkey",
            "l_partkey",
            "l_linenumber",
            "l_quantity",
            F.when(F.col("l_returnflag") == "R", F.lit("n/a"))
            .otherwise(F.col("l_extendedprice").cast("decimal(16,2)").cast("string"))
            .alias("l_extendedprice"),
            F.col("l_shipdate").cast("date").alias("l_shipdate"),
            "l_returnflag",
        )
    )
    codes = {
        "l_shipdate": 1082,
        "l_orderkey": 20,
        "l_partkey": 23,
        "l_linenumber": 21,
        "l_quantity": 701,
        "l_extendedprice": 1700,
        "l_returnflag": 1043,
        "l_comment": 25,
    }
    return enforce_schema(landed, schema_of_codes(codes))


@query("landing_json")
def landing_json(i: Inputs) -> DataFrame:
    folder = scratch_path(i.spark, "landing")
    events = i.given("events")
    landed = events.withColumn("day", F.col("ts").cast("date")).select(
        "day", *[F.col(c).cast("string").alias(c) for c in ("event_id", "user_id", "event_type", "value")]
    )
    landed.write.partitionBy("day").json(folder)
    back = read_landing(i.spark, folder, ["event_id", "user_id", "event_type", "value"])
    return back.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("user_id").cast("bigint").alias("user_id"),
        "event_type",
        F.col("value").cast("double").alias("value"),
    )


@query("landing_arrays")
def landing_arrays(i: Inputs) -> DataFrame:
    folder = scratch_path(i.spark, "landing")
    i["in_landed_line"].write.text(folder)
    rows = read_landing(i.spark, folder, ["event_id", "event_type"])
    return rows.select(F.col("event_id").cast("bigint").alias("event_id"), "event_type")


@query("template_params")
def template_params(i: Inputs) -> DataFrame:
    return run_query(
        i.spark,
        """
        SELECT prod_id, prod_nm, prod_typ, lst_pblsh_dt FROM {prod}
        WHERE lst_pblsh_dt > :since AND array_contains(:types, prod_typ);
        """,
        tables={"prod": i["in_prod"]},
        args={"since": date.fromisoformat(SINCE), "types": F.array(F.lit("COMPETITOR"), F.lit(OWN))},
    )


@query("stage_snapshot")
def stage_snapshot(i: Inputs) -> DataFrame:
    target = Folder(scratch_path(i.spark, "stage"))
    staged = i["in_stage"].toDF("K", "Payload")
    write_stage(staged.withColumn("Payload", F.lit("previous run")), target, "stage")
    write_stage(staged, target, "stage")
    return read_table(i.spark, target, "stage")


@query("bulk_replicate")
def bulk_replicate_tables(i: Inputs) -> DataFrame:
    source = Folder(i.folder, suffix=".parquet")
    target = Folder(scratch_path(i.spark, "replica"))
    report = {r.table: r.rows for r in bulk_replicate(i.spark, source, target, GIVEN)}
    counts = [
        read_table(i.spark, target, t).agg(
            F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.lit(report[t]).cast("bigint").alias("n_reported")
        )
        for t in GIVEN
    ]
    return products.union_feeds(counts)



@query("replicated_rows")
def replicated_rows(i: Inputs) -> DataFrame:
    target = Folder(scratch_path(i.spark, "replica"))
    bulk_replicate(i.spark, Folder(i.folder, suffix=".parquet"), target, ["customer", "supplier"])
    customer, supplier = (read_table(i.spark, target, t) for t in ("customer", "supplier"))
    return customer.select(
        F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    ).unionByName(
        supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    )


@query("id_writeback_product")
def id_writeback_product(i: Inputs) -> DataFrame:
    folder, target = scratch_path(i.spark, "landing"), Folder(scratch_path(i.spark, "ids"))
    i["in_landed_product_ids"].write.json(folder)
    writeback.write_back_product_ids(i.spark, folder, target, "product_ids")
    return read_table(i.spark, target, "product_ids")


@query("id_writeback_group")
def id_writeback_group(i: Inputs) -> DataFrame:
    folder, target = scratch_path(i.spark, "landing"), Folder(scratch_path(i.spark, "ids"))
    i["in_landed_group_ids"].write.json(folder)
    writeback.write_back_group_ids(i.spark, folder, target, "group_ids")
    return read_table(i.spark, target, "group_ids")


@query("export_csv_roundtrip")
def export_csv_roundtrip(i: Inputs) -> DataFrame:
    folder = scratch_path(i.spark, "export")
    formatted = exports.export_group(i["in_export_group"])
    export_delimited(formatted, [folder])
    return read_delimited(i.spark, folder, formatted.columns)


@query("export_tsv_roundtrip")
def export_tsv_roundtrip(i: Inputs) -> DataFrame:
    folders = [scratch_path(i.spark, "export"), scratch_path(i.spark, "export")]
    formatted = spend.spend_export(staged_spend(i), IDENTITY)
    export_delimited(formatted, folders, sep="\t")
    return read_delimited(i.spark, folders[1], formatted.columns, sep="\t")


@query("export_single_file")
def export_single_file_roundtrip(i: Inputs) -> DataFrame:
    folder = scratch_path(i.spark, "single")
    formatted = exports.export_group(i["in_export_group"])
    export_single_file(formatted, f"{folder}/groups.csv")
    return read_delimited(i.spark, f"{folder}/groups.csv", formatted.columns)


# Projections, filters and scalar expressions


@query("audit_stamp")
def audit_stamped(i: Inputs) -> DataFrame:
    return audit_stamp(i["in_stage"], RUN)



@query("incremental_window")
def incremental_window(i: Inputs) -> DataFrame:
    updated = "Participant_ToV_Updated_Date_MERC__c"
    by_instant = window_rows(i["in_meeting"], updated, AFTER, UNTIL).select("Id", F.col(updated).alias("updated"))
    by_text = window_rows(i["in_meeting"], updated, AFTER, UNTIL, mode="text").select("Id", F.col(updated).alias("updated"))
    return by_instant.withColumn("mode", F.lit("instant")).unionByName(by_text.withColumn("mode", F.lit("text")))


@query("changed_since")
def changed_since_any(i: Inputs) -> DataFrame:
    links = i["in_links"].select("prod_child_id", "prod_grp_prnt_id", F.col("lst_pblsh_dt").alias("link_pblsh_dt"))
    joined = i["in_prod"].select("prod_id", "lst_pblsh_dt").join(links, F.col("prod_id") == F.col("prod_child_id"))
    changed = joined.filter(changed_since([F.col("lst_pblsh_dt"), F.col("link_pblsh_dt")], SINCE))
    return changed.select("prod_id", "prod_grp_prnt_id", "lst_pblsh_dt", "link_pblsh_dt")



@query("route_split")
def route_split(i: Inputs) -> DataFrame:
    everywhere, country = groups.route(i["in_group_source"].select("prod_grp_id", "cntry_cd", "start_dt"))
    return everywhere.withColumn("branch", F.lit("global")).unionByName(country.withColumn("branch", F.lit("country")))


@query("group_class_filter")
def group_class_filter(i: Inputs) -> DataFrame:
    rows = i["in_group_source"].select(
        "prod_grp_id", "cntry_cd", "start_dt", F.col("prod_grp_typ").alias("prod_grp_typ_cd")
    )
    return rows.filter(groups.class_filter(GROUP_TYPES))


@query("cond_min")
def cond_min(i: Inputs) -> DataFrame:
    translated = groups.translated_rows(groups.route(i["in_group_source"])[1], group_tables(i))
    return translated.select(
        "prod_grp_prnt_id",
        "cntry_cd",
        "prod_grp_desc_txt",
        "end_dt",
        F.col("_translation_end").alias("translation_end"),
        dates.clip_to(F.col("end_dt"), F.col("_translation_end")).alias("clipped"),
    )


@query("date_clamp")
def date_clamp(i: Inputs) -> DataFrame:
    return i["in_export_product"].select(
        "prod_id__c", *[dates.clamp_far_future(F.col(c)).alias(c) for c in C.EXPORT_PRODUCT_CLAMPED]
    )


@query("null_marker")
def null_marker(i: Inputs) -> DataFrame:
    return text.null_markers(i["in_export_product"], C.EXPORT_PRODUCT_MARKED).select(
        "prod_id__c", *C.EXPORT_PRODUCT_MARKED
    )


@query("external_id")
def external_id(i: Inputs) -> DataFrame:
    strict = text.strict_id([text.id_text(F.col("prod_grp_prnt_id")), F.col("altrnt_id_type_cd__c"), F.col("cntry_cd")])
    return looked_up_feed(i).select(
        *FEED_KEYS, products.product_external_id().alias("joined_id"), strict.alias("strict_id")
    )


@query("date_reconcile")
def date_reconcile(i: Inputs) -> DataFrame:
    return products.reconcile_dates(looked_up_feed(i)).select(
        *FEED_KEYS, "start_dt", "end_dt", "cease_pblsh_dt"
    )


@query("product_eligibility")
def product_eligibility(i: Inputs) -> DataFrame:
    rows = products.candidates(whole_feed(i, products.MASTER_USED), product_tables(i)).filter(products.eligible(RUN.as_of_date))
    return rows.select("product_external_id", F.col("_replicated_id").alias("replicated_id"), "end_dt", "cease_pblsh_dt")


# Lookups


@query("lookup_left")
def lookup_left(i: Inputs) -> DataFrame:
    return lookup(
        i["in_translations"].select("prod_id", "cntry_cd", "dialect_nm"),
        i["in_alternates"],
        {"prod_id": "prod_id", "cntry_cd": "cntry_cd"},
        {"altrnt_id": "altrnt_id", "altrnt_id_type_cd": "id_type"},
    )


@query("lookup_fallback")
def lookup_fallback(i: Inputs) -> DataFrame:
    rows = i["in_indication"].select("prod_grp_id", "indctn_id", "cntry_cd", "start_dt")
    group = text.id_text(F.col("prod_grp_id"))
    return lookup_with_fallback(
        rows,
        i["in_indication_groups"],
        key="prod_grp_external_id",
        value="sfdc_id",
        first=F.concat(group, F.col("cntry_cd")),
        second=F.concat(group, F.lit(groups.GLOBAL)),
        name="group_sfdc_id",
    )


@query("param_expand")
def param_expand(i: Inputs) -> DataFrame:
    expanded = products.expand_feed(whole_feed(i), i["in_params"])
    return expanded.select(*FEED_KEYS, "dialect_nm", F.col("_wanted_type").alias("id_type"), "recordtype")


@query("group_parent")
def group_parent(i: Inputs) -> DataFrame:
    links, all_groups = i["in_group_links"], i["in_groups"]
    market = group_parents(links, all_groups, products.STAGING, [products.MARKET], with_country=True)
    brand = group_parents(links, all_groups, products.STAGING, [products.BRAND], with_country=False)
    return market.unionByName(brand.withColumn("cntry_cd", F.lit("any")))


# Aggregates and picks


@query("bridge_max")
def bridge_max(i: Inputs) -> DataFrame:
    known = i["in_prod"].select("prod_id")
    return pick.bridge_maxima(i["in_links"], i["in_groups"]).join(known, "prod_id", "left_semi")


@query("max_by_country")
def max_by_country(i: Inputs) -> DataFrame:
    both = [
        pick.max_per_key(i[f"in_{name}"], ["prod_id", "cntry_cd"], ["lst_pblsh_dt"]).withColumn("source", F.lit(name))
        for name in ("alternates", "translations")
    ]
    return both[0].unionByName(both[1])


@query("first_per_key")
def first_per_key(i: Inputs) -> DataFrame:
    return pick.first_per_key(i["in_group_source"], ["prod_grp_id", "cntry_cd"], ["start_dt"])


@query("latest_end")
def latest_end(i: Inputs) -> DataFrame:
    rows = pick.latest_by(i["in_indication"], ["prod_grp_id", "indctn_id", "cntry_cd"], "end_dt")
    return rows.select("prod_grp_id", "indctn_id", "cntry_cd", "end_dt", "start_dt", "indctn_desc")


@query("dedup_rows")
def dedup_rows(i: Inputs) -> DataFrame:
    return i["in_indication"].distinct()


# Feeds and staging


@query("feed_sample_edu")
def feed_sample_edu(i: Inputs) -> DataFrame:
    return products.sample_feed(product_tables(i), SINCE)


@query("feed_market")
def feed_market(i: Inputs) -> DataFrame:
    return products.market_feed(product_tables(i), SINCE, FEED_TYPES)


@query("feed_brand")
def feed_brand(i: Inputs) -> DataFrame:
    return products.brand_feed(product_tables(i), SINCE, FEED_TYPES)


@query("product_union")
def product_union(i: Inputs) -> DataFrame:
    return whole_feed(i).select(*FEED_KEYS, "prod_typ", "end_dt_prod_grp_prod", "cease_pblsh_dt_prod_grp_prod")


@query("product_feed")
def product_feed(i: Inputs) -> DataFrame:
    return products.product_feed(product_tables(i), SINCE, OWN, RUN)


@query("product_feed_touched")
def product_feed_touched(i: Inputs) -> DataFrame:
    t = product_tables(i)
    stored = scratch_path(i.spark, "touched")
    products.touched_products(t, SINCE).write.parquet(stored)
    touched = i.spark.read.schema("prod_id bigint").parquet(stored)
    return products.product_feed(products.restrict(t, touched), SINCE, OWN, RUN)


@query("group_global")
def group_global(i: Inputs) -> DataFrame:
    return groups.global_rows(groups.route(i["in_group_source"])[0], i["in_source_translations"])


@query("group_country")
def group_country(i: Inputs) -> DataFrame:
    translated = groups.translated_rows(groups.route(i["in_group_source"])[1], group_tables(i))
    return groups.country_rows(translated)


@query("group_global_synth")
def group_global_synth(i: Inputs) -> DataFrame:
    translated = groups.translated_rows(groups.route(i["in_group_source"])[1], group_tables(i))
    return groups.synthesised_rows(translated)


@query("group_feed")
def group_feed(i: Inputs) -> DataFrame:
    staged = groups.group_feed(group_tables(i), GROUP_TYPES, RUN)
    parent = "glbl_parent_product_group__c"
    return staged.withColumn(parent, F.col(parent).cast("string"))


@query("indication_global")
def indication_global(i: Inputs) -> DataFrame:
    return indications.global_rows(indication_tables(i), OWN).select(*C.STAGED_INDICATION)


@query("indication_feed")
def indication_feed(i: Inputs) -> DataFrame:
    return indications.indication_feed(indication_tables(i), OWN, RUN)


# Spend


def staged_spend(i: Inputs) -> DataFrame:
    meetings, participants = i["in_meeting"], i["in_participant"]
    return spend.spend_join(
        spend.event_stage(meetings, RULES, RUN),
        spend.attendee_stage(participants, meetings, i["in_account"], RULES, RUN),
        spend.day_value_stage(i["in_day_value"], participants, meetings, RULES, RUN),
    )


@query("spend_event_stage")
def spend_event_stage(i: Inputs) -> DataFrame:
    return spend.event_stage(i["in_meeting"], RULES, RUN)


@query("spend_attendee_stage")
def spend_attendee_stage(i: Inputs) -> DataFrame:
    return spend.attendee_stage(i["in_participant"], i["in_meeting"], i["in_account"], RULES, RUN)


@query("spend_value_stage")
def spend_value_stage(i: Inputs) -> DataFrame:
    return spend.day_value_stage(i["in_day_value"], i["in_participant"], i["in_meeting"], RULES, RUN)


@query("spend_join")
def spend_join(i: Inputs) -> DataFrame:
    return staged_spend(i)


@query("value_lines")
def value_lines(i: Inputs) -> DataFrame:
    return spend.value_lines(staged_spend(i))


@query("spend_export")
def spend_export(i: Inputs) -> DataFrame:
    return spend.spend_export(staged_spend(i), IDENTITY)


# Exports


@query("export_product")
def export_product(i: Inputs) -> DataFrame:
    return exports.export_product(i["in_export_product"])


@query("export_group")
def export_group(i: Inputs) -> DataFrame:
    return exports.export_group(i["in_export_group"])


@query("export_indication")
def export_indication(i: Inputs) -> DataFrame:
    return exports.export_indication(i["in_export_indication"])


# History, incremental runs and streams


@query("history_close")
def history_close(i: Inputs) -> DataFrame:
    return H.close_history(history_rows(i), i["in_stage"], "k", RUN, stamp_exec=True)


@query("history_apply")
def history_apply(i: Inputs) -> DataFrame:
    return H.apply_history(history_rows(i), i["in_stage"], "k", RUN)


@query("history_rollback")
def history_rollback(i: Inputs) -> DataFrame:
    applied = H.apply_history(history_rows(i), i["in_stage"], "k", RUN)
    return H.rollback_history(applied, RUN.exec_id)


def _two_runs(i: Inputs, base: str) -> IncrementalJob:
    updated = "Participant_ToV_Updated_Date_MERC__c"

    def extract(after: str, until: str) -> DataFrame:
        return window_rows(i["in_meeting"], updated, after, until, mode="text").select(
            F.col("Owner_Master_Id_MERC__c").alias("owner_id"), F.col("Id").alias("meeting_id")
        )

    schema = T.StructType([T.StructField("owner_id", T.StringType()), T.StructField("meeting_id", T.StringType()), *AUDIT_FIELDS])
    job = IncrementalJob(
        extract=extract,
        bookmark=Bookmark(i.spark, f"{base}/bookmark"),
        first_bound=AFTER,
        stage=Folder(f"{base}/stage"),
        stage_table="meetings",
        history=HistoryTable(i.spark, f"{base}/history/meetings", schema, "owner_id", stamp_exec=True),
    )
    job.run(i.spark, BETWEEN, RUN)
    job.run(i.spark, UNTIL, NEXT_RUN)
    return job


@query("incremental_run")
def incremental_run(i: Inputs) -> DataFrame:
    return _two_runs(i, scratch_path(i.spark, "incremental")).history.read()


@query("job_rollback")
def job_rollback(i: Inputs) -> DataFrame:
    base = scratch_path(i.spark, "incremental")
    job = _two_runs(i, base)
    places = jobs.Places(Folder(base), Folder(f"{base}/stage"), base)
    jobs.roll_back(i.spark, places, "meetings", "owner_id", NEXT_RUN.exec_id)
    return job.history.read()


@query("job_repeated_after_rollback")
def job_repeated_after_rollback(i: Inputs) -> DataFrame:
    base = scratch_path(i.spark, "incremental")
    job = _two_runs(i, base)
    places = jobs.Places(Folder(base), Folder(f"{base}/stage"), base)
    jobs.roll_back(i.spark, places, "meetings", "owner_id", NEXT_RUN.exec_id)
    job.run(i.spark, UNTIL, NEXT_RUN)
    return job.history.read()


@query("stream_landing")
def stream_landing(i: Inputs) -> DataFrame:
    base = scratch_path(i.spark, "stream")
    columns = ["event_id", "user_id", "event_type", "value"]
    day = F.col("ts").cast("date")
    middle = F.lit("2024-01-15").cast("date")
    for part, wanted in (("first", day <= middle), ("second", day.isNull() | (day > middle))):
        landed = all_text(i.given("events").filter(wanted).select(columns))
        landed.write.json(f"{base}/landing/{part}")
        rows = landing_stream(i.spark, f"{base}/landing", columns)
        ingest_landing(rows, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return i.spark.read.parquet(f"{base}/table").select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("user_id").cast("bigint").alias("user_id"),
        "event_type",
        F.col("value").cast("double").alias("value"),
    )


@query("stream_rejects")
def stream_rejects(i: Inputs) -> DataFrame:
    base = scratch_path(i.spark, "stream")
    for part, lines in enumerate(i["in_landed_line"].randomSplit([0.5, 0.5], 1)):
        lines.write.text(f"{base}/landing/{part}")
        taken = landed_lines(i.spark, f"{base}/landing")
        ingest_with_rejects(taken, ["event_id", "event_type"], f"{base}/rows", f"{base}/rejects", f"{base}/checkpoint").awaitTermination()
    return i.spark.read.parquet(f"{base}/rejects").groupBy("line").agg(F.count("*").alias("n"))


@query("stream_history")
def stream_history_batches(i: Inputs) -> DataFrame:
    base = scratch_path(i.spark, "stream")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("payload", T.StringType()), *AUDIT_FIELDS])
    table = HistoryTable(i.spark, f"{base}/history", schema, "k")
    orders = i.given("orders").select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("payload"))
    table.publish(orders, RUN, token="start")
    suppliers = i.given("supplier").select((F.col("s_suppkey") * 3).alias("k"), F.col("s_name").alias("payload"))
    steps = (i["in_stage"], suppliers)
    for number, step in enumerate(steps):
        all_text(step).write.json(f"{base}/landing/{number}")
        rows = landing_stream(i.spark, f"{base}/landing", ["k", "payload"])
        typed = rows.select(F.col("k").cast("bigint").alias("k"), "payload")
        stream_history(typed, table, NEXT_RUN, f"{base}/checkpoint").awaitTermination()
    return table.read()

