"""The batch jobs: tables in, stage table, history and bookmark out.

Each job reads its inputs, builds one plan and hands it to the incremental runner. Table names are
defaults and can be replaced one by one through ``names``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.context import RunContext
from martloom.operators.schema import renamed
from martloom.plans import columns as C
from martloom.plans import exports, groups, indications, products, spend
from martloom.plans.runner import IncrementalJob
from martloom.session import scratch_path, tune
from martloom.sources.landing import read_landing
from martloom.sources.sinks import export_delimited
from martloom.sources.state import Bookmark, HistoryTable
from martloom.sources.tables import Database, Folder, read_table, read_tables

# Upstream tables by the names the plans use.
PRODUCT_TABLES = {
    "prod": "mtm_gh_prod_vw",
    "links": "mtm_gh_prod_grp_to_prod_vw",
    "groups": "mtm_gh_prod_grp_vw",
    "group_links": "mtm_gh_pg_to_pg_vw",
    "translations": "mtm_gh_prod_trnsltns_vw",
    "alternates": "mtm_gh_prod_altrnt_id_vw",
    "group_translations": "mtm_gh_prod_grp_trnsltns_vw",
    "params": "product_param",
    "replicated_groups": "replicated_group_ids",
    "replicated_products": "replicated_product_ids",
}
GROUP_TABLES = {
    "translations": "mtm_gh_prod_grp_trnsltns_vw",
    "dialects": "country_dialect",
    "parents": "mtm_gh_pg_to_pg_vw",
}
INDICATION_TABLES = {
    "translations": "mtm_gh_indctn_trnsltns_vw",
    "dialects": "country_dialect",
    "replicated_groups": "replicated_group_ids",
}

# Columns of the parameter and write-back tables, as the plans call them.
PLAN_NAMES = {
    "params": {"grp_prps_cd_glbl__c": "grp_prps_cd", "altrnt_id_type_cd__c": "altrnt_id_type_cd"},
    "replicated_groups": {
        "prod_grp_id_glbl__c": "prod_grp_id",
        "cntry_cd_glbl__c": "cntry_cd",
        "prod_grp_external_id_glbl__c": "prod_grp_external_id",
    },
    "replicated_products": {
        "prod_id_glbl__c": "prod_id",
        "cntry_cd_glbl__c": "cntry_cd",
        "product_external_id__c": "product_external_id",
    },
}

# Ids that come back as text or floating-point numbers; what is no number matches nothing.
WHOLE_NUMBERS = {"replicated_groups": "prod_grp_id", "replicated_products": "prod_id"}

Names = Mapping[str, str]
LoadSince = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Places:
    """Where a job reads tables, writes its stage table and keeps bookmarks and history."""

    source: Folder | Database
    stage: Folder | Database
    state: str


def load_bundle(spark: SparkSession, source: Folder | Database, tables: Names, names: Names | None) -> dict[str, DataFrame]:
    """The tables of a job under the table and column names the plans use."""
    loaded = read_tables(tune(spark), source, {**tables, **(names or {})})
    bundle = {name: renamed(df, PLAN_NAMES.get(name, {})) for name, df in loaded.items()}
    for name in WHOLE_NUMBERS.keys() & bundle.keys():
        column = WHOLE_NUMBERS[name]
        if column in bundle[name].columns:
            whole = F.col(column).try_cast("double").try_cast("bigint")
            bundle[name] = bundle[name].withColumn(column, whole)
    return bundle


def _run(
    spark: SparkSession,
    places: Places,
    table: str,
    key: str,
    extract: Callable[[str, str], DataFrame],
    first_bound: str,
    until: str,
    run: RunContext,
    stamp_exec: bool,
) -> tuple[str, str]:
    """Run one staging job; the history has the columns of the stage."""
    schema = extract(first_bound, until).schema
    history = HistoryTable(spark, f"{places.state}/history/{table}", schema, key, stamp_exec)
    job = IncrementalJob(extract, _bookmark(spark, places, table), first_bound, places.stage, table, history)
    return job.run(spark, until, run)


def _bookmark(spark: SparkSession, places: Places, table: str) -> Bookmark:
    return Bookmark(spark, f"{places.state}/bookmark/{table}")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the scratch folder: read twice, or joined by its real size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def roll_back(spark: SparkSession, places: Places, table: str, key: str, exec_id: int) -> int:
    """Take the rows one run created out of a stage's history, and give its new version.

    Rows the run had closed stay closed, and the bookmark stays: the same run can be repeated over its own window, which
    publishes it again.
    """
    schema = read_table(tune(spark), places.stage, table).schema
    return HistoryTable(spark, f"{places.state}/history/{table}", schema, key).rollback(exec_id)


def _moment(run: RunContext) -> str:
    return run.run_ts.strftime("%Y-%m-%d %H:%M:%S")


def _instant(run: RunContext) -> str:
    return run.run_ts.strftime("%Y-%m-%dT%H:%M:%S.000Z")


def stage_products(
    spark: SparkSession,
    places: Places,
    own_type: str,
    first_bound: str,
    run: RunContext,
    table: str = "product_stage",
    names: Names | None = None,
) -> tuple[str, str]:
    """After the first load, the tables are first reduced to the products something was published for.

    The ids of these products are stored, so their number is known and the reduction needs no shuffle
    of the tables unless there are too many ids to broadcast.
    """
    tables = load_bundle(spark, places.source, PRODUCT_TABLES, names)

    def extract(after: str, until: str) -> DataFrame:
        if after == first_bound:
            return products.product_feed(tables, after, own_type, run)
        touched = _stored(products.touched_products(tables, after), "touched")
        return products.product_feed(products.restrict(tables, touched), after, own_type, run)

    return _run(spark, places, table, "product_external_id__c", extract, first_bound, _moment(run), run, False)


def stage_groups(
    spark: SparkSession,
    places: Places,
    load_source: LoadSince,
    types: groups.GroupTypes,
    first_bound: str,
    run: RunContext,
    table: str = "product_group_stage",
    names: Names | None = None,
) -> tuple[str, str]:
    """``load_source`` gives the group rows changed since a bound."""
    tables = load_bundle(spark, places.source, GROUP_TABLES, names)

    def extract(after: str, until: str) -> DataFrame:
        return groups.group_feed({**tables, "source": load_source(after)}, types, run)

    return _run(spark, places, table, "prod_grp_external_id_glbl__c", extract, first_bound, _moment(run), run, False)


def stage_indications(
    spark: SparkSession,
    places: Places,
    load_source: LoadSince,
    own_type: str,
    first_bound: str,
    run: RunContext,
    table: str = "indication_stage",
    names: Names | None = None,
) -> tuple[str, str]:
    """``load_source`` gives the indication rows changed since a bound."""
    tables = load_bundle(spark, places.source, INDICATION_TABLES, names)

    def extract(after: str, until: str) -> DataFrame:
        return indications.indication_feed({**tables, "source": load_source(after)}, own_type, run)

    return _run(spark, places, table, "indctn_ext_id_glbl__c", extract, first_bound, _moment(run), run, False)


@dataclass(frozen=True)
class Landing:
    """Folders of the landed objects."""

    meetings: str
    participants: str
    accounts: str
    day_values: str

    def read(self, spark: SparkSession, name: str, columns: Sequence[str]) -> DataFrame:
        return read_landing(spark, getattr(self, name), columns)


SPEND_STAGES = {"events": "spend_event_stage", "attendees": "spend_attendee_stage", "day_values": "spend_day_value_stage"}


def stage_spend(
    spark: SparkSession, places: Places, landing: Landing, rules: spend.SpendRules, run: RunContext
) -> dict[str, tuple[str, str]]:
    """The three spend stages. Each has its own bookmark; ``rules.after`` is the bound of a first run.

    Landed text is parsed once: the meetings of the earliest open window and the attendees of those
    meetings are stored and shared by the stages, which apply their own windows again.
    """
    tune(spark)
    until = _instant(run)

    def within(after: str, until: str) -> spend.SpendRules:
        return replace(rules, after=after, until=until)

    bounds = [_bookmark(spark, places, table).window(rules.after, until, run.exec_id)[0] for table in SPEND_STAGES.values()]
    earliest = min(bounds)
    window = within(earliest, until)
    landed = landing.read(spark, "meetings", C.LANDED_MEETING)
    meetings = _stored(landed.filter(window.updated() & window.is_final()), "meetings")
    ids = meetings.select(F.col("Id").alias("_meeting"))
    attending = landing.read(spark, "participants", C.LANDED_PARTICIPANT).filter(rules.attending())
    participants = _stored(attending.join(ids, F.col("Meeting_MERC__c") == F.col("_meeting"), "left_semi"), "participants")
    accounts = landing.read(spark, "accounts", C.LANDED_ACCOUNT)
    day_values = landing.read(spark, "day_values", C.LANDED_DAY_VALUE)
    stages = {
        "events": ("event_id_merc__c", lambda a, u: spend.event_stage(meetings, within(a, u), run)),
        "attendees": (
            "meeting_participant_id_merc__c",
            lambda a, u: spend.attendee_stage(participants, meetings, accounts, within(a, u), run),
        ),
        "day_values": ("id", lambda a, u: spend.day_value_stage(day_values, participants, meetings, within(a, u), run)),
    }
    return {
        name: _run(spark, places, SPEND_STAGES[name], key, extract, rules.after, until, run, True)
        for name, (key, extract) in stages.items()
    }


def export_spend(spark: SparkSession, stage: Folder | Database, identity: spend.SpendIdentity, targets: Sequence[str]) -> None:
    """The spend file as tab-separated text, in every target folder."""
    staged = read_tables(tune(spark), stage, SPEND_STAGES)
    joined = spend.spend_join(staged["events"], staged["attendees"], staged["day_values"])
    export_delimited(spend.spend_export(joined, identity), targets, sep="\t")


FORMATTERS = {
    "product": exports.export_product,
    "group": exports.export_group,
    "indication": exports.export_indication,
}


def export_stage(spark: SparkSession, stage: Folder | Database, table: str, kind: str, target: str) -> None:
    """A staged table as comma-separated text for the receiving system."""
    export_delimited(FORMATTERS[kind](read_table(tune(spark), stage, table)), [target])
