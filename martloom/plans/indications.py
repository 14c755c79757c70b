"""Indication staging.

Tables: ``source``, ``dialects`` (country_code, dialect), ``translations``, ``replicated_groups``
(sfdc_id, prod_grp_external_id).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.context import RunContext, audit_stamp
from martloom.functions import text
from martloom.operators.lookup import lookup, lookup_with_fallback
from martloom.operators.pick import latest_by, max_per_key
from martloom.operators.schema import project
from martloom.plans.columns import INDICATION_SOURCE, STAGED_INDICATION
from martloom.plans.groups import DEFAULT_DIALECT, GLOBAL

Tables = Mapping[str, DataFrame]

TRANSLATED = ["trnsltd_indctn_desc_txt", "trnsltd_indctn_short_desc"]
GLOBAL_MAXIMA = [
    c for c in INDICATION_SOURCE if c not in ("prod_grp_id", "indctn_id", "cntry_cd", "prod_grp_typ")
] + TRANSLATED


def _group_key(country: Column) -> Column:
    return text.strict_id([text.id_text(F.col("prod_grp_id")), country])


def _external_id(country: Column) -> Column:
    return text.strict_id([text.id_text(F.col("prod_grp_id")), F.col("indctn_id"), country])


def translated_rows(source: DataFrame, t: Tables) -> DataFrame:
    """Rows whose country has a dialect and whose indication is translated into it."""
    df = lookup(source, t["dialects"], {"cntry_cd": "country_code"}, {"dialect": "dialect_nm"}, how="inner")
    df = lookup(
        df,
        t["translations"].filter(F.col("trnsltd_indctn_desc_txt").isNotNull()),
        {"indctn_id": "indctn_id", "dialect_nm": "dialect_nm"},
        {c: c for c in TRANSLATED},
        how="inner",
    )
    return df


def country_rows(t: Tables) -> DataFrame:
    """The translated rows with the latest end date, with the id of the country's group or the global one.

    Whether a row is translated depends on its indication and country alone, which are part of the
    key of the latest end date. So the latest rows are taken first and fewer rows are looked up.
    """
    latest = latest_by(t["source"], ["prod_grp_id", "indctn_id", "cntry_cd"], "end_dt")
    df = translated_rows(latest, t).withColumn("indctn_ext_id_glbl__c", _external_id(F.col("cntry_cd")))
    return lookup_with_fallback(
        df,
        t["replicated_groups"],
        key="prod_grp_external_id",
        value="sfdc_id",
        first=_group_key(F.col("cntry_cd")),
        second=_group_key(F.lit(GLOBAL)),
        name="prod_grp_prnt_id_glbl_sfdc_id",
    )


def global_rows(t: Tables, own_type: str) -> DataFrame:
    """One row per indication and own group: the maximum of every column over all countries."""
    own = t["source"].filter(text.unquoted(F.col("prod_grp_typ")) == own_type)
    made = max_per_key(translated_rows(own, t), ["indctn_id", "prod_grp_id"], GLOBAL_MAXIMA)
    made = made.withColumns(
        {
            "cntry_cd": F.lit(GLOBAL),
            "dialect_nm": F.lit(DEFAULT_DIALECT),
            "indctn_ext_id_glbl__c": _external_id(F.lit(GLOBAL)),
            "_global_key": _group_key(F.lit(GLOBAL)),
        }
    )
    return lookup(
        made,
        t["replicated_groups"],
        {"_global_key": "prod_grp_external_id"},
        {"sfdc_id": "prod_grp_prnt_id_glbl_sfdc_id"},
    )


def indication_feed(t: Tables, own_type: str, run: RunContext) -> DataFrame:
    """Indication staging: country rows and global rows without duplicates."""
    rows = project(country_rows(t), STAGED_INDICATION).unionByName(project(global_rows(t, own_type), STAGED_INDICATION))
    staged = rows.distinct().withColumns(
        {
            "prod_grp_prnt_id_glbl__c": F.col("prod_grp_prnt_id_glbl__c").cast("bigint"),
            "sfdc_id": F.lit(None).cast("string"),
        }
    )
    return audit_stamp(staged, run)
