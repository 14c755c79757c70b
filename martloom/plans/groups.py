"""Product-group staging.

Tables: ``source``, ``translations``, ``dialects`` (country_code, dialect), ``parents``
(prod_grp_id_child, prod_grp_id_prnt).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.context import RunContext, audit_stamp
from martloom.functions import dates, text
from martloom.operators.lookup import lookup
from martloom.operators.pick import max_with_first
from martloom.operators.schema import renamed
from martloom.plans.columns import GROUP_ROW, STAGED_GROUP

Tables = Mapping[str, DataFrame]

# Fixed values of the data contract.
GLOBAL = "ZZ"
DEFAULT_COUNTRY, DEFAULT_DIALECT = "US", "EN"

# "First" rows are the first by these columns, nulls first, then by all others.
COUNTRY_ORDER = ("cntry_cd", "dialect_nm", "start_dt")
UNIQUE_ORDER = ("dialect_nm", "start_dt")


@dataclass(frozen=True)
class GroupTypes:
    """Type codes that decide which groups are staged; competitors are staged per country only."""

    competitor: str
    everywhere: Sequence[str]


def route(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Global rows and country rows. A row without country is neither."""
    return df.filter(F.col("cntry_cd") == GLOBAL), df.filter(F.col("cntry_cd") != GLOBAL)


def class_filter(types: GroupTypes) -> Column:
    """Own kinds everywhere; competitors and untyped groups per country only."""
    kind, country = F.col("prod_grp_typ_cd"), F.col("cntry_cd") != GLOBAL
    plain = text.unquoted(kind)
    return plain.isin(list(types.everywhere)) | ((plain == types.competitor) & country) | (kind.isNull() & country)


def _group_rows(df: DataFrame) -> DataFrame:
    return renamed(df, {"prod_grp_id": "prod_grp_prnt_id", "prod_grp_typ": "prod_grp_typ_cd"})


def global_rows(source: DataFrame, translations: DataFrame) -> DataFrame:
    """Groups the source itself marks as global, named by the default translation."""
    marked = _group_rows(source).withColumns(
        {"_country": F.lit(DEFAULT_COUNTRY), "dialect_nm": F.lit(DEFAULT_DIALECT)}
    )
    return lookup(
        marked,
        translations,
        {"prod_grp_prnt_id": "prod_grp_id", "_country": "cntry_cd", "dialect_nm": "dialect_nm"},
        {"trnsltd_grp_nm": "trnsltd_grp_nm"},
    ).select(GROUP_ROW)


def translated_rows(source: DataFrame, t: Tables) -> DataFrame:
    """Country rows with the dialect of the country and the group's translation into it."""
    df = lookup(_group_rows(source), t["dialects"], {"cntry_cd": "country_code"}, {"dialect": "_dialect"})
    translations = t["translations"].withColumn("_found_dialect", F.col("dialect_nm"))
    df = lookup(
        df,
        translations,
        {"prod_grp_prnt_id": "prod_grp_id", "cntry_cd": "cntry_cd", "_dialect": "dialect_nm"},
        {"_found_dialect": "_found_dialect", "end_dt": "_translation_end", "trnsltd_grp_nm": "trnsltd_grp_nm"},
    )
    return df.withColumn("dialect_nm", F.coalesce("_found_dialect", F.lit(DEFAULT_DIALECT))).drop("_found_dialect")


def country_rows(translated: DataFrame) -> DataFrame:
    """Rows in the country's own dialect, ending no later than their translation."""
    clipped = dates.clip_to(F.col("end_dt"), F.col("_translation_end"))
    matching = translated.filter(F.col("dialect_nm") == F.col("_dialect"))
    return matching.withColumn("end_dt", clipped).select(GROUP_ROW)


def synthesised_rows(translated: DataFrame) -> DataFrame:
    """One global row per group and type, made from its country rows and their unclipped end dates."""
    made = max_with_first(
        translated.select(GROUP_ROW), ["prod_grp_prnt_id", "prod_grp_typ_cd"], "end_dt", COUNTRY_ORDER
    )
    return made.withColumns({"cntry_cd": F.lit(GLOBAL), "dialect_nm": F.lit(DEFAULT_DIALECT)})


def group_rows(t: Tables, types: GroupTypes) -> DataFrame:
    """Global, synthesised and country rows that pass the class filter, one per group and country."""
    from_global, from_country = route(t["source"])
    translated = translated_rows(from_country, t)
    union = (
        global_rows(from_global, t["translations"])
        .unionByName(synthesised_rows(translated))
        .unionByName(country_rows(translated))
    )
    return max_with_first(union.filter(class_filter(types)), ["prod_grp_prnt_id", "cntry_cd"], "end_dt", UNIQUE_ORDER)


def group_feed(t: Tables, types: GroupTypes, run: RunContext) -> DataFrame:
    """Product-group staging; a group with several parents has a row per parent."""
    df = group_rows(t, types)
    df = df.withColumn("prod_external_id", text.strict_id([text.id_text(F.col("prod_grp_prnt_id")), F.col("cntry_cd")]))
    parents = t["parents"].select("prod_grp_id_child", "prod_grp_id_prnt").distinct()
    df = lookup(df, parents, {"prod_grp_prnt_id": "prod_grp_id_child"}, {"prod_grp_id_prnt": "prod_grp_id_prnt"})
    df = df.withColumn("prod_grp_prnt_id", F.col("prod_grp_prnt_id").cast("bigint"))
    return audit_stamp(renamed(df, STAGED_GROUP), run)
