"""Outbound formatting of the staged tables. Each formatter is one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions import dates, text
from martloom.plans import columns as C
from martloom.plans.groups import GLOBAL


def _day_text(column: str, clamped: list[str]) -> Column:
    value = F.col(column).cast("date")
    return dates.iso_day(dates.clamp_far_future(value) if column in clamped else value)


def export_product(staged: DataFrame) -> DataFrame:
    """Dates as text (clamped first), null markers, exported names, and the name column last."""

    def shaped(column: str) -> Column:
        key = column.lower()
        value = _day_text(key, C.EXPORT_PRODUCT_CLAMPED) if key in C.EXPORT_PRODUCT_DATES else F.col(column)
        value = text.marked(value) if key in C.EXPORT_PRODUCT_MARKED else value
        return value.alias(C.EXPORT_PRODUCT_NAMES.get(key, column))

    name = text.short_name(F.col("trnsltd_dsply_nm__c")).alias("Name")
    return staged.select(*[shaped(c) for c in staged.columns], name)


def export_group(staged: DataFrame) -> DataFrame:
    """As the product export, with instants, and the translated name for country rows that have one."""

    def shaped(column: str) -> Column:
        key = column.lower()
        value = F.col(column)
        if key in C.EXPORT_GROUP_INSTANTS:
            value = dates.iso_instant(value)
        elif key in C.EXPORT_GROUP_CLAMPED:
            value = _day_text(key, C.EXPORT_GROUP_CLAMPED)
        exported = C.EXPORT_GROUP_NAMES.get(key, column)
        return (text.marked(value) if exported in C.EXPORT_GROUP_MARKED else value).alias(exported)

    base, translated = F.col("name"), F.col("trnsltd_grp_nm_glbl__c")
    untranslated = (F.col("cntry_cd_glbl__c") == GLOBAL) | translated.isNull()
    name = text.short_name(F.when(untranslated, base).otherwise(translated)).alias("Name")
    return staged.select(*[shaped(c) for c in staged.columns], base.alias("Name1"), name)


def export_indication(staged: DataFrame) -> DataFrame:
    """21 text columns; the description is exported a second time as the short name."""

    def shaped(exported: str, column: str) -> Column:
        value = F.col(column)
        if exported in C.EXPORT_INDICATION_DATES:
            value = value.cast("date")
        if exported in C.EXPORT_INDICATION_CLAMPED:
            value = dates.clamp_far_future(value)
        value = value.cast("string")
        if exported in C.EXPORT_INDICATION_MARKED:
            value = text.marked(value)
        return (text.short_name(value) if exported == "Name" else value).alias(exported)

    return staged.select([shaped(e, c) for e, c in C.EXPORT_INDICATION_NAMES.items()])
