"""Keyed lookups.

No join here carries a broadcast hint. Spark broadcasts a side only below
``spark.sql.autoBroadcastJoinThreshold``, first by its estimate and again at run time by the size
it measured, and takes a shuffle join with hot partitions split beyond it.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(
    df: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    how: str = "left",
) -> DataFrame:
    """Add ``take`` (right column -> new name) to ``df`` where the ``on`` columns (left -> right) agree.

    Several matches give several rows. Key columns of the right side do not appear in the result.
    """
    keys = [f"_lookup_key_{i}" for i in range(len(on))]
    pruned = right.select(
        *[F.col(r).alias(k) for k, r in zip(keys, on.values(), strict=True)],
        *[F.col(r).alias(new) for r, new in take.items()],
    )
    match = reduce(and_, [df[left] == pruned[k] for left, k in zip(on, keys, strict=True)])
    return df.join(pruned, match, how).drop(*keys)


def lookup_with_fallback(
    df: DataFrame,
    right: DataFrame,
    key: str,
    value: str,
    first: Column,
    second: Column,
    name: str,
) -> DataFrame:
    """``value`` found under the ``first`` key, else under the ``second``, as column ``name``."""
    keyed = df.withColumns({"_first_key": first, "_second_key": second})
    found = lookup(keyed, right, {"_first_key": key}, {value: "_first_value"})
    found = lookup(found, right, {"_second_key": key}, {value: "_second_value"})
    return found.withColumn(name, F.coalesce("_first_value", "_second_value")).drop(
        "_first_key", "_second_key", "_first_value", "_second_value"
    )


def expand_with_parameters(df: DataFrame, params: DataFrame, on: Mapping[str, str], take: Mapping[str, str]) -> DataFrame:
    """Keep the rows that have parameters and add them; several parameter rows multiply the row."""
    return lookup(df, params, on, take, how="inner")


def group_parents(
    links: DataFrame,
    groups: DataFrame,
    child_purpose: str,
    parent_purposes: list[str],
    with_country: bool,
) -> DataFrame:
    """Distinct parent links of one purpose, with the purpose of the parent (and the link's country)."""
    children = groups.filter(F.col("grp_prps_cd") == child_purpose)
    parents = groups.filter(F.col("grp_prps_cd").isin(parent_purposes))
    linked = lookup(links, children, {"prod_grp_id_child": "prod_grp_id"}, {}, how="inner")
    linked = lookup(linked, parents, {"prod_grp_id_prnt": "prod_grp_id"}, {"grp_prps_cd": "grp_prps_cd"}, how="inner")
    columns = ["prod_grp_id_child", "prod_grp_id_prnt", "grp_prps_cd"] + (["cntry_cd"] if with_country else [])
    return linked.select(columns).distinct()
