"""One row per key, newest rows per key, maxima per key.

Everything is an aggregate with a map-side combine: a key that holds a large part of the input is
reduced to one row per map task before the shuffle. None of it uses a window over the whole key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import open_end


def _first_row(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], skip: Sequence[str] = ()):
    """The smallest row by ``order_by``, then by every other column: a total order, nulls first."""
    left_out = {c.lower() for c in [*keys, *order_by, *skip]}
    rest = [c for c in df.columns if c.lower() not in left_out]
    return F.min(F.struct(*order_by, *rest)).alias("_row"), [*order_by, *rest]


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One whole row per key, the same one on every run."""
    row, columns = _first_row(df, keys, order_by)
    picked = df.groupBy(*keys).agg(row)
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in columns]).select(df.columns)


def max_with_first(df: DataFrame, keys: Sequence[str], max_column: str, order_by: Sequence[str]) -> DataFrame:
    """Per key: the largest ``max_column``, and every other column from the first row."""
    row, columns = _first_row(df, keys, order_by, skip=[max_column])
    picked = df.groupBy(*keys).agg(F.max(max_column).alias(max_column), row)
    return picked.select(*keys, max_column, *[F.col("_row")[c].alias(c) for c in columns]).select(df.columns)


def max_per_key(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in columns])


def bridge_maxima(links: DataFrame, groups: DataFrame) -> DataFrame:
    """Per product, group and end date: latest publication, and latest cease date where open wins.

    The links are reduced before the purpose is looked up, and each group and purpose is looked up
    once, so the join runs over the reduced rows and needs no second aggregate.
    """
    reduced = links.groupBy("prod_child_id", "prod_grp_prnt_id", "end_dt").agg(
        F.max(open_end(F.col("cease_pblsh_dt"))).alias("cease_pblsh_dt"),
        F.max("lst_pblsh_dt").alias("lst_pblsh_dt"),
    )
    purposes = groups.select("prod_grp_id", "grp_prps_cd").distinct()
    return reduced.join(purposes, reduced["prod_grp_prnt_id"] == purposes["prod_grp_id"]).select(
        F.col("prod_child_id").alias("prod_id"),
        "prod_grp_id",
        "grp_prps_cd",
        "end_dt",
        "cease_pblsh_dt",
        "lst_pblsh_dt",
    )


def latest_by(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Rows that carry the largest ``column`` of their key. Ties stay, all-null keys go.

    The maxima come from a reduced aggregate and select rows through a semi join on key *and*
    value, so a hot key is spread over its values and split further when it is still too large.
    """
    names = [f"_latest_key_{i}" for i in range(len(keys))]
    maxima = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).agg(
        F.max(column).alias("_latest")
    )
    same = [df[k].eqNullSafe(maxima[n]) for k, n in zip(keys, names, strict=True)]
    return df.join(maxima, reduce(and_, same) & (df[column] == maxima["_latest"]), "left_semi")
