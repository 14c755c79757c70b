"""Extraction windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def changed_since(dates: Sequence[Column], since: str) -> Column:
    """True when any of the dates is after ``since``; there is no upper bound."""
    latest = F.greatest(*dates) if len(dates) > 1 else dates[0]
    return latest > F.lit(since).cast("date")


def in_window(value: Column, after: str, until: str, mode: str = "instant") -> Column:
    """``after < value <= until``.

    ``instant`` compares points in time whatever their spelling; ``text`` compares the characters,
    which a file scan can evaluate by itself.
    """
    if mode == "text":
        return (value > F.lit(after)) & (value <= F.lit(until))
    if mode != "instant":
        raise ValueError(f"unknown window mode {mode!r}")
    moment = value.try_cast("timestamp")
    return (moment > F.lit(after).cast("timestamp")) & (moment <= F.lit(until).cast("timestamp"))


def window_rows(df: DataFrame, column: str, after: str, until: str, mode: str = "instant") -> DataFrame:
    return df.filter(in_window(F.col(column), after, until, mode))
