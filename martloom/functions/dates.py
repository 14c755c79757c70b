"""Validity dates: open ends, reconciliation and the export clamp."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data contract.
OPEN_END = "9999-12-31"
CLAMP_FROM = "3999-01-01"
CLAMP_TO = "4000-12-31"


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def open_end(value: Column) -> Column:
    """A missing date means "never ends"."""
    return F.coalesce(value, day(OPEN_END))


def close_sentinel(value: Column) -> Column:
    """The inverse of :func:`open_end`."""
    return F.nullif(value, day(OPEN_END))


def latest(values: Sequence[Column]) -> Column:
    """Latest of several dates; missing ones do not count."""
    return F.greatest(*values)


def earliest_by_purpose(is_first: Column, first: Sequence[Column], other: Sequence[Column]) -> Column:
    """Earliest of one of two operand sets, chosen per row; missing dates do not count."""
    return F.when(is_first, F.least(*first)).otherwise(F.least(*other))


def clip_to(value: Column, limit: Column) -> Column:
    """``limit`` where it is before ``value``, else ``value``.

    Unlike ``least``, a missing ``value`` stays missing even when ``limit`` is known.
    """
    return F.when(limit < value, limit).otherwise(value)


def clamp_far_future(value: Column) -> Column:
    """Pull dates the receiving system cannot hold back to its own far-future date."""
    return F.when(value >= day(CLAMP_FROM), day(CLAMP_TO)).otherwise(value)


def iso_day(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def iso_instant(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def compact_midnight(value: Column) -> Column:
    """``ddMMyyyy`` followed by a zero time of day."""
    return F.concat(F.date_format(value, "ddMMyyyy"), F.lit("000000"))


def landed_day(text: Column) -> Column:
    """The calendar day of landed ISO text, whatever follows it; null when there is none."""
    return F.substring(text, 1, 10).try_cast("date")
