"""Identifiers, markers and text clean-up."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_MARKER = "#N/A"  # fixed value of the export contract
NAME_LENGTH = 80  # fixed value of the export contract


def id_text(value: Column) -> Column:
    """A numeric id as plain digits."""
    return value.cast("bigint").cast("string")


def joined_id(parts: Sequence[Column]) -> Column:
    """Concatenation that leaves missing parts out."""
    return F.concat_ws("", *parts)


def strict_id(parts: Sequence[Column]) -> Column:
    """Concatenation that is missing when any part is."""
    return F.concat(*parts)


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def marked(value: Column) -> Column:
    """Text with missing and empty values replaced by the export marker. Spaces are kept."""
    return F.coalesce(blank_to_null(value.cast("string")), F.lit(NULL_MARKER))


def unquoted(value: Column) -> Column:
    return F.translate(value, "'", "")


def short_name(value: Column) -> Column:
    return F.substring(value, 1, NAME_LENGTH)


def fixed_width_id(value: Column, width: int = 8) -> Column:
    """Left-padded with zeros; longer ids are cut to ``width``."""
    return F.lpad(value, width, "0")


def same_text(value: Column, constant: str) -> Column:
    """Case-insensitive equality with a constant."""
    return F.upper(value) == F.lit(constant.upper())


def present(value: Column) -> Column:
    return value.isNotNull() & (value != "")


def blanks_to_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Turn empty text into null in the named columns, in one projection."""
    chosen = {c.lower() for c in columns}
    return df.select([blank_to_null(F.col(c)).alias(c) if c.lower() in chosen else F.col(c) for c in df.columns])


def null_markers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Apply the export marker to the named columns, in one projection."""
    chosen = {c.lower() for c in columns}
    return df.select([marked(F.col(c)).alias(c) if c.lower() in chosen else F.col(c) for c in df.columns])
