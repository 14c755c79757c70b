"""Typed, named and pruned projections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# PostgreSQL type codes. Numbers keep their fraction; unknown codes are read as text.
TYPE_OF_CODE = {
    16: T.BooleanType(),
    17: T.BinaryType(),
    20: T.LongType(),
    21: T.ShortType(),
    23: T.IntegerType(),
    25: T.StringType(),
    700: T.FloatType(),
    701: T.DoubleType(),
    1043: T.StringType(),
    1082: T.DateType(),
    1114: T.TimestampType(),
    1184: T.TimestampType(),
    1700: T.DecimalType(14, 6),
}


def schema_of_codes(columns: Mapping[str, int]) -> T.StructType:
    """The schema of a query result described by PostgreSQL type codes."""
    return T.StructType([T.StructField(name, TYPE_OF_CODE.get(code, T.StringType())) for name, code in columns.items()])


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto ``schema``: its order, names and types.

    Text that does not parse becomes null; a column that is absent is null throughout.
    """
    have = {c.lower() for c in df.columns}
    return df.select(
        [
            (F.col(f.name).try_cast(f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def all_text(df: DataFrame) -> DataFrame:
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


def project(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the mapped columns only, under their new names and in the order of the mapping."""
    return df.select([F.col(old).alias(new) for old, new in names.items()])


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename in one projection. Unmapped columns stay, mapped columns that are absent are skipped."""
    wanted = {old.lower(): new for old, new in names.items()}
    return df.select([F.col(c).alias(wanted.get(c.lower(), c)) for c in df.columns])
