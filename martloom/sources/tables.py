"""Relational inputs: whole tables, queries and named bundles of queries."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession

from martloom.operators.schema import lower_names


@dataclass(frozen=True)
class Folder:
    """Tables stored as one dataset each below a folder."""

    path: str
    format: str = "parquet"
    suffix: str = ""

    def location(self, table: str) -> str:
        return f"{self.path.rstrip('/')}/{table}{self.suffix}"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.format(self.format).load(self.location(table))


@dataclass(frozen=True)
class Split:
    """How a JDBC scan is cut into partitions that are read in parallel."""

    column: str
    lower: str
    upper: str
    partitions: int


@dataclass(frozen=True)
class Database:
    """A schema reached through JDBC. ``splits`` says which tables are read in parallel, and how."""

    url: str
    schema: str
    properties: Mapping[str, str] = field(default_factory=dict)
    splits: Mapping[str, Split] = field(default_factory=dict)
    fetch_size: int = 10_000

    def options(self, table: str) -> dict[str, str]:
        chosen = {"url": self.url, "dbtable": f"{self.schema}.{table}", "fetchsize": str(self.fetch_size)}
        chosen.update(self.properties)
        split = self.splits.get(table)
        if split:
            chosen.update(
                partitionColumn=split.column,
                lowerBound=split.lower,
                upperBound=split.upper,
                numPartitions=str(split.partitions),
            )
        return chosen

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.format("jdbc").options(**self.options(table)).load()

    def query_options(self, text: str) -> dict[str, str]:
        return {"url": self.url, "query": text.strip().rstrip(";"), "fetchsize": str(self.fetch_size), **self.properties}

    def query(self, spark: SparkSession, text: str) -> DataFrame:
        """The result of SQL that runs in the database."""
        return spark.read.format("jdbc").options(**self.query_options(text)).load()


def read_table(spark: SparkSession, source: Folder | Database, table: str) -> DataFrame:
    return lower_names(source.read(spark, table))


def read_tables(spark: SparkSession, source: Folder | Database, names: Mapping[str, str]) -> dict[str, DataFrame]:
    """A bundle of lookup tables: name used by the plans -> table name."""
    return {name: read_table(spark, source, table) for name, table in names.items()}


def run_query(
    spark: SparkSession,
    text: str,
    tables: Mapping[str, DataFrame] | None = None,
    args: Mapping[str, object | Column] | None = None,
) -> DataFrame:
    """SQL with ``{table}`` placeholders for frames and ``:name`` markers for values.

    Values are bound, never pasted into the text. A list is passed as an array and tested with
    ``array_contains(:list, column)``.
    """
    return spark.sql(text.strip().rstrip(";"), args=dict(args or {}), **dict(tables or {}))


def run_queries(
    spark: SparkSession,
    texts: Mapping[str, str],
    tables: Mapping[str, DataFrame] | None = None,
    args: Mapping[str, object | Column] | None = None,
) -> dict[str, DataFrame]:
    return {name: run_query(spark, text, tables, args) for name, text in texts.items()}
