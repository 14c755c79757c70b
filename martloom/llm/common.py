"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.session import scratch_path

#: Rows that a side may have at most to be broadcast; beyond it a shuffle join gives the same rows.
BROADCAST_ROWS = 200_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: its rows no longer depend on any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint where a stored frame is counted to be small; otherwise the frame as it is."""
    return F.broadcast(df) if df.count() <= limit else df


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns in one column ``row``: names that an operator adds beside it cannot clash with theirs."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_bytes(docs: DataFrame, text: str) -> int:
    """UTF-8 bytes of all texts; one row comes to the driver."""
    return docs.agg(F.sum(F.octet_length(text))).head()[0] or 0
