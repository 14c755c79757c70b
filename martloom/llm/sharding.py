"""Reproducible shuffle into shards by a Feistel permutation of global row numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import stored, text_or_empty

ROUNDS = 8
SEED = 20240607
_MULTIPLIERS = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(value: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (fixed public multipliers of splitmix64)."""
    value = (value ^ (value >> np.uint64(30))) * _MULTIPLIERS[0]
    value = (value ^ (value >> np.uint64(27))) * _MULTIPLIERS[1]
    return value ^ (value >> np.uint64(31))


def _keys(seed: int) -> np.ndarray:
    return _mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def _once(numbers: np.ndarray, bits: int, seed: int) -> np.ndarray:
    """One pass of the network over ``2 ** bits`` numbers: two halves take turns in being changed by the other."""
    low_bits = np.uint64(bits // 2)
    high_bits = np.uint64(bits - bits // 2)
    low_mask = (np.uint64(1) << low_bits) - np.uint64(1)
    high_mask = (np.uint64(1) << high_bits) - np.uint64(1)
    high, low = numbers >> low_bits, numbers & low_mask
    for turn, key in enumerate(_keys(seed)):
        if turn % 2:
            high = high ^ (_mixed(low ^ key) & high_mask)
        else:
            low = low ^ (_mixed(high ^ key) & low_mask)
    return (high << low_bits) | low


def permuted(numbers: np.ndarray, total: int, seed: int = SEED) -> np.ndarray:
    """The place of each row number below ``total`` in the shuffle: a bijection of 0 to ``total - 1``.

    A number that leaves the range is sent through the network again (cycle walking); the range is less than twice
    ``total``, so that is under two passes on average.
    """
    bits = max(2, int(total - 1).bit_length())
    placed = _once(numbers.astype(np.uint64), bits, seed)
    out = placed >= np.uint64(total)
    while out.any():
        placed[out] = _once(placed[out], bits, seed)
        out = placed >= np.uint64(total)
    return placed.astype(np.int64)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``row_number`` 0, 1, 2, ... in the order of the columns ``order``; rows equal in them are interchangeable.

    A range shuffle sorts the rows; they are stored with their place in their partition, and the counts of the
    partitions give each its first number. No task holds more than a partition, but for repeats of one row.
    """
    spread = rows.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    placed = stored(spread.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_place", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(firsts, "_part")
        .select(*rows.columns, (F.col("_first") + within).alias("row_number"))
    )


def shard(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, shard, slot``.

    Global row numbers in the order of id, checksum and size are permuted; the permuted number modulo ``shards`` is the
    shard, its quotient the slot. So shards differ by one row at most, slots have no gap, and both can be computed for
    any row number without the data. The result depends on the rows alone, not on files or partitions.

    Null texts have no bytes; null ids come first in the order; repeated rows get places of their own; an empty table
    gives no rows.
    """
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(text_or_empty(text)) + 1).cast("bigint").alias("size"),
        F.crc32(text_or_empty(text).cast("binary")).alias("text_crc32"),
    )
    rows = numbered(narrow, ["doc_id", "text_crc32", "size"])
    total = docs.count()

    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for numbers in batches:
            yield pd.Series(permuted(numbers.to_numpy(), total, seed))

    placed = F.pandas_udf(place, "bigint")
    return rows.withColumn("_at", placed("row_number")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.pmod("_at", F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"_at div {int(shards)}").alias("slot"),
    )
