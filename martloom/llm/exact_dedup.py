"""Exact deduplication with a heavy-hitter split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import packed, stored, text_or_empty

#: A digest with more than this share of the rows is certain to be among the heavy ones; at most 1/SUPPORT digests are.
SUPPORT = 0.001
WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: str) -> Column:
    """The text without its ASCII white space; null counts as empty."""
    return F.regexp_replace(text_or_empty(text), WHITE, "")


def digest_of(text: str) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def frequent_digests(rows: DataFrame, support: float) -> DataFrame:
    """Digests among which are all with more than ``support`` of the rows; counted as text, as equal byte arrays are not equal keys to Spark's counters."""
    named = rows.select(F.hex("digest").alias("digest")).freqItems(["digest"], support)
    return named.select(F.explode("digest_freqItems").alias("digest")).select(F.unhex("digest").alias("digest"))


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, digest``.

    Texts are equal when they are identical without ASCII white space. Of equal texts the row with the most code
    points in its original text stays, then the smallest id (null ids last); of rows that agree in both, one stays.

    Misra-Gries summaries of every partition, merged (``freqItems``), name at most ``1 / support`` digests that may be
    frequent. Their counts and winners are taken from all rows and broadcast, so frequent groups are resolved where
    their rows lie; only the rows of the remaining digests are shuffled, and no group of those exceeds ``support``
    of all rows.

    Null texts are empty texts and form a group. An empty table gives no rows. Extra columns are ignored.
    """
    rows = stored(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.length(text_or_empty(text)).alias("n_points"),
            digest_of(text).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    rank = F.struct((-F.col("n_points")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    frequent = stored(frequent_digests(rows, support), "heavy")
    winners = (
        rows.join(F.broadcast(frequent), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.count("*").alias("group_size"), F.min(rank).alias("best"))
    )
    heavy = rows.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    light = rows.join(F.broadcast(frequent), "digest", "left_anti").withColumns(
        {"group_size": F.count("*").over(group), "best": F.min(rank).over(group)}
    )
    return heavy.unionByName(light).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "digest",
    )


def drop_exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; columns of any name are kept.

    Null texts are empty texts, of which one stays. Null ids come last and are equal to one another. Rows that repeat id
    and text leave one. An empty table stays empty.
    """
    rows = exact_duplicates(docs, doc_id, text)
    kept = rows.filter("kept").select(F.col("doc_id").alias("kept_id"), "digest")
    marked = packed(docs).select("row", F.col(f"row.`{doc_id}`").alias("id"), digest_of(f"row.`{text}`").alias("text_digest"))
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("text_digest") == F.col("digest"))
    return marked.join(kept, same, "left_semi").dropDuplicates(["id", "text_digest"]).select("row.*")
