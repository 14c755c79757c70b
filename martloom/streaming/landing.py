"""Landed JSON as a stream: every file is taken once, whatever happens between two runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martloom.sources.landing import rejected, well_formed


def landing_stream(
    spark: SparkSession, folder: str, columns: Sequence[str], files_per_trigger: int | None = None
) -> DataFrame:
    """Rows that land, without lines that are no JSON object (``landing_rejects`` has them)."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return well_formed(reader.text(folder), columns)


def ingest_landing(rows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append what landed since the last call to ``target`` and stop; the checkpoint is the bookmark."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def landed_lines(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines as they land (``value``), with the ``file`` they stand in."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(folder).select("value", F.col("_metadata.file_path").alias("file"))


def ingest_with_rejects(
    lines: DataFrame, columns: Sequence[str], target: str, rejects: str, checkpoint: str
) -> StreamingQuery:
    """Take what landed since the last call: its rows go to ``target``, its broken lines with their file to ``rejects``.

    Both are written by batch, below the batch's number, so a batch that runs again after a failure replaces what it left.
    """

    def both(batch: DataFrame, number: int) -> None:
        well_formed(batch, columns).write.mode("overwrite").parquet(f"{target}/batch={number}")
        rejected(batch, columns).write.mode("overwrite").parquet(f"{rejects}/batch={number}")

    return lines.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
