"""History versioning per micro-batch."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from martloom.context import RunContext
from martloom.sources.state import HistoryTable


def stream_history(rows: DataFrame, history: HistoryTable, run: RunContext, checkpoint: str) -> StreamingQuery:
    """Publish each micro-batch as one history version; a replayed batch is not published twice.

    Batches are told apart by the id that Spark keeps with the checkpoint and their number, so a stream with another
    checkpoint publishes all that it reads.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stream = session.read.text(f"{checkpoint}/metadata").head()["value"]
        replace(history, spark=session).publish(batch, run, token=f"{stream}-{batch_id}")

    return (
        rows.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
