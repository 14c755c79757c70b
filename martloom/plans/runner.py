"""One incremental run: extract since the bookmark, stage, version, and only then move the bookmark."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from martloom.context import RunContext
from martloom.sources.sinks import write_stage
from martloom.sources.state import Bookmark, HistoryTable
from martloom.sources.tables import Database, Folder, read_table


@dataclass(frozen=True)
class IncrementalJob:
    """``extract`` gets the exclusive lower and the inclusive upper bound of the window."""

    extract: Callable[[str, str], DataFrame]
    bookmark: Bookmark
    first_bound: str
    stage: Folder | Database
    stage_table: str
    history: HistoryTable | None = None

    def run(self, spark: SparkSession, until: str, run: RunContext) -> tuple[str, str]:
        """Bounds of the window that was loaded.

        A retry of the same run to the same bound stages its window again and publishes it once, whether the first
        attempt had failed or finished.
        """
        after, finished = self.bookmark.window(self.first_bound, until, run.exec_id)
        write_stage(self.extract(after, until), self.stage, self.stage_table)
        if self.history:
            staged = read_table(spark, self.stage, self.stage_table)
            self.history.publish(staged, run, token=f"run-{run.exec_id}-{after}-{until}")
        if not finished:
            self.bookmark.commit(until, run.exec_id, after)
        return after, until
