"""The explicit clock and identity of one run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUDIT_FIELDS = [
    T.StructField("is_active", T.StringType()),
    T.StructField("created_ts", T.TimestampType()),
    T.StructField("updated_ts", T.TimestampType()),
    T.StructField("created_by_job_exec_id", T.LongType()),
    T.StructField("updated_by_job_exec_id", T.LongType()),
]


@dataclass(frozen=True)
class RunContext:
    """Passed in instead of reading the wall clock, so that a replay gives the same rows."""

    run_ts: datetime
    exec_id: int
    as_of: date | None = None

    @property
    def as_of_date(self) -> Column:
        return F.lit(self.as_of or self.run_ts.date())

    @property
    def timestamp(self) -> Column:
        return F.to_timestamp(F.lit(self.run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")))

    @property
    def executor(self) -> Column:
        return F.lit(self.exec_id).cast("bigint")


def audit_stamp(df: DataFrame, run: RunContext) -> DataFrame:
    """Mark every row active and created by ``run``."""
    return df.withColumns(
        {
            "is_active": F.lit("Y"),
            "created_ts": run.timestamp,
            "updated_ts": run.timestamp,
            "created_by_job_exec_id": run.executor,
            "updated_by_job_exec_id": run.executor,
        }
    )
