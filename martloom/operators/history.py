"""Versioned history: close, append, roll back.

History rows carry ``is_active`` and the audit columns. Inactive rows never take part in the join;
they are passed on as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.context import RunContext, audit_stamp

def active() -> Column:
    return F.col("is_active").eqNullSafe("Y")


def stage_keys(stage: DataFrame, key: str) -> DataFrame:
    return stage.select(F.col(key).alias("_stage_key")).filter(F.col("_stage_key").isNotNull()).distinct()


def close_history(history: DataFrame, stage: DataFrame, key: str, run: RunContext, stamp_exec: bool = False) -> DataFrame:
    """The whole history with the staged keys closed; one join over the active rows only."""
    keys = stage_keys(stage, key)
    joined = history.filter(active()).join(keys, F.col(key) == F.col("_stage_key"), "left")
    hit = F.col("_stage_key").isNotNull()
    changes = {
        "is_active": F.when(hit, F.lit("N")).otherwise(F.col("is_active")),
        "updated_ts": F.when(hit, run.timestamp).otherwise(F.col("updated_ts")),
    }
    if stamp_exec:
        changes["updated_by_job_exec_id"] = F.when(hit, run.executor).otherwise(F.col("updated_by_job_exec_id"))
    still_or_closed = joined.withColumns(changes).select(history.columns)
    return history.filter(~active()).unionByName(still_or_closed)


def new_rows(schema: T.StructType, stage: DataFrame, run: RunContext) -> DataFrame:
    """Every staged row as an active history row; history columns the stage lacks are null."""
    stamped = audit_stamp(stage, run)
    have = {c.lower() for c in stamped.columns}
    return stamped.select(
        [
            (F.col(f.name) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def apply_history(history: DataFrame, stage: DataFrame, key: str, run: RunContext, stamp_exec: bool = False) -> DataFrame:
    """Close the staged keys, then append every staged row. Unchanged rows are not detected."""
    return close_history(history, stage, key, run, stamp_exec).unionByName(new_rows(history.schema, stage, run))


def rollback_history(history: DataFrame, exec_id: int) -> DataFrame:
    """Drop the rows one run created. Rows that run closed stay closed."""
    return history.filter(~F.col("created_by_job_exec_id").eqNullSafe(F.lit(exec_id).cast("bigint")))
