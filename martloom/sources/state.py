"""State that outlives a run: bookmarks and the versioned history table.

Both are ordinary datasets in a shared folder that are only appended to. A run costs what it stages,
however long the history is: it adds its rows and the list of their keys, and a reader derives from
the key lists which rows are closed. A segment counts only once the commit log names it.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.context import RunContext
from martloom.operators import history as H
from martloom.session import path_exists

BOOKMARK_SCHEMA = "seq bigint, value string, exec_id bigint"
COMMIT_SCHEMA = "version bigint, exec_id bigint, removed_exec_id bigint, token string, segment string"


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def _literal_rows(spark: SparkSession, schema: T.StructType, row: tuple | None) -> DataFrame:
    """One row, or none, without a trip through Python workers."""
    values = row or (None,) * len(schema)
    columns = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, schema.fields, strict=True)]
    return spark.range(1 if row else 0, numPartitions=1).select(columns)


def _read_log(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.schema(ddl).json(path)
    return _literal_rows(spark, _schema(ddl), None)


def _create_entry(spark: SparkSession, folder: str, number: int, entry: dict) -> None:
    """Add one file to a log, named by its number. A second writer of the same number fails here."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{number:012d}.json")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, False)
    try:
        out.write(bytearray(json.dumps(entry).encode()))
    finally:
        out.close()


@dataclass(frozen=True)
class Bookmark:
    """The upper bound of the last finished extraction."""

    spark: SparkSession
    path: str

    def _last(self):
        log = _read_log(self.spark, self.path, BOOKMARK_SCHEMA)
        return log.agg(F.max(F.struct("seq", "value")).alias("last")).head()["last"]

    def read(self, default: str) -> str:
        last = self._last()
        return last["value"] if last else default

    def window(self, default: str, until: str, exec_id: int) -> tuple[str, bool]:
        """The lower bound for a run up to ``until``, and whether this very run has finished already.

        A retry of a finished run gets the bound it had the first time.
        """
        log = _read_log(self.spark, self.path, BOOKMARK_SCHEMA)
        last = self._last()
        if not last:
            return default, False
        mine = log.filter((F.col("exec_id") == exec_id) & (F.col("value") == until)).agg(F.max("seq")).head()[0]
        if mine != last["seq"]:
            return last["value"], False
        before = log.filter(F.col("seq") == mine - 1).head()
        return before["value"] if before else default, True

    def commit(self, value: str, exec_id: int, after: str | None = None) -> None:
        """Set the bound. A run that started from ``after`` fails if another run has moved the bound since, or does so at the same time."""
        last = self._last()
        if last and after is not None and last["value"] != after:
            raise RuntimeError(f"another run has moved the bound from {after} to {last['value']}")
        seq = (last["seq"] + 1) if last else 1
        _create_entry(self.spark, self.path, seq, {"seq": seq, "value": value, "exec_id": exec_id})


@dataclass(frozen=True)
class _State:
    version: int
    has_removals: bool
    published: bool


@dataclass(frozen=True)
class HistoryTable:
    """``apply_history`` over all published stages, kept as one segment per run."""

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    stamp_exec: bool = False

    def _commits(self) -> DataFrame:
        return _read_log(self.spark, f"{self.path}/commits", COMMIT_SCHEMA)

    def _state(self, token: str | None = None, exec_id: int | None = None) -> _State:
        """What the commit log says, in one small job."""
        publication = F.col("token").eqNullSafe(F.lit(token))
        concerned = publication | F.col("removed_exec_id").eqNullSafe(F.lit(exec_id).cast("bigint"))
        row = (
            self._commits()
            .agg(
                F.coalesce(F.max("version"), F.lit(0)).alias("version"),
                F.count("removed_exec_id").alias("removals"),
                F.max(F.when(concerned, F.struct("version", publication.alias("published")))).alias("last"),
            )
            .head()
        )
        published = token is not None and row["last"] is not None and row["last"]["published"]
        return _State(row["version"], row["removals"] > 0, published)

    def version(self) -> int:
        return self._state().version

    def _part(self, part: str, schema: T.StructType) -> DataFrame:
        """The segments of one part that the commit log names, with the version ``v`` of each row.

        What a run left that failed before its commit is in no version, whatever was committed since.
        """
        if not path_exists(self.spark, f"{self.path}/{part}"):
            return _literal_rows(self.spark, T.StructType([*schema.fields, T.StructField("v", T.LongType())]), None)
        stored = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("_segment", T.StringType())]))
        named = self._commits().filter(F.col("segment").isNotNull()).select(F.col("segment").alias("_segment"), F.col("version").alias("v"))
        return stored.parquet(f"{self.path}/{part}").join(named, "_segment").drop("_segment")

    def _without_removed(self, rows: DataFrame) -> DataFrame:
        """Leave out what rolled-back runs had created before they were rolled back."""
        removed = (
            self._commits()
            .filter(F.col("removed_exec_id").isNotNull())
            .groupBy("removed_exec_id")
            .agg(F.max("version").alias("removed_at"))
        )
        gone = (rows["created_by_job_exec_id"] == removed["removed_exec_id"]) & (rows["v"] < removed["removed_at"])
        return rows.join(removed, gone, "left_anti")

    def read(self) -> DataFrame:
        """The history as of the last commit: a row is closed by the next version that has its key.

        A key is listed once per version, so the window sees at most as many rows of it as there
        were runs, and the join is on key and version.
        """
        state = self._state()
        rows = self._part("rows", self.schema)
        if state.has_removals:
            rows = self._without_removed(rows)
        by_version = Window.partitionBy("_key").orderBy("v")
        following = self._part("keys", self._key_schema()).select(
            "_key",
            F.col("v").alias("_v"),
            F.lead("closed_ts").over(by_version).alias("_closed_ts"),
            F.lead("closed_by").over(by_version).alias("_closed_by"),
        )
        joined = rows.join(following, (rows[self.key] == following["_key"]) & (rows["v"] == following["_v"]), "left")
        hit = H.active() & F.col("_closed_ts").isNotNull()
        changes = {
            "is_active": F.when(hit, F.lit("N")).otherwise(F.col("is_active")),
            "updated_ts": F.when(hit, F.col("_closed_ts")).otherwise(F.col("updated_ts")),
        }
        if self.stamp_exec:
            changes["updated_by_job_exec_id"] = F.when(hit, F.col("_closed_by")).otherwise(
                F.col("updated_by_job_exec_id")
            )
        return joined.withColumns(changes).select([f.name for f in self.schema.fields])

    def _key_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField("_key", self.schema[self.key].dataType),
                T.StructField("closed_ts", T.TimestampType()),
                T.StructField("closed_by", T.LongType()),
            ]
        )

    def _commit(self, version: int, exec_id: int | None, removed: int | None, token: str | None, segment: str | None) -> None:
        entry = {"version": version, "exec_id": exec_id, "removed_exec_id": removed, "token": token, "segment": segment}
        _create_entry(self.spark, f"{self.path}/commits", version, entry)

    def publish(self, stage: DataFrame, run: RunContext, token: str | None = None) -> int:
        """Append the staged rows as one version, which closes the older rows of their keys.

        A run that fails before the commit leaves the previous version in place: its segment is never named.
        Of two runs that publish at the same time one fails and can be retried. A ``token`` that is published already is not published
        again, unless the run was rolled back since.
        """
        state = self._state(token, run.exec_id)
        if state.published:
            return state.version
        following = state.version + 1
        segment = self._add_segment(H.new_rows(self.schema, stage, run), run.timestamp, run.executor)
        self._commit(following, run.exec_id, None, token, segment)
        return following

    def seed(self, history: DataFrame) -> int:
        """Take over an existing history as the first version, closed rows and all."""
        if self.version():
            raise ValueError("only an empty history can be seeded")
        never = F.lit(None)
        segment = self._add_segment(history.select([f.name for f in self.schema.fields]), never, never)
        self._commit(1, None, None, None, segment)
        return 1

    def _add_segment(self, rows: DataFrame, closed_ts: Column, closed_by: Column) -> str:
        """Write rows and their keys under a name of their own. The keys are those of the rows as written."""
        segment = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/rows/_segment={segment}")
        written = self.spark.read.schema(rows.schema).parquet(f"{self.path}/rows/_segment={segment}")
        keys = H.stage_keys(written, self.key).select(
            F.col("_stage_key").alias("_key"),
            closed_ts.cast("timestamp").alias("closed_ts"),
            closed_by.cast("bigint").alias("closed_by"),
        )
        keys.write.parquet(f"{self.path}/keys/_segment={segment}")
        return segment

    def rollback(self, exec_id: int) -> int:
        """Take out the rows one run created. Rows it closed stay closed. Only the log is written."""
        following = self.version() + 1
        if following > 1:
            self._commit(following, exec_id, exec_id, None, None)
        return following
