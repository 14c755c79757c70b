"""Session settings, shuffle sizing and shared scratch folders."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Results depend on the first three; the others keep skewed joins from ending up in one task.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Parquet decodes to a multiple of its file size; count it so before a side is broadcast.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # Split a hot join partition even where a later operator could have reused the partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows that lie by product and country stay where they are for joins on these and more columns.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def build_session(app_name: str = "martloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to Python workers, once per application: they need not start where the driver did.

    The driver's file server hands it out, so nothing but the driver reads the archive.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="run-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(package.rglob("*.py")):
            packed.write(source, source.relative_to(package.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def partitions_for(total_bytes: int, expansion: float = 3.0) -> int:
    """Shuffle partitions that keep each one near 128 MB once columnar input is decoded."""
    return int(total_bytes * expansion // TARGET_PARTITION_BYTES) + 1


REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Every query run inside removes its shuffle files at its end, not whenever the driver collects garbage."""
    before = spark.conf.get(REMOVE_SHUFFLES, "false")
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(REMOVE_SHUFFLES, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def remove_path(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def replace_path(spark: SparkSession, fresh: str, path: str) -> None:
    """Put what was written at ``fresh`` in the place of ``path``."""
    source, location = spark._jvm.org.apache.hadoop.fs.Path(fresh), spark._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(location, True)
    if not system.rename(source, location):
        raise OSError(f"{fresh} could not be renamed to {path}")


def input_bytes(spark: SparkSession, paths: Iterable[str]) -> int:
    """Total file size under ``paths``; one metadata call per path, no data is read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        location = jvm.org.apache.hadoop.fs.Path(path)
        total += location.getFileSystem(conf).getContentSummary(location).getLength()
    return total


def size_shuffle(spark: SparkSession, paths: Iterable[str]) -> int:
    """Raise ``spark.sql.shuffle.partitions`` to suit the input. Never lowers it: AQE coalesces."""
    wanted = partitions_for(input_bytes(spark, paths))
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return max(wanted, current)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the cluster's shared checkpoint folder.

    Only a local session may fall back to a temporary folder of the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{base.rstrip('/')}/martloom/{name}-{uuid.uuid4().hex}"
