"""Landed JSON objects: one folder per object type, text values only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def landing_schema(columns: Sequence[str]) -> T.StructType:
    """Landed values are read as text and typed by the stage that uses them."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


CORRUPT = "_corrupt_record"


def latest_file(spark: SparkSession, folder: str) -> str:
    """The last file by name. Lists the folder; the contents are not read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    last = listing.agg(F.max("path").alias("path")).head()["path"]
    if last is None:
        raise FileNotFoundError(f"no landed files in {folder}")
    return last


def parsed(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lines of text with ``_records``, the declared columns of the object or the objects of the array on each, and whether the
    line is ``_broken``, that is neither; blank lines go."""
    schema = landing_schema([*columns, CORRUPT])
    record = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    several = F.from_json("value", T.ArrayType(landing_schema(columns)), {"mode": "PERMISSIVE"})
    is_array = F.ltrim("value").startswith("[")
    found = lines.filter(F.trim("value") != "").withColumns({"_one": F.when(~is_array, record), "_several": F.when(is_array, several)})
    one = F.array(F.struct(*[F.col("_one")[c].alias(c) for c in columns]))
    return found.withColumns(
        {
            "_records": F.when(is_array, F.filter("_several", lambda r: r.isNotNull())).otherwise(one),
            "_broken": F.when(is_array, F.col("_several").isNull()).otherwise(F.col("_one")[CORRUPT].isNotNull()),
        }
    ).drop("_one", "_several")


def well_formed(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    rows = parsed(lines, columns).filter(~F.col("_broken")).select(F.explode("_records").alias("_record"))
    return rows.select([F.col("_record")[c].alias(c) for c in columns])


def rejected(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``line`` and ``file`` of the broken ones among lines that have their ``file``."""
    return parsed(lines, columns).filter("_broken").select(F.col("value").alias("line"), "file")


def _lines(spark: SparkSession, folder: str, latest_only: bool) -> DataFrame:
    where = latest_file(spark, folder) if latest_only else folder
    return spark.read.option("recursiveFileLookup", "true").text(where)


def read_landing(spark: SparkSession, folder: str, columns: Sequence[str], latest_only: bool = False) -> DataFrame:
    """All landed files with the declared columns, or only the last file. A missing folder is an error.

    A line with an array gives a row for each object in it. Lines that are neither object nor array are left out; ``landing_rejects`` has them.
    """
    return well_formed(_lines(spark, folder, latest_only), columns)


def landing_rejects(spark: SparkSession, folder: str, columns: Sequence[str], latest_only: bool = False) -> DataFrame:
    """The landed lines that do not parse, as they are (``line``), with the ``file`` they stand in."""
    lines = _lines(spark, folder, latest_only).select("value", F.col("_metadata.file_path").alias("file"))
    return rejected(lines, columns)
