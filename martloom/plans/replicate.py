"""Bulk replication of whole tables."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from martloom.sources.sinks import write_stage
from martloom.sources.tables import Database, Folder, read_table

# The tables replicated by default.
MASTER_TABLES = """
mtm_gh_indctn_trnsltns_vw mtm_gh_indication_vw mtm_gh_pg_to_ind_vw mtm_gh_pg_to_pg_vw mtm_gh_prod_altrnt_id_vw
mtm_gh_prod_grp_altrnt_id_vw mtm_gh_prod_grp_trnsltns_vw mtm_gh_prod_grp_typ_vw mtm_gh_prod_grp_vw
mtm_gh_prod_trnsltns_vw mtm_gh_prod_vw mtm_gh_prod_grp_to_prod_vw mtm_cntry
""".split()


@dataclass(frozen=True)
class Replicated:
    table: str
    rows: int | None
    error: str | None = None


def replicate_table(spark: SparkSession, source: Folder | Database, target: Folder | Database, table: str) -> Replicated:
    """Overwrite the target table; the rows are counted while they are written."""
    counted = Observation()
    df = read_table(spark, source, table).observe(counted, F.count(F.lit(1)).alias("rows"))
    write_stage(df, target, table)
    return Replicated(table, counted.get["rows"])


def bulk_replicate(
    spark: SparkSession,
    source: Folder | Database,
    target: Folder | Database,
    tables: Sequence[str] = tuple(MASTER_TABLES),
    fail_fast: bool = True,
    concurrent: int = 4,
) -> list[Replicated]:
    """Replicate every table, some at a time so that small ones do not leave the cluster idle."""

    def one(table: str) -> Replicated:
        try:
            return replicate_table(spark, source, target, table)
        except Exception as error:
            if fail_fast:
                raise
            return Replicated(table, None, str(error))

    with ThreadPoolExecutor(max_workers=concurrent) as pool:
        return list(pool.map(one, tables))
