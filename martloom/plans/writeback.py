"""Ids the receiving system gave to exported rows, landed back as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.plans.columns import LANDED_GROUP_ID, LANDED_PRODUCT_ID
from martloom.sources.landing import read_landing
from martloom.sources.sinks import write_stage
from martloom.sources.tables import Database, Folder


def product_ids(landed: DataFrame) -> DataFrame:
    return landed.select(
        F.col("Id").alias("sfdc_id"),
        F.col("Prod_id__c").alias("prod_id_glbl__c"),
        F.col("Product_External_ID__c").alias("product_external_id__c"),
        F.col("Cntry_Cd__c").alias("cntry_cd_glbl__c"),
    )


def group_ids(landed: DataFrame) -> DataFrame:
    return landed.select(
        F.col("Id").alias("sfdc_id"),
        F.col("Product_Group_External_ID_GLBL__c").alias("prod_grp_external_id_glbl__c"),
        F.col("Cntry_Cd_GLBL__c").alias("cntry_cd_glbl__c"),
        F.col("Product_Group_Id_GLBL__c").try_cast("double").alias("prod_grp_id_glbl__c"),
    )


def write_back_product_ids(spark: SparkSession, folder: str, target: Folder | Database, table: str) -> None:
    write_stage(product_ids(read_landing(spark, folder, LANDED_PRODUCT_ID)), target, table)


def write_back_group_ids(spark: SparkSession, folder: str, target: Folder | Database, table: str) -> None:
    write_stage(group_ids(read_landing(spark, folder, LANDED_GROUP_ID)), target, table)
