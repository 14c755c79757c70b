"""Mart inputs derived from the star-schema test tables.

Each input is one SELECT over the given tables and other inputs, spelled so that Spark and DuckDB
both read it; ``EACH_n`` repeats a row for 0..n-1. Every input but the country and parameter tables
grows with the tables it reads.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from martloom.plans import columns as C
from martloom.session import input_bytes

GIVEN = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def country(nk: str) -> str:
    return f"CASE WHEN {nk} = 0 THEN 'ZZ' ELSE 'C' || CAST({nk} AS STRING) END"


def dialect(nk: str) -> str:
    return f"CASE {nk} % 3 WHEN 0 THEN 'EN' WHEN 1 THEN 'FR' ELSE 'DE' END"


def filler(columns: list[str], key: str, label: str) -> str:
    """Descriptive text columns: some missing, some empty, the others different per column."""
    return ",\n".join(
        f"CASE ({key} + {i}) % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE {label} || '/{i}' END AS {c}"
        for i, c in enumerate(columns)
    )


def day_or_null(base: str, key: str, step: int, span: int, i: int) -> str:
    """A date, in some rows missing and in some the far-future one."""
    return (
        f"CASE ({key} + {i}) % 5 WHEN 0 THEN CAST(NULL AS DATE) WHEN 1 THEN DATE '9999-12-31' "
        f"ELSE DATE '{base}' + CAST(({key} * {step} + {i}) % {span} AS INT) END"
    )


# Tables the inputs repeat many times over, and the file bytes of one task's share of them: a small file is one split, which
# would leave all repeated rows and their aggregates to one task.
REPEATED = ("part", "customer", "supplier")
SHARE_BYTES = 512 * 1024

MASTER_OWN = "prod_id prod_nm prod_typ brnd_cd start_dt end_dt crt_dt updt_dt lst_lot_exprtn_dt lst_pblsh_dt cease_pblsh_dt".split()
MASTER_TEXT = [c for c in C.PRODUCT_MASTER if c not in MASTER_OWN]
EXPORT_OWN = ["trnsltd_dsply_nm__c", "prod_id__c", *C.EXPORT_PRODUCT_DATES]
EXPORT_TEXT = [c for c in C.EXPORT_PRODUCT if c not in EXPORT_OWN]


def _money(value: str) -> str:
    return f"CAST(CAST({value} AS DECIMAL(16,2)) AS STRING)"


INPUTS: dict[str, str] = {}

INPUTS["in_country"] = f"""
SELECT n_nationkey AS nk, {country('n_nationkey')} AS cntry_cd, {dialect('n_nationkey')} AS dialect
FROM nation"""

INPUTS["in_dialects"] = "SELECT cntry_cd AS country_code, dialect FROM in_country JOIN nation ON nk = n_nationkey WHERE n_regionkey <> 4"

INPUTS["in_prod"] = f"""
SELECT p_partkey AS prod_id, p_name AS prod_nm, p_brand AS brnd_cd,
       CASE p_type WHEN 'PROMO' THEN 'SAMPLE' WHEN 'SMALL' THEN 'EDUCATIONAL' WHEN 'MEDIUM' THEN 'COMPETITOR'
                   WHEN 'ECONOMY' THEN 'OTHER' ELSE 'OWN' END AS prod_typ,
       DATE '2000-01-01' + p_size AS start_dt,
       DATE '2020-01-01' + CAST((p_partkey * 53) % 1500 AS INT) AS end_dt,
       DATE '2001-01-01' + p_size AS crt_dt,
       DATE '2018-01-01' + CAST((p_partkey * 11) % 700 AS INT) AS updt_dt,
       {day_or_null('2022-01-01', 'p_partkey', 17, 800, 0)} AS lst_lot_exprtn_dt,
       {day_or_null('2021-01-01', 'p_partkey', 41, 900, 0)} AS cease_pblsh_dt,
       DATE '2019-01-01' + CAST((p_partkey * 37) % 1000 AS INT) AS lst_pblsh_dt,
       {filler(MASTER_TEXT, 'p_partkey', 'p_brand')}
FROM part"""

INPUTS["in_groups"] = """
SELECT DISTINCT
       CASE i WHEN 0 THEN 1000000 + k - k % 8 WHEN 1 THEN 2000000 + k - k % 16 ELSE 3000000 + k - k % 40 END AS prod_grp_id,
       CASE i WHEN 0 THEN 'STGH' WHEN 1 THEN 'BRND' ELSE 'MKTP' END AS grp_prps_cd
FROM (SELECT p_partkey AS k, EACH_3 AS i FROM part) x"""

INPUTS["in_links"] = """
SELECT k AS prod_child_id,
       CASE WHEN i < 2 THEN 1000000 + k - k % 8 ELSE 2000000 + k - k % 16 END AS prod_grp_prnt_id,
       DATE '2023-01-01' + CAST(k % 400 AS INT) AS end_dt,
       CASE WHEN (k + i) % 7 = 0 THEN CAST(NULL AS DATE) ELSE DATE '2022-06-01' + CAST(i * 30 AS INT) END AS cease_pblsh_dt,
       DATE '2019-01-01' + CAST((k * 37) % 1000 AS INT) + CAST(i AS INT) AS lst_pblsh_dt
FROM (SELECT p_partkey AS k, EACH_4 AS i FROM part) x"""

INPUTS["in_group_links"] = f"""
SELECT prod_grp_id AS prod_grp_id_child,
       CASE WHEN i < 6 THEN 2000000 + k - k % 16 ELSE 3000000 + k - k % 40 END AS prod_grp_id_prnt,
       {country('((k + 5 * i) % 25)')} AS cntry_cd
FROM (SELECT prod_grp_id, prod_grp_id - 1000000 AS k, EACH_12 AS i FROM in_groups WHERE grp_prps_cd = 'STGH') x"""

INPUTS["in_translations"] = f"""
SELECT prod_id, {country('nk')} AS cntry_cd,
       CASE WHEN i = 7 THEN 'EN' ELSE {dialect('nk')} END AS dialect_nm,
       CASE WHEN (prod_id + nk) % 11 = 0 THEN NULL ELSE prod_nm || ' ' || {dialect('nk')} END AS trnsltd_dsply_nm,
       CASE WHEN prod_id % 5 = 0 THEN NULL ELSE prod_nm || ' text' END AS trnsltd_prod_desc_txt,
       start_dt + 1 AS start_dt, end_dt + 30 AS end_dt,
       CASE WHEN prod_id % 4 = 0 THEN CAST(NULL AS DATE) ELSE DATE '2022-09-01' END AS cease_pblsh_dt,
       lst_pblsh_dt + 5 AS lst_pblsh_dt
FROM (SELECT prod_id, prod_nm, start_dt, end_dt, lst_pblsh_dt, i, (prod_id + 3 * i) % 25 AS nk
      FROM (SELECT prod_id, prod_nm, start_dt, end_dt, lst_pblsh_dt, EACH_8 AS i FROM in_prod) x) y"""

INPUTS["in_alternates"] = f"""
SELECT prod_id, {country('nk')} AS cntry_cd,
       CASE WHEN i = 9 THEN 'T9' ELSE 'T' || CAST(nk % 2 AS STRING) END AS altrnt_id_type_cd,
       'A' || CAST(prod_id AS STRING) || '-' || CAST(nk AS STRING) AS altrnt_id,
       start_dt + 2 AS start_dt, end_dt + 60 AS end_dt, CAST(NULL AS DATE) AS cease_pblsh_dt, lst_pblsh_dt + 9 AS lst_pblsh_dt
FROM (SELECT prod_id, start_dt, end_dt, lst_pblsh_dt, i, (prod_id + 2 * i) % 25 AS nk
      FROM (SELECT prod_id, start_dt, end_dt, lst_pblsh_dt, EACH_10 AS i FROM in_prod) x) y"""

INPUTS["in_group_translations"] = f"""
SELECT prod_grp_id, {country('nk')} AS cntry_cd, {dialect('nk')} AS dialect_nm,
       'G' || CAST(prod_grp_id AS STRING) || {dialect('nk')} AS trnsltd_grp_nm,
       DATE '2024-01-01' - CAST((prod_grp_id + nk) % 900 AS INT) AS end_dt,
       CASE WHEN nk % 4 = 0 THEN CAST(NULL AS DATE) ELSE DATE '2022-12-31' END AS cease_pblsh_dt,
       DATE '2021-01-01' + CAST(prod_grp_id % 365 AS INT) AS lst_pblsh_dt
FROM (SELECT prod_grp_id, (prod_grp_id + i) % 25 AS nk FROM (SELECT prod_grp_id, EACH_18 AS i FROM in_groups) x) y"""

INPUTS["in_params"] = f"""
SELECT {country('nk')} AS cntry_cd, CASE i WHEN 0 THEN 'BRND' ELSE 'MKTP' END AS grp_prps_cd, {dialect('nk')} AS dialect_nm,
       'T' || CAST(nk % 2 AS STRING) AS altrnt_id_type_cd, 'RT_' || CASE i WHEN 0 THEN 'BRND' ELSE 'MKTP' END AS recordtype
FROM (SELECT n_nationkey AS nk, EACH_2 AS i FROM nation WHERE n_regionkey <> 4) x"""

INPUTS["in_replicated_groups"] = f"""
SELECT 'SFG' || CAST(prod_grp_id AS STRING) || '-' || CAST(i AS STRING) AS sfdc_id, prod_grp_id, {country('nk')} AS cntry_cd,
       CAST(prod_grp_id AS STRING) || {country('nk')} AS prod_grp_external_id
FROM (SELECT prod_grp_id, i, (prod_grp_id + CASE WHEN i = 20 THEN 0 ELSE i END) % 25 AS nk
      FROM (SELECT prod_grp_id, EACH_21 AS i FROM in_groups) x) y"""

INPUTS["in_replicated_products"] = f"""
SELECT 'SFP' || CAST(prod_id AS STRING) || '-' || CAST(i AS STRING) AS sfdc_id, prod_id, {country('nk')} AS cntry_cd,
       CASE WHEN i % 2 = 0 THEN 'BRND' || CAST(2000000 + prod_id - prod_id % 16 AS STRING)
            ELSE 'MKTP' || CAST(3000000 + prod_id - prod_id % 8 - (prod_id - prod_id % 8) % 40 AS STRING) END
         || CAST(prod_id AS STRING) || {country('nk')} || 'T' || CAST(nk % 2 AS STRING) AS product_external_id
FROM (SELECT prod_id, i, (prod_id + 6 * i) % 25 AS nk FROM (SELECT prod_id, EACH_8 AS i FROM in_prod) x) y"""

INPUTS["in_meeting"] = """
SELECT 'M' || CAST(o_orderkey AS STRING) AS Id, 'E' || CAST(o_orderkey AS STRING) AS Event_Id_MERC__c,
       CASE o_custkey % 25 WHEN 24 THEN NULL WHEN 23 THEN '' ELSE 'C' || CAST(o_custkey % 25 AS STRING) END AS Event_Country_MERC__c,
       CAST(CAST(o_orderdate AS DATE) AS STRING) || CASE o_custkey % 2 WHEN 0 THEN '' ELSE 'T10:00:00.000Z' END AS Date_of_Event_MERC__c,
       CAST(o_custkey * 79190 AS STRING) AS Owner_Master_Id_MERC__c, o_orderpriority AS Name,
       CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T00:00:00.000Z' AS Participant_ToV_Updated_Date_MERC__c,
       CASE WHEN o_orderstatus = 'F' THEN 'No' ELSE 'Yes' END AS Participant_ToV_Final_MERC__c
FROM orders"""

INPUTS["in_participant"] = f"""
SELECT 'P' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS Id,
       'M' || CAST(l_orderkey AS STRING) AS Meeting_MERC__c, 'A' || CAST(l_suppkey + 3 AS STRING) AS Account_MERC__c,
       CASE l_returnflag WHEN 'R' THEN 'Other' ELSE 'HCP' END AS Participant_Typ_MERC__c,
       CASE l_linenumber WHEN 3 THEN 'Cancelled' WHEN 4 THEN 'No Show' ELSE 'Attended' END AS Status_MERC__c,
       CAST(l_partkey AS STRING) AS Customer_Id_GLBL__c, CASE l_linestatus WHEN 'F' THEN 'EUR' ELSE 'CHF' END AS ToV_Currency_MERC__c,
       {_money('l_extendedprice')} AS Total_Hotel_ToV_MERC__c,
       CASE l_linenumber WHEN 2 THEN NULL ELSE {_money('l_quantity')} END AS Total_Ground_Transporation_ToV_MERC__c,
       CASE l_linenumber WHEN 1 THEN '' ELSE {_money('l_quantity + 1')} END AS Total_Registration_ToV_MERC__c,
       {_money('l_tax')} AS Total_Food_Beverage_ToV_MERC__c,
       CASE l_linenumber WHEN 6 THEN 'n/a' ELSE {_money('l_quantity + 2')} END AS Total_Individual_Transport_ToV_MERC__c,
       {_money('l_tax')} AS CoPay_AODS_Hotel_MERC__c,
       CASE l_linenumber WHEN 4 THEN {_money('l_quantity + 3')} ELSE NULL END AS CoPay_AODS_Ground_Transport_MERC__c,
       CASE l_linenumber WHEN 5 THEN {_money('l_quantity + 4')} ELSE '' END AS CoPay_AODS_Food_Beverage_MERC__c,
       CASE l_linenumber WHEN 6 THEN {_money('l_quantity + 5')} ELSE NULL END AS CoPay_AODS_Registration_MERC__c,
       CASE l_linenumber WHEN 7 THEN {_money('l_quantity + 6')} ELSE NULL END AS CoPay_AODS_Flight_Rail_MERC__c,
       CASE l_linenumber WHEN 1 THEN {_money('l_quantity + 7')} ELSE NULL END AS CoPay_AODS_Indiv_Transportation_MERC__c,
       CASE l_linenumber % 3 WHEN 0 THEN 'Merc_Event' WHEN 1 THEN NULL ELSE 'Merc_Individual_Sponsorship' END AS Record_Type_Name_MERC__c
FROM lineitem"""

INPUTS["in_account"] = "SELECT 'A' || CAST(s_suppkey AS STRING) AS Id, s_name AS Name FROM supplier"

INPUTS["in_day_value"] = f"""
SELECT pid || '-D' || CAST(i AS STRING) AS Id, pid AS Meeting_Participant_MERC__c,
       CAST(CAST(l_shipdate AS DATE) + CAST(CASE WHEN l_linenumber = 7 THEN 0 ELSE i END AS INT) AS STRING) AS Meeting_Day_Date_MERC__c,
       CASE l_linenumber WHEN 5 THEN '' ELSE 'USD' END AS CurrencyIsoCode,
       {_money('l_extendedprice')} AS Est_Hotel_ToV_MERC__c,
       CASE i WHEN 0 THEN '' ELSE {_money('l_quantity')} END AS Est_Grp_Grnd_Transp_MERC__c,
       CASE i WHEN 0 THEN NULL ELSE {_money('l_tax')} END AS Est_Food_Bev_ToV_MERC__c,
       {_money('l_quantity + 1')} AS Est_Reg_Amt_ToV_MERC__c,
       CASE l_linenumber WHEN 1 THEN '150000000.25' ELSE NULL END AS Est_Indv_Transfer_MERC__c
FROM (SELECT CASE l_linenumber WHEN 4 THEN 'unknown-' ELSE 'P' END || CAST(l_orderkey AS STRING) || '-'
               || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS pid,
             l_linenumber, l_shipdate, l_extendedprice, l_quantity, l_tax, EACH_2 AS i
      FROM lineitem) x"""

INPUTS["in_group_source"] = f"""
SELECT 1000000 + o_custkey AS prod_grp_id, 'SRC' AS src_cd, 'Group ' || CAST(o_custkey AS STRING) AS grp_nm,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS grp_abbr_nm,
       'Text ' || CAST(o_orderkey AS STRING) AS prod_grp_desc_txt, CASE o_custkey % 2 WHEN 0 THEN 'BRND' ELSE 'MKTP' END AS grp_prps_cd,
       CAST(NULL AS STRING) AS grp_cnvrsn_unit_cd, CAST(o_orderdate AS DATE) AS start_dt,
       CASE o_orderkey % 9 WHEN 0 THEN CAST(NULL AS DATE) ELSE CAST(o_orderdate AS DATE) + 400 END AS end_dt,
       CAST(o_orderdate AS DATE) + 1 AS crt_dt, CAST(o_orderdate AS DATE) + 2 AS updt_dt, CAST(o_orderdate AS DATE) + 3 AS lst_pblsh_dt,
       CASE o_orderstatus WHEN 'F' THEN DATE '9999-12-31' ELSE CAST(NULL AS DATE) END AS cease_pblsh_dt,
       CASE WHEN o_orderkey % 26 = 25 THEN NULL ELSE {country('(o_orderkey % 26)')} END AS cntry_cd,
       CASE o_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'COMPETITOR' WHEN 2 THEN '''COMBO''' WHEN 3 THEN 'COLLABORATOR'
                          WHEN 4 THEN 'OTHER' ELSE 'OWN' END AS prod_grp_typ
FROM orders"""

INPUTS["in_source_translations"] = f"""
SELECT prod_grp_id, CASE i WHEN 0 THEN 'US' ELSE {country('nk')} END AS cntry_cd,
       CASE i WHEN 0 THEN 'EN' ELSE {dialect('nk')} END AS dialect_nm,
       'T' || CAST(prod_grp_id AS STRING) || '.' || CAST(i AS STRING) AS trnsltd_grp_nm,
       DATE '1997-01-01' + CAST((prod_grp_id * 7 + i * 31) % 1500 AS INT) AS end_dt
FROM (SELECT prod_grp_id, i, (prod_grp_id + 2 * i) % 25 AS nk
      FROM (SELECT 1000000 + c_custkey AS prod_grp_id, EACH_14 AS i FROM customer) x) y"""

INPUTS["in_parents"] = """
SELECT 1000000 + k AS prod_grp_id_child, CASE i WHEN 0 THEN 1000000 + k - k % 10 ELSE 9000000 + c_nationkey END AS prod_grp_id_prnt
FROM (SELECT c_custkey AS k, c_nationkey, EACH_2 AS i FROM customer WHERE c_acctbal > 0) x"""

INPUTS["in_indication"] = f"""
SELECT 1000000 + l_suppkey AS prod_grp_id, 'I' || CAST(l_linenumber AS STRING) AS indctn_id,
       'Indication ' || l_returnflag AS indctn_desc, CAST(NULL AS STRING) AS indctn_short_desc,
       l_linestatus AS indctn_sts, CASE l_returnflag WHEN 'R' THEN NULL ELSE l_returnflag END AS indctn_typ,
       CAST(l_shipdate AS DATE) - 30 AS apprvl_dt, {day_or_null('2020-01-01', 'l_partkey', 3, 700, 2)} AS revoke_dt,
       CAST(l_shipdate AS DATE) AS start_dt,
       CASE l_partkey % 13 WHEN 0 THEN CAST(NULL AS DATE)
            ELSE DATE '2020-01-01' + CAST((l_suppkey * 7 + l_partkey) % 40 AS INT) END AS end_dt,
       CAST(NULL AS STRING) AS apprvl_sts_cd, {country('(l_partkey % 25)')} AS cntry_cd,
       CAST(l_shipdate AS DATE) AS crt_dt, CAST(l_shipdate AS DATE) + 1 AS updt_dt, CAST(l_shipdate AS DATE) + 2 AS lst_pblsh_dt,
       CAST(NULL AS DATE) AS cease_pblsh_dt,
       CASE l_suppkey % 2 WHEN 0 THEN '''OWN''' ELSE 'COMPETITOR' END AS prod_grp_typ
FROM lineitem"""

INPUTS["in_indication_translations"] = """
SELECT 'I' || CAST(i + 1 AS STRING) AS indctn_id, dialect AS dialect_nm,
       CASE WHEN i = 2 AND dialect = 'DE' THEN NULL ELSE 'Ind ' || CAST(i + 1 AS STRING) || ' ' || dialect END AS trnsltd_indctn_desc_txt,
       'short ' || dialect AS trnsltd_indctn_short_desc
FROM (SELECT dialect, EACH_6 AS i FROM (SELECT DISTINCT dialect FROM in_country) d) x"""

INPUTS["in_indication_groups"] = f"""
SELECT 'SFG' || CAST(k AS STRING) || '-' || CAST(i AS STRING) AS sfdc_id,
       CAST(1000000 + k AS STRING) || CASE WHEN i < 12 THEN {country('((k + 2 * i + 1) % 25)')}
                                           WHEN s_acctbal > 3000 THEN 'ZZ' ELSE 'XX' END AS prod_grp_external_id
FROM (SELECT s_suppkey AS k, s_acctbal, EACH_13 AS i FROM supplier) x"""

INPUTS["in_history"] = """
SELECT o_custkey AS k, o_orderpriority AS payload, CASE o_orderstatus WHEN 'F' THEN 'N' ELSE 'Y' END AS is_active,
       CAST(o_orderdate AS DATE) AS created_day, CASE o_orderstatus WHEN 'O' THEN CAST(1 AS BIGINT) ELSE CAST(2 AS BIGINT) END AS exec_id
FROM orders"""

INPUTS["in_stage"] = "SELECT c_custkey * 2 AS k, c_mktsegment AS payload FROM customer"

# Lines as they land: objects, arrays of objects, text that is cut off, and blank lines.
INPUTS["in_landed_line"] = """
SELECT CASE event_id % 11
         WHEN 0 THEN '{"event_id": "' || CAST(event_id AS STRING) || '", "event_type": '
         WHEN 1 THEN '[{"event_id": "' || CAST(event_id AS STRING) || '", "event_type": "' || event_type || '"}, {"event_id": "' || CAST(-event_id AS STRING) || '"}]'
         WHEN 2 THEN '  '
         WHEN 3 THEN '[{"event_id": "' || CAST(event_id AS STRING) || '"'
         ELSE '{"event_type": "' || event_type || '", "event_id": "' || CAST(event_id AS STRING) || '"}' END AS line
FROM events"""

INPUTS["in_export_product"] = f"""
SELECT p_partkey AS prod_id__c,
       CASE p_partkey % 9 WHEN 0 THEN NULL ELSE p_name || ' ' || p_brand || ' with a display name that runs on well beyond eighty characters, as some do' END AS trnsltd_dsply_nm__c,
       {", ".join(day_or_null('2020-01-01', 'p_partkey', 29, 900, i) + ' AS ' + c for i, c in enumerate(C.EXPORT_PRODUCT_DATES))},
       {filler(EXPORT_TEXT, 'p_partkey', 'p_name')}
FROM part"""

INPUTS["in_export_group"] = f"""
SELECT 1000000 + c_custkey AS product_group_id_glbl__c, 'SRC' AS src_cd_glbl__c, c_name AS name,
       c_mktsegment AS grp_abbr_nm_glbl__c, CASE c_nationkey % 4 WHEN 0 THEN '' ELSE c_mktsegment || ' text' END AS prod_grp_desc_txt_glbl__c,
       'BRND' AS grp_prps_cd_glbl__c, CAST(NULL AS STRING) AS grp_cnvrsn_unit_cd_glbl__c, DATE '2010-01-01' + c_nationkey AS start_dt_glbl__c,
       {day_or_null('2023-01-01', 'c_custkey', 7, 500, 0)} AS end_dt_glbl__c, DATE '2011-01-01' + c_nationkey AS crt_dt_glbl__c,
       CASE c_nationkey WHEN 5 THEN CAST(NULL AS DATE) ELSE DATE '2012-01-01' + c_nationkey END AS updt_dt_glbl__c,
       DATE '2013-01-01' + c_nationkey AS lst_pblsh_dt_glbl__c, {day_or_null('2024-01-01', 'c_custkey', 3, 400, 3)} AS cease_pblsh_dt_glbl__c,
       {country('c_nationkey')} AS cntry_cd_glbl__c, {dialect('c_nationkey')} AS dialect_nm_glbl__c,
       CASE c_nationkey % 3 WHEN 1 THEN NULL ELSE c_name || ' translated, at a length that the name column of the receiving system cannot hold in full' END AS trnsltd_grp_nm_glbl__c,
       CAST(1000000 + c_custkey AS STRING) || {country('c_nationkey')} AS prod_grp_external_id_glbl__c,
       CASE c_nationkey % 5 WHEN 0 THEN NULL ELSE 'OWN' END AS prod_grp_typ_cd_glbl__c,
       CASE c_nationkey % 2 WHEN 0 THEN CAST(NULL AS BIGINT) ELSE 9000000 + c_custkey END AS glbl_parent_product_group__c
FROM customer"""

INPUTS["in_export_indication"] = f"""
SELECT CAST(o_orderdate AS DATE) AS approval_dt_glbl__c, CASE o_orderstatus WHEN 'F' THEN '' ELSE o_orderstatus END AS apprvl_sts_glbl__c,
       {day_or_null('2024-01-01', 'o_orderkey', 3, 400, 0)} AS cease_pblsh_dt_glbl__c, {country('(o_custkey % 25)')} AS country_cd_glbl__c,
       CAST(o_orderdate AS DATE) + 1 AS crt_dt_glbl__c, {dialect('(o_custkey % 25)')} AS dialect_nm_glbl__c,
       {day_or_null('2025-01-01', 'o_orderkey', 5, 400, 1)} AS end_dt_glbl__c,
       'Indication ' || o_orderpriority || ' described at a length that does not fit the eighty characters of a name' AS indctn_desc_glbl__c,
       CAST(1000000 + o_custkey AS STRING) || 'I' || CAST(o_orderkey AS STRING) AS indctn_ext_id_glbl__c,
       'I' || CAST(o_orderkey AS STRING) AS indctn_id_glbl__c, o_orderpriority AS name__c, o_orderstatus AS indctn_sts_glbl__c,
       CAST(NULL AS STRING) AS indctn_typ_glbl__c, CAST(o_orderdate AS DATE) + 2 AS lst_pblsh_dt_glbl__c,
       'SFG' || CAST(o_custkey AS STRING) AS prod_grp_prnt_id_glbl_sfdc_id, {day_or_null('2026-01-01', 'o_orderkey', 7, 400, 2)} AS revoke_dt_glbl__c,
       CASE o_orderkey % 8 WHEN 0 THEN CAST(NULL AS DATE) ELSE CAST(o_orderdate AS DATE) END AS start_dt_glbl__c,
       CAST(NULL AS STRING) AS trnsltd_indctn_desc_glbl__c, 'short' AS trnsltd_indctn_sh_desc_glbl__c, CAST(o_orderdate AS DATE) + 3 AS updt_dt_glbl__c
FROM orders"""

INPUTS["in_landed_product_ids"] = f"""
SELECT 'SFP' || CAST(p_partkey AS STRING) || '-' || CAST(i AS STRING) AS Id, CAST(p_partkey AS STRING) AS Prod_id__c,
       'BRND' || CAST(2000000 + p_partkey - p_partkey % 16 AS STRING) || CAST(p_partkey AS STRING) AS Product_External_ID__c,
       CASE i WHEN 3 THEN NULL ELSE {country('((p_partkey + i) % 25)')} END AS Cntry_Cd__c
FROM (SELECT p_partkey, EACH_4 AS i FROM part) x"""

INPUTS["in_landed_group_ids"] = f"""
SELECT 'SFG' || CAST(c_custkey AS STRING) AS Id, CAST(1000000 + c_custkey AS STRING) || {country('c_nationkey')} AS Product_Group_External_ID_GLBL__c,
       {country('c_nationkey')} AS Cntry_Cd_GLBL__c, CASE c_mktsegment WHEN 'FURNITURE' THEN 'unknown' ELSE CAST(1000000 + c_custkey AS STRING) END AS Product_Group_Id_GLBL__c
FROM customer"""

_NAME = re.compile(r"\bin_[a-z_]+\b")
_EACH = re.compile(r"\bEACH_(\d+)\b")


def _needed(text: str) -> list[str]:
    """Inputs a text uses, directly or through others, each after those it uses itself."""
    found: list[str] = []

    def visit(part: str) -> None:
        for name in sorted(set(_NAME.findall(part)) & set(INPUTS)):
            if name not in found:
                visit(INPUTS[name])
                found.append(name)

    visit(text)
    return found


def with_inputs(text: str) -> str:
    """DuckDB SQL: the text with the inputs it uses defined in front of it."""
    parts = [f"{name} AS ({INPUTS[name]})" for name in _needed(text)]
    body = f"WITH {', '.join(parts)}\n{text}" if parts else text
    return _EACH.sub(lambda m: f"unnest(range({m.group(1)}))", body)


class Inputs:
    """The inputs as Spark frames over the parquet files of one folder; nothing is read until used."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}.parquet"

    def given(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def dealt(self, table: str) -> DataFrame:
        """A given table, dealt to as many tasks as its size calls for once its rows are repeated."""
        rows = self.given(table)
        if table not in REPEATED:
            return rows
        shares = -(-input_bytes(self.spark, [self.path(table)]) // SHARE_BYTES)
        return rows.repartition(shares) if shares > 1 else rows

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            text = INPUTS[name]
            uses = sorted(set(_NAME.findall(text)) & set(INPUTS))
            frames = {u: self[u] for u in uses}
            frames.update({g: self.dealt(g) for g in GIVEN if re.search(rf"\b(FROM|JOIN) {g}\b", text)})
            spark_text = _EACH.sub(lambda m: f"explode(sequence(0, {int(m.group(1)) - 1}))", text)
            spark_text = spark_text.replace("{", "{{").replace("}", "}}")
            for name_used in frames:
                spark_text = re.sub(rf"\b(FROM|JOIN) {name_used}\b", rf"\1 {{{name_used}}}", spark_text)
            self._frames[name] = self.spark.sql(spark_text, **frames)
        return self._frames[name]
