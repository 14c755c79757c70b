"""The registered queries as SQL for DuckDB, written from the definitions and not from the plans."""

from __future__ import annotations

from martloom.catalog.inputs import GIVEN, with_inputs
from martloom.plans import columns as C

RUN_TS = "2024-01-02 03:04:05"
AUDIT = f"""'Y' AS is_active, '{RUN_TS}' AS created_ts, '{RUN_TS}' AS updated_ts,
CAST(77 AS BIGINT) AS created_by_job_exec_id, CAST(77 AS BIGINT) AS updated_by_job_exec_id"""
SINCE = "DATE '2021-06-01'"
AS_OF = "DATE '2021-06-01'"
FAR = "DATE '9999-12-31'"
AFTER, BETWEEN, UNTIL = "1996-01-01T00:00:00.000Z", "1998-03-01T00:00:00.000Z", "2000-06-30T00:00:00.000Z"


def plain(body: str, as_text: str) -> str:
    replaced = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in as_text.split())
    return f"SELECT * REPLACE ({replaced}) FROM ({body}) plain_rows"


# Shared pieces.

BRIDGE = f"""(
  SELECT p.prod_id, g.prod_grp_id, g.grp_prps_cd, l.end_dt,
         MAX(COALESCE(l.cease_pblsh_dt, {FAR})) AS cease_pblsh_dt, MAX(l.lst_pblsh_dt) AS lst_pblsh_dt
  FROM in_prod p JOIN in_links l ON l.prod_child_id = p.prod_id JOIN in_groups g ON g.prod_grp_id = l.prod_grp_prnt_id
  GROUP BY ALL)"""


def published(table: str, key: str = "prod_id, cntry_cd") -> str:
    return f"(SELECT {key}, MAX(lst_pblsh_dt) AS lst_pblsh_dt FROM {table} GROUP BY ALL)"


def parents(purpose: str, country: bool) -> str:
    return f"""(
  SELECT DISTINCT l.prod_grp_id_child, l.prod_grp_id_prnt, up.grp_prps_cd{', l.cntry_cd' if country else ''}
  FROM in_group_links l
  JOIN in_groups down ON down.prod_grp_id = l.prod_grp_id_child AND down.grp_prps_cd = 'STGH'
  JOIN in_groups up ON up.prod_grp_id = l.prod_grp_id_prnt AND up.grp_prps_cd = '{purpose}')"""


MASTER = ", ".join(f"p.{c}" for c in C.PRODUCT_MASTER)

SAMPLE = f"""
SELECT {MASTER}, b.prod_grp_id AS prod_grp_prnt_id, a.cntry_cd, b.grp_prps_cd,
       b.end_dt AS end_dt_prod_grp_prod, b.cease_pblsh_dt AS cease_pblsh_dt_prod_grp_prod
FROM in_prod p
JOIN {BRIDGE} b USING (prod_id)
JOIN {published('in_alternates')} a USING (prod_id)
JOIN {published('in_translations')} t ON t.prod_id = p.prod_id AND t.cntry_cd = a.cntry_cd
WHERE p.prod_typ IN ('SAMPLE', 'EDUCATIONAL') AND b.grp_prps_cd = 'BRND'
  AND (p.lst_pblsh_dt > {SINCE} OR b.lst_pblsh_dt > {SINCE} OR a.lst_pblsh_dt > {SINCE} OR t.lst_pblsh_dt > {SINCE})"""

MARKET = f"""
SELECT {MASTER}, s.prod_grp_id_prnt AS prod_grp_prnt_id, a.cntry_cd, s.grp_prps_cd,
       b.end_dt AS end_dt_prod_grp_prod, b.cease_pblsh_dt AS cease_pblsh_dt_prod_grp_prod
FROM in_prod p
JOIN {BRIDGE} b USING (prod_id)
JOIN {published('in_alternates')} a USING (prod_id)
JOIN {published('in_translations')} t ON t.prod_id = p.prod_id AND t.cntry_cd = a.cntry_cd
JOIN {parents('MKTP', True)} s ON s.prod_grp_id_child = b.prod_grp_id AND s.cntry_cd = a.cntry_cd
WHERE p.prod_typ IN ('COMPETITOR', 'OWN')
  AND (p.lst_pblsh_dt > {SINCE} OR b.lst_pblsh_dt > {SINCE} OR a.lst_pblsh_dt > {SINCE} OR t.lst_pblsh_dt > {SINCE})"""

BRAND = f"""
SELECT {MASTER}, s.prod_grp_id_prnt AS prod_grp_prnt_id, t.cntry_cd, s.grp_prps_cd,
       b.end_dt AS end_dt_prod_grp_prod, b.cease_pblsh_dt AS cease_pblsh_dt_prod_grp_prod
FROM in_prod p
JOIN {BRIDGE} b USING (prod_id)
JOIN {published('in_translations')} t USING (prod_id)
JOIN {parents('BRND', False)} s ON s.prod_grp_id_child = b.prod_grp_id
JOIN (SELECT x.prod_grp_id, x.cntry_cd, x.dialect_nm, MAX(x.lst_pblsh_dt) AS lst_pblsh_dt
      FROM in_group_translations x JOIN in_groups y ON y.prod_grp_id = x.prod_grp_id AND y.grp_prps_cd = 'BRND'
      GROUP BY ALL) g ON g.prod_grp_id = s.prod_grp_id_prnt AND g.cntry_cd = t.cntry_cd
JOIN in_params m ON m.cntry_cd = t.cntry_cd AND m.grp_prps_cd = s.grp_prps_cd
JOIN in_group_translations d
  ON d.prod_grp_id = s.prod_grp_id_prnt AND d.cntry_cd = t.cntry_cd AND d.dialect_nm = m.dialect_nm
WHERE p.prod_typ IN ('COMPETITOR', 'OWN')
  AND (p.lst_pblsh_dt > {SINCE} OR b.lst_pblsh_dt > {SINCE} OR g.lst_pblsh_dt > {SINCE} OR t.lst_pblsh_dt > {SINCE})"""

FEED = f"({SAMPLE} UNION ALL {MARKET} UNION ALL {BRAND})"
FEED_DATES = """start_dt end_dt crt_dt updt_dt lst_lot_exprtn_dt lst_pblsh_dt cease_pblsh_dt end_dt_prod_grp_prod
cease_pblsh_dt_prod_grp_prod"""
FEED_KEYS = "f.prod_id, f.prod_grp_prnt_id, f.grp_prps_cd, f.cntry_cd"

LOOKED_UP = f"""(
  SELECT f.*, m.dialect_nm, m.recordtype, t.trnsltd_dsply_nm, t.trnsltd_prod_desc_txt, r.sfdc_id AS sfdc_id_prod_grp,
         a.altrnt_id, a.altrnt_id_type_cd AS altrnt_id_type_cd__c,
         t.start_dt AS t_start, t.end_dt AS t_end, t.cease_pblsh_dt AS t_cease,
         a.start_dt AS a_start, a.end_dt AS a_end, a.cease_pblsh_dt AS a_cease,
         g.end_dt AS g_end, g.cease_pblsh_dt AS g_cease
  FROM {FEED} f
  JOIN in_params m ON m.grp_prps_cd = f.grp_prps_cd AND m.cntry_cd = f.cntry_cd
  LEFT JOIN in_translations t ON t.prod_id = f.prod_id AND t.cntry_cd = f.cntry_cd AND t.dialect_nm = m.dialect_nm
  LEFT JOIN in_replicated_groups r ON r.prod_grp_id = f.prod_grp_prnt_id AND r.cntry_cd = f.cntry_cd
  LEFT JOIN in_group_translations g
    ON g.prod_grp_id = f.prod_grp_prnt_id AND g.cntry_cd = f.cntry_cd AND g.dialect_nm = m.dialect_nm
  LEFT JOIN in_alternates a
    ON a.prod_id = f.prod_id AND a.cntry_cd = f.cntry_cd AND a.altrnt_id_type_cd = m.altrnt_id_type_cd)"""

RECONCILED = f"""(
  SELECT * REPLACE (
           GREATEST(start_dt, t_start, a_start) AS start_dt,
           CASE WHEN grp_prps_cd = 'BRND' THEN LEAST(end_dt, t_end, end_dt_prod_grp_prod, g_end)
                ELSE LEAST(end_dt, t_end, end_dt_prod_grp_prod, a_end) END AS end_dt,
           LEAST(COALESCE(cease_pblsh_dt, {FAR}), COALESCE(t_cease, {FAR}), COALESCE(cease_pblsh_dt_prod_grp_prod, {FAR}),
                 COALESCE(CASE WHEN grp_prps_cd = 'BRND' THEN g_cease ELSE a_cease END, {FAR})) AS cease_pblsh_dt),
         grp_prps_cd || CAST(prod_grp_prnt_id AS VARCHAR) || CAST(prod_id AS VARCHAR) || cntry_cd
           || COALESCE(altrnt_id_type_cd__c, '') AS product_external_id
  FROM {LOOKED_UP} looked_up)"""

PICKED = f"""(
  SELECT * FROM (
    SELECT c.*, r.product_external_id AS replicated_id,
           ROW_NUMBER() OVER (
             PARTITION BY c.product_external_id, r.product_external_id
             ORDER BY (c.altrnt_id IS NULL OR c.sfdc_id_prod_grp IS NULL
                       OR (c.trnsltd_dsply_nm IS NULL AND c.trnsltd_prod_desc_txt IS NULL)),
                      c.sfdc_id_prod_grp NULLS FIRST, c.altrnt_id NULLS FIRST, c.trnsltd_dsply_nm NULLS FIRST,
                      c.trnsltd_prod_desc_txt NULLS FIRST, c.start_dt NULLS FIRST, c.end_dt NULLS FIRST,
                      c.cease_pblsh_dt NULLS FIRST) AS position
    FROM {RECONCILED} c
    LEFT JOIN in_replicated_products r
      ON r.prod_id = c.prod_id AND r.cntry_cd = c.cntry_cd AND r.product_external_id = c.product_external_id) n
  WHERE position = 1
    AND (replicated_id IS NOT NULL OR (end_dt >= {AS_OF} AND (cease_pblsh_dt IS NULL OR cease_pblsh_dt >= {AS_OF})))
    AND altrnt_id IS NOT NULL AND (trnsltd_dsply_nm IS NOT NULL OR trnsltd_prod_desc_txt IS NOT NULL)
    AND sfdc_id_prod_grp IS NOT NULL)"""

GROUP_COUNTRY = """(
  SELECT s.prod_grp_id AS prod_grp_prnt_id, s.src_cd, s.grp_nm, s.grp_abbr_nm, s.prod_grp_desc_txt, s.grp_prps_cd,
         s.grp_cnvrsn_unit_cd, s.start_dt, s.end_dt, s.crt_dt, s.updt_dt, s.lst_pblsh_dt, s.cease_pblsh_dt, s.cntry_cd,
         COALESCE(t.dialect_nm, 'EN') AS dialect_nm, t.trnsltd_grp_nm, s.prod_grp_typ AS prod_grp_typ_cd,
         d.dialect AS wanted_dialect, t.end_dt AS translation_end
  FROM in_group_source s
  LEFT JOIN in_dialects d ON d.country_code = s.cntry_cd
  LEFT JOIN in_source_translations t
    ON t.prod_grp_id = s.prod_grp_id AND t.cntry_cd = s.cntry_cd AND t.dialect_nm = d.dialect
  WHERE s.cntry_cd <> 'ZZ')"""

GROUP_COLUMNS = ", ".join(C.GROUP_ROW)
CLIPPED = "CASE WHEN translation_end < end_dt THEN translation_end ELSE end_dt END"
COUNTRY_ROWS = f"""(
  SELECT * EXCLUDE (wanted_dialect, translation_end) REPLACE ({CLIPPED} AS end_dt) FROM {GROUP_COUNTRY} c
  WHERE dialect_nm = wanted_dialect)"""
GLOBAL_ROWS = """(
  SELECT s.prod_grp_id AS prod_grp_prnt_id, s.src_cd, s.grp_nm, s.grp_abbr_nm, s.prod_grp_desc_txt, s.grp_prps_cd,
         s.grp_cnvrsn_unit_cd, s.start_dt, s.end_dt, s.crt_dt, s.updt_dt, s.lst_pblsh_dt, s.cease_pblsh_dt, s.cntry_cd,
         'EN' AS dialect_nm, t.trnsltd_grp_nm, s.prod_grp_typ AS prod_grp_typ_cd
  FROM in_group_source s
  LEFT JOIN in_source_translations t ON t.prod_grp_id = s.prod_grp_id AND t.cntry_cd = 'US' AND t.dialect_nm = 'EN'
  WHERE s.cntry_cd = 'ZZ')"""


def first_row(table: str, keys: str, order: str, columns: list[str], maximum: str | None = None) -> str:
    """The first row per key; optionally with the maximum of one column over the key."""
    listed = [*order.split(), *[c for c in columns if c not in keys.split() and c not in order.split() and c != maximum]]
    ordering = ", ".join(f"{c} NULLS FIRST" for c in listed)
    by = ", ".join(keys.split())
    values = ", ".join(f"MAX({c}) OVER (PARTITION BY {by}) AS {c}" if c == maximum else c for c in columns)
    return f"""(
  SELECT * EXCLUDE (position) FROM (
    SELECT {values}, ROW_NUMBER() OVER (PARTITION BY {by} ORDER BY {ordering}) AS position FROM {table} r) n
  WHERE position = 1)"""


SYNTHESISED = f"""(
  SELECT * REPLACE ('ZZ' AS cntry_cd, 'EN' AS dialect_nm)
  FROM {first_row(GROUP_COUNTRY, "prod_grp_prnt_id prod_grp_typ_cd", "cntry_cd dialect_nm start_dt", C.GROUP_ROW, "end_dt")} s)"""


def class_filter(kind: str) -> str:
    return f"""(REPLACE({kind}, '''', '') IN ('OWN', 'COMBO', 'COLLABORATOR')
  OR (REPLACE({kind}, '''', '') = 'COMPETITOR' AND cntry_cd <> 'ZZ') OR ({kind} IS NULL AND cntry_cd <> 'ZZ'))"""


GROUP_UNION = f"""(
  SELECT * FROM (SELECT {GROUP_COLUMNS} FROM {GLOBAL_ROWS} a UNION ALL SELECT {GROUP_COLUMNS} FROM {SYNTHESISED} b
                 UNION ALL SELECT {GROUP_COLUMNS} FROM {COUNTRY_ROWS} c) u
  WHERE {class_filter('prod_grp_typ_cd')})"""
GROUP_UNIQUE = first_row(GROUP_UNION, "prod_grp_prnt_id cntry_cd", "dialect_nm start_dt", C.GROUP_ROW, "end_dt")
GROUP_DATES = "start_dt end_dt crt_dt updt_dt lst_pblsh_dt cease_pblsh_dt"

INDICATION_ROWS = """(
  SELECT s.*, d.dialect AS dialect_nm, t.trnsltd_indctn_desc_txt, t.trnsltd_indctn_short_desc
  FROM in_indication s
  LEFT JOIN in_dialects d ON d.country_code = s.cntry_cd
  LEFT JOIN in_indication_translations t ON t.indctn_id = s.indctn_id AND t.dialect_nm = d.dialect
  WHERE d.dialect IS NOT NULL AND t.trnsltd_indctn_desc_txt IS NOT NULL)"""
INDICATION_MAXIMA = [
    *[c for c in C.INDICATION_SOURCE if c not in ("prod_grp_id", "indctn_id", "cntry_cd", "prod_grp_typ")],
    "trnsltd_indctn_desc_txt",
    "trnsltd_indctn_short_desc",
]
INDICATION_GLOBAL = f"""(
  SELECT m.*, g.sfdc_id AS prod_grp_prnt_id_glbl_sfdc_id FROM (
    SELECT prod_grp_id, indctn_id, 'ZZ' AS cntry_cd, 'EN' AS dialect_nm,
           CAST(prod_grp_id AS VARCHAR) || indctn_id || 'ZZ' AS indctn_ext_id_glbl__c,
           {", ".join(f"MAX({c}) AS {c}" for c in INDICATION_MAXIMA)}
    FROM {INDICATION_ROWS} r WHERE REPLACE(prod_grp_typ, '''', '') = 'OWN' GROUP BY prod_grp_id, indctn_id) m
  LEFT JOIN in_indication_groups g ON g.prod_grp_external_id = CAST(m.prod_grp_id AS VARCHAR) || 'ZZ')"""
INDICATION_COUNTRY = f"""(
  SELECT r.*, CAST(r.prod_grp_id AS VARCHAR) || r.indctn_id || r.cntry_cd AS indctn_ext_id_glbl__c,
         CASE WHEN g1.sfdc_id IS NOT NULL THEN g1.sfdc_id ELSE g2.sfdc_id END AS prod_grp_prnt_id_glbl_sfdc_id
  FROM (SELECT *, MAX(end_dt) OVER (PARTITION BY prod_grp_id, indctn_id, cntry_cd) AS newest FROM {INDICATION_ROWS} x) r
  LEFT JOIN in_indication_groups g1 ON g1.prod_grp_external_id = CAST(r.prod_grp_id AS VARCHAR) || r.cntry_cd
  LEFT JOIN in_indication_groups g2 ON g2.prod_grp_external_id = CAST(r.prod_grp_id AS VARCHAR) || 'ZZ'
  WHERE r.end_dt = r.newest)"""
INDICATION_STAGED = ", ".join(f"{old} AS {new}" for old, new in C.STAGED_INDICATION.items())
INDICATION_DATES = """approval_dt_glbl__c revoke_dt_glbl__c start_dt_glbl__c end_dt_glbl__c crt_dt_glbl__c updt_dt_glbl__c
lst_pblsh_dt_glbl__c cease_pblsh_dt_glbl__c"""

IN_WINDOW = f"""Participant_ToV_Updated_Date_MERC__c > '{AFTER}' AND Participant_ToV_Updated_Date_MERC__c <= '{UNTIL}'"""
ATTENDING = "Participant_Typ_MERC__c = 'HCP' AND Status_MERC__c IN ('Attended', 'No Show')"
EVENT_STAGE = f"""(
  SELECT DISTINCT Event_Id_MERC__c AS event_id_merc__c, Event_Country_MERC__c AS event_country_merc__c,
         CAST(SUBSTR(Date_of_Event_MERC__c, 1, 10) AS DATE) AS date_of_event_merc__c,
         Owner_Master_Id_MERC__c AS owner_master_id_merc__c, Name AS name
  FROM in_meeting
  WHERE {IN_WINDOW} AND Participant_ToV_Final_MERC__c = 'Yes'
    AND Event_Country_MERC__c IS NOT NULL AND Event_Country_MERC__c NOT IN ('C3', 'C7'))"""
ATTENDEE_STAGE = f"""(
  SELECT DISTINCT m.Event_Id_MERC__c AS event_id_merc__c, p.Id AS id, p.Id AS meeting_participant_id_merc__c,
         p.Customer_Id_GLBL__c AS customer_id_glbl__c, a.Name AS name_glbl__c, p.ToV_Currency_MERC__c AS currencyisocode,
         {", ".join(f"TRY_CAST(p.{old} AS DECIMAL(16,2)) AS {new}" for old, new in C.ATTENDEE_AMOUNTS.items())},
         p.Record_Type_Name_MERC__c AS record_type_name__c
  FROM in_participant p LEFT JOIN in_meeting m ON p.Meeting_MERC__c = m.Id LEFT JOIN in_account a ON p.Account_MERC__c = a.Id
  WHERE {ATTENDING} AND {IN_WINDOW} AND m.Participant_ToV_Final_MERC__c = 'Yes'
    AND m.Event_Country_MERC__c IS NOT NULL AND m.Event_Country_MERC__c <> '')"""
VALUE_STAGE = f"""(
  SELECT DISTINCT NULLIF(v.Meeting_Participant_MERC__c, '') AS meeting_participant_merc__c,
         CAST(v.Meeting_Day_Date_MERC__c AS DATE) AS meeting_day_date_merc__c, NULLIF(v.CurrencyIsoCode, '') AS currencyisocode,
         {", ".join(f"TRY_CAST(NULLIF(v.{old}, '') AS DECIMAL(16,2)) AS {new}" for old, new in C.DAY_AMOUNTS.items())},
         NULLIF(v.Id, '') AS id
  FROM in_day_value v LEFT JOIN in_participant p ON v.Meeting_Participant_MERC__c = p.Id
       LEFT JOIN in_meeting m ON p.Meeting_MERC__c = m.Id
  WHERE {ATTENDING} AND {IN_WINDOW} AND m.Participant_ToV_Final_MERC__c = 'Yes'
    AND m.Event_Country_MERC__c IS NOT NULL AND m.Event_Country_MERC__c NOT IN ('C3', 'C7'))"""
SPEND_JOIN = f"""(
  SELECT e.*, a.event_id_merc__c AS event_id_merc__c1, a.id AS id1,
         a.customer_id_glbl__c, a.name_glbl__c, a.record_type_name__c, a.currencyisocode,
         {", ".join(f"a.{c}" for c in C.ATTENDEE_AMOUNTS.values())},
         v.id, v.meeting_participant_merc__c AS meeting_participant_merc__c1, v.meeting_day_date_merc__c,
         v.currencyisocode AS currencyisocode_tov, {", ".join(f"v.{c}" for c in C.DAY_AMOUNTS.values())}
  FROM {EVENT_STAGE} e JOIN {ATTENDEE_STAGE} a ON a.event_id_merc__c = e.event_id_merc__c
  LEFT JOIN {VALUE_STAGE} v ON v.meeting_participant_merc__c = a.meeting_participant_id_merc__c)"""
MONEY = " ".join([*C.ATTENDEE_AMOUNTS.values(), *C.DAY_AMOUNTS.values()])

SPONSORED = "upper(record_type_name__c) = 'MERC_INDIVIDUAL_SPONSORSHIP'"


def _by_kind(for_sponsorship: str, otherwise: str) -> str:
    return f"CASE WHEN {SPONSORED} THEN {for_sponsorship} ELSE {otherwise} END"


def _midnight(column: str) -> str:
    return f"strftime({column}, '%d%m%Y') || '000000'"


def _value_line(amount: str, kind: str, purpose: str, detail: str, suffix: str) -> str:
    copay = kind.endswith("Co Pay")
    owner = "id1" if copay else _by_kind("id1", "id")
    currency = "currencyisocode" if copay else _by_kind("currencyisocode", "currencyisocode_tov")
    return f"""
    SELECT event_id_merc__c AS event_id_mercury__c, event_country_merc__c, {_midnight('date_of_event_merc__c')} AS date_of_evnt_merc__c,
           SUBSTR(LPAD(owner_master_id_merc__c, GREATEST(8, length(owner_master_id_merc__c))::INT, '0'), 1, 8) AS owner_master_id_merc__c,
           name AS event_desc, id1 AS meeting_participant_id_merc__c, customer_id_glbl__c AS customer_id_global__c,
           name_glbl__c AS name_global__c, record_type_name__c AS record_type,
           {_by_kind(_midnight('date_of_event_merc__c'), _midnight('meeting_day_date_merc__c'))} AS valuepaiddt,
           {currency} AS currencyisocode, {amount} AS value_amount, '{purpose}' AS val_typ_prps_cd, '{kind}' AS val_typ_cd,
           {owner} || '{suffix}' AS value_id, '{detail}' AS value_purpose_secondary_cd
    FROM joined WHERE {amount} IS NOT NULL"""


COPAY, VALUE = "Transfer of Value Co Pay", "Transfer of Value"
VALUE_LINES = f"""(
  WITH joined AS (SELECT * FROM {SPEND_JOIN} j)
  SELECT DISTINCT * FROM ({" UNION ALL ".join([
    _value_line("copay_hotel_merc__c", COPAY, "Lodging", "Hotel", "_COPAY_HTL"),
    _value_line("copay_ground_transport_merc__c", COPAY, "Transportation", "Ground Transportation", "_COPAY_GRND_TRNSPRT"),
    _value_line("copay_food_beverage_merc__c", COPAY, "Food and Beverage", "Food and Beverage", "_COPAY_FOOD_BVRG"),
    _value_line("copay_registration_merc__c", COPAY, "Registration Fee", "Registration Fee", "_COPAY_RGSTRN_FEE"),
    _value_line("copay_flight_rail_merc__c", COPAY, "Transportation", "Rail/Flight Transportation", "_COPAY_RAIL_FLGHT_TRNSPRT"),
    _value_line(_by_kind("total_hotel_tov_merc__c", "est_hotel_tov_merc__c"), VALUE, "Lodging", "Hotel", "_HTL"),
    _value_line(_by_kind("total_ground_trnsprtn_tov_merc", "est_grnd_transp_merc__c"), VALUE, "Transportation", "Ground Transportation", "_GRND_TRNSPRT"),
    _value_line(_by_kind("total_registration_tov_merc__c", "est_reg_amt_tov_merc__c"), VALUE, "Registration Fee", "Registration Fee", "_RGSTRN_FEE"),
    _value_line(_by_kind("total_food_beverage_tov_merc", "est_food_bev_tov_merc__c"), VALUE, "Food and Beverage", "Food and Beverage", "_FOOD_BVRG"),
    _value_line(_by_kind("total_indiv_trans_tov_merc__c", "est_indv_transfer_merc__c"), VALUE, "Transportation", "Private Transfer", "_INDV_GRND_TRNSPRT"),
    _value_line("copay_aods_indiv_trans_merc__c", COPAY, "Transportation", "Private Transfer", "_COPAY_INDV_GRND_TRNSPRT"),
  ])}) u)"""
SPEND_EXPORT = f"""
SELECT DISTINCT 'COMPANY' AS "CompanyCd", 'SOURCE' AS "SrcSysCd", event_country_merc__c AS "CountryCd", 'MEETINGSPEND' AS "SrcSysTypeCd",
       meeting_participant_id_merc__c AS "EventId", date_of_evnt_merc__c AS "EventStartDt", 'Meeting TOV' AS "EventTypeCd",
       event_desc AS "EventDesc", event_id_mercury__c AS "EventParentId", 'COMPANY' AS "EventParentCompanyCD",
       'EVENTS' AS "EventParentSrcSysCd", event_country_merc__c AS "EventParentCountryCd", 'Submitted' AS "EventStatusCd",
       owner_master_id_merc__c AS "EventCreatedById", meeting_participant_id_merc__c AS "EventValueCustomerId",
       'Recipient' AS "EventValueCustomerEventRole", 'Attended' AS "EventValueCustomerStatusCd", 'HCP' AS "EventCustomerTypeCd",
       customer_id_global__c AS "EventCustomerInternalId", name_global__c AS "EventCustomerNm", value_id AS "ValueId",
       val_typ_cd AS "ValueTypeCode", val_typ_prps_cd AS "ValuePurposeCd", value_purpose_secondary_cd AS "ValuePurposeSecondaryCd",
       valuepaiddt AS "ValuePaidDt", CAST(value_amount AS VARCHAR) AS "ValueAmount", currencyisocode AS "ValueCurrencyCD"
FROM {VALUE_LINES} v"""


def clamp(column: str) -> str:
    return f"CASE WHEN {column} >= DATE '3999-01-01' THEN DATE '4000-12-31' ELSE {column} END"


def marked(expression: str) -> str:
    return f"COALESCE(NULLIF(CAST({expression} AS VARCHAR), ''), '#N/A')"


def _product_export_column(column: str) -> str:
    expression = clamp(column) if column in C.EXPORT_PRODUCT_CLAMPED else column
    if column in C.EXPORT_PRODUCT_DATES:
        expression = f"strftime({expression}, '%Y-%m-%d')"
    if column in C.EXPORT_PRODUCT_MARKED:
        expression = marked(expression)
    return f'{expression} AS "{C.EXPORT_PRODUCT_NAMES[column]}"'


def _group_export_column(column: str) -> str:
    exported = C.EXPORT_GROUP_NAMES[column]
    expression = clamp(column) if column in C.EXPORT_GROUP_CLAMPED else column
    if column in C.EXPORT_GROUP_INSTANTS:
        expression = f"strftime({expression}, '%Y-%m-%dT00:00:00.000Z')"
    if exported in C.EXPORT_GROUP_MARKED:
        expression = marked(expression)
    return f'CAST({expression} AS VARCHAR) AS "{exported}"'


EXPORT_GROUP = f"""
SELECT {", ".join(_group_export_column(c) for c in C.EXPORT_GROUP_NAMES)}, name AS "Name1",
       SUBSTR(CASE WHEN cntry_cd_glbl__c = 'ZZ' OR trnsltd_grp_nm_glbl__c IS NULL THEN name ELSE trnsltd_grp_nm_glbl__c END, 1, 80) AS "Name"
FROM in_export_group"""


def _indication_export_column(exported: str, column: str) -> str:
    expression = f"CAST({clamp(column) if exported in C.EXPORT_INDICATION_CLAMPED else column} AS VARCHAR)"
    if exported in C.EXPORT_INDICATION_MARKED:
        expression = marked(expression)
    if exported == "Name":
        expression = f"SUBSTR({expression}, 1, 80)"
    return f'{expression} AS "{exported}"'


HISTORY = """(
  SELECT k, payload, is_active, CAST(created_day AS VARCHAR) || ' 00:00:00' AS created_ts,
         CAST(created_day AS VARCHAR) || ' 00:00:00' AS updated_ts,
         exec_id AS created_by_job_exec_id, exec_id AS updated_by_job_exec_id
  FROM in_history)"""


def closed(stamp: bool) -> str:
    hit = "is_active = 'Y' AND k IN (SELECT k FROM in_stage)"
    by = f"CASE WHEN {hit} THEN CAST(77 AS BIGINT) ELSE updated_by_job_exec_id END" if stamp else "updated_by_job_exec_id"
    return f"""(
  SELECT k, payload, CASE WHEN {hit} THEN 'N' ELSE is_active END AS is_active, created_ts,
         CASE WHEN {hit} THEN '{RUN_TS}' ELSE updated_ts END AS updated_ts, created_by_job_exec_id, {by} AS updated_by_job_exec_id
  FROM {HISTORY} h)"""


NEXT_TS = "2024-01-03 03:04:05"
WINDOWED = "SELECT Owner_Master_Id_MERC__c AS owner_id, Id AS meeting_id FROM in_meeting WHERE Participant_ToV_Updated_Date_MERC__c"

BODIES: dict[str, str] = {}

BODIES["typed_scan"] = """
SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate, l_orderkey, CAST(l_partkey AS INTEGER) AS l_partkey,
       CAST(l_linenumber AS SMALLINT) AS l_linenumber, l_quantity,
       CASE WHEN l_returnflag = 'R' THEN NULL
            ELSE CAST(CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS DECIMAL(14,6)) AS VARCHAR) END AS l_extendedprice,
       l_returnflag, CAST(NULL AS VARCHAR) AS l_comment
FROM lineitem"""
BODIES["landing_json"] = "SELECT event_id, user_id, event_type, value FROM events"
BODIES["stream_landing"] = BODIES["landing_json"]
BODIES["template_params"] = plain(
    f"SELECT prod_id, prod_nm, prod_typ, lst_pblsh_dt FROM in_prod WHERE lst_pblsh_dt > {SINCE} AND prod_typ IN ('COMPETITOR', 'OWN')",
    "lst_pblsh_dt",
)
BODIES["stage_snapshot"] = "SELECT k, payload FROM in_stage"
BODIES["bulk_replicate"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows, COUNT(*) AS n_reported FROM {t}" for t in GIVEN
)
BODIES["replicated_rows"] = """
SELECT c_custkey AS k, c_name AS name, c_acctbal AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier"""
BODIES["id_writeback_product"] = """
SELECT Id AS sfdc_id, Prod_id__c AS prod_id_glbl__c, Product_External_ID__c AS product_external_id__c, Cntry_Cd__c AS cntry_cd_glbl__c
FROM in_landed_product_ids"""
BODIES["id_writeback_group"] = """
SELECT Id AS sfdc_id, Product_Group_External_ID_GLBL__c AS prod_grp_external_id_glbl__c, Cntry_Cd_GLBL__c AS cntry_cd_glbl__c,
       TRY_CAST(Product_Group_Id_GLBL__c AS DOUBLE) AS prod_grp_id_glbl__c
FROM in_landed_group_ids"""
BODIES["export_csv_roundtrip"] = EXPORT_GROUP
BODIES["export_tsv_roundtrip"] = SPEND_EXPORT
BODIES["export_single_file"] = EXPORT_GROUP

BODIES["audit_stamp"] = f"SELECT k, payload, {AUDIT} FROM in_stage"
BODIES["incremental_window"] = f"""
SELECT Id, Participant_ToV_Updated_Date_MERC__c AS updated, mode
FROM in_meeting, (VALUES ('instant'), ('text')) v(mode) WHERE {IN_WINDOW}"""
BODIES["changed_since"] = plain(
    f"""SELECT prod_id, prod_grp_prnt_id, p.lst_pblsh_dt, l.lst_pblsh_dt AS link_pblsh_dt
    FROM in_prod p JOIN in_links l ON prod_child_id = prod_id WHERE p.lst_pblsh_dt > {SINCE} OR l.lst_pblsh_dt > {SINCE}""",
    "lst_pblsh_dt link_pblsh_dt",
)
BODIES["route_split"] = plain(
    """SELECT prod_grp_id, cntry_cd, start_dt, CASE cntry_cd WHEN 'ZZ' THEN 'global' ELSE 'country' END AS branch
    FROM in_group_source WHERE cntry_cd IS NOT NULL""",
    "start_dt",
)
BODIES["group_class_filter"] = plain(
    f"""SELECT prod_grp_id, cntry_cd, start_dt, prod_grp_typ AS prod_grp_typ_cd FROM in_group_source
    WHERE {class_filter('prod_grp_typ')}""",
    "start_dt",
)
BODIES["cond_min"] = plain(
    f"""SELECT prod_grp_prnt_id, cntry_cd, prod_grp_desc_txt, end_dt, translation_end, {CLIPPED} AS clipped
    FROM {GROUP_COUNTRY} c""",
    "end_dt translation_end clipped",
)
BODIES["date_clamp"] = plain(
    f"SELECT prod_id__c, {', '.join(f'{clamp(c)} AS {c}' for c in C.EXPORT_PRODUCT_CLAMPED)} FROM in_export_product",
    " ".join(C.EXPORT_PRODUCT_CLAMPED),
)
BODIES["null_marker"] = (
    f"SELECT prod_id__c, {', '.join(f'{marked(c)} AS {c}' for c in C.EXPORT_PRODUCT_MARKED)} FROM in_export_product"
)
BODIES["external_id"] = f"""
SELECT {FEED_KEYS}, grp_prps_cd || CAST(prod_grp_prnt_id AS VARCHAR) || CAST(prod_id AS VARCHAR) || cntry_cd
         || COALESCE(altrnt_id_type_cd__c, '') AS joined_id,
       CAST(prod_grp_prnt_id AS VARCHAR) || altrnt_id_type_cd__c || cntry_cd AS strict_id
FROM {LOOKED_UP} f"""
BODIES["date_reconcile"] = plain(
    f"SELECT {FEED_KEYS}, start_dt, end_dt, cease_pblsh_dt FROM {RECONCILED} f", "start_dt end_dt cease_pblsh_dt"
)
BODIES["product_eligibility"] = plain(
    f"SELECT product_external_id, replicated_id, end_dt, cease_pblsh_dt FROM {PICKED} c", "end_dt cease_pblsh_dt"
)

BODIES["lookup_left"] = """
SELECT t.prod_id, t.cntry_cd, t.dialect_nm, a.altrnt_id, a.altrnt_id_type_cd AS id_type
FROM in_translations t LEFT JOIN in_alternates a ON a.prod_id = t.prod_id AND a.cntry_cd = t.cntry_cd"""
BODIES["lookup_fallback"] = plain(
    """SELECT s.prod_grp_id, s.indctn_id, s.cntry_cd, s.start_dt, COALESCE(g1.sfdc_id, g2.sfdc_id) AS group_sfdc_id
    FROM in_indication s
    LEFT JOIN in_indication_groups g1 ON g1.prod_grp_external_id = CAST(s.prod_grp_id AS VARCHAR) || s.cntry_cd
    LEFT JOIN in_indication_groups g2 ON g2.prod_grp_external_id = CAST(s.prod_grp_id AS VARCHAR) || 'ZZ'""",
    "start_dt",
)
BODIES["param_expand"] = f"""
SELECT {FEED_KEYS}, m.dialect_nm, m.altrnt_id_type_cd AS id_type, m.recordtype
FROM {FEED} f JOIN in_params m ON m.grp_prps_cd = f.grp_prps_cd AND m.cntry_cd = f.cntry_cd"""
BODIES["group_parent"] = f"""
SELECT prod_grp_id_child, prod_grp_id_prnt, grp_prps_cd, cntry_cd FROM {parents('MKTP', True)} a
UNION ALL SELECT prod_grp_id_child, prod_grp_id_prnt, grp_prps_cd, 'any' FROM {parents('BRND', False)} b"""

BODIES["bridge_max"] = plain(f"SELECT * FROM {BRIDGE} b", "end_dt cease_pblsh_dt lst_pblsh_dt")
BODIES["max_by_country"] = plain(
    f"""SELECT *, 'alternates' AS source FROM {published('in_alternates')} a
    UNION ALL SELECT *, 'translations' FROM {published('in_translations')} t""",
    "lst_pblsh_dt",
)
BODIES["first_per_key"] = plain(
    f"SELECT * FROM {first_row('in_group_source', 'prod_grp_id cntry_cd', 'start_dt', C.GROUP_SOURCE)} f", GROUP_DATES
)
BODIES["latest_end"] = plain(
    """SELECT prod_grp_id, indctn_id, cntry_cd, end_dt, start_dt, indctn_desc
    FROM (SELECT *, MAX(end_dt) OVER (PARTITION BY prod_grp_id, indctn_id, cntry_cd) AS newest FROM in_indication) n
    WHERE end_dt = newest""",
    "end_dt start_dt",
)
BODIES["dedup_rows"] = plain(
    "SELECT DISTINCT * FROM in_indication",
    "apprvl_dt revoke_dt start_dt end_dt crt_dt updt_dt lst_pblsh_dt cease_pblsh_dt",
)

BODIES["feed_sample_edu"] = plain(SAMPLE, FEED_DATES)
BODIES["feed_market"] = plain(MARKET, FEED_DATES)
BODIES["feed_brand"] = plain(BRAND, FEED_DATES)
BODIES["product_union"] = plain(
    f"SELECT {FEED_KEYS}, prod_typ, end_dt_prod_grp_prod, cease_pblsh_dt_prod_grp_prod FROM {FEED} f",
    "end_dt_prod_grp_prod cease_pblsh_dt_prod_grp_prod",
)
BODIES["product_feed"] = plain(
    f"SELECT {', '.join(f'{old} AS {new}' for old, new in C.STAGED_PRODUCT.items())}, {AUDIT} FROM {PICKED} c",
    "start_dt__c end_dt__c crt_dt__c updt_dt__c lst_lot_exprtn_dt__c lst_pblsh_dt__c cease_pblsh_dt__c",
)
BODIES["product_feed_touched"] = BODIES["product_feed"]
BODIES["group_global"] = plain(f"SELECT * FROM {GLOBAL_ROWS} g", GROUP_DATES)
BODIES["group_country"] = plain(f"SELECT * FROM {COUNTRY_ROWS} g", GROUP_DATES)
BODIES["group_global_synth"] = plain(f"SELECT * FROM {SYNTHESISED} g", GROUP_DATES)
BODIES["group_feed"] = plain(
    f"""SELECT {", ".join(f"u.{c} AS {C.STAGED_GROUP[c]}" for c in C.GROUP_ROW)},
           CAST(u.prod_grp_prnt_id AS VARCHAR) || u.cntry_cd AS prod_grp_external_id_glbl__c,
           p.prod_grp_id_prnt AS glbl_parent_product_group__c, {AUDIT}
    FROM {GROUP_UNIQUE} u
    LEFT JOIN (SELECT DISTINCT prod_grp_id_child, prod_grp_id_prnt FROM in_parents) p ON p.prod_grp_id_child = u.prod_grp_prnt_id""",
    " ".join(C.STAGED_GROUP[c] for c in GROUP_DATES.split()) + " glbl_parent_product_group__c",
)
BODIES["indication_global"] = plain(f"SELECT {', '.join(C.STAGED_INDICATION)} FROM {INDICATION_GLOBAL} g", GROUP_DATES + " apprvl_dt revoke_dt")
BODIES["indication_feed"] = plain(
    f"""SELECT *, CAST(NULL AS VARCHAR) AS sfdc_id, {AUDIT} FROM (
      SELECT {INDICATION_STAGED} FROM {INDICATION_COUNTRY} c UNION SELECT {INDICATION_STAGED} FROM {INDICATION_GLOBAL} g) u""",
    INDICATION_DATES,
)

BODIES["spend_event_stage"] = plain(f"SELECT *, {AUDIT} FROM {EVENT_STAGE} e", "date_of_event_merc__c")
BODIES["spend_attendee_stage"] = plain(f"SELECT *, {AUDIT} FROM {ATTENDEE_STAGE} a", " ".join(C.ATTENDEE_AMOUNTS.values()))
BODIES["spend_value_stage"] = plain(
    f"SELECT *, {AUDIT} FROM {VALUE_STAGE} v", "meeting_day_date_merc__c " + " ".join(C.DAY_AMOUNTS.values())
)
BODIES["spend_join"] = plain(f"SELECT * FROM {SPEND_JOIN} j", f"date_of_event_merc__c meeting_day_date_merc__c {MONEY}")
BODIES["value_lines"] = plain(f"SELECT * FROM {VALUE_LINES} v", "value_amount")
BODIES["spend_export"] = SPEND_EXPORT

BODIES["export_product"] = f"""
SELECT {", ".join(_product_export_column(c) for c in C.EXPORT_PRODUCT)}, SUBSTR(trnsltd_dsply_nm__c, 1, 80) AS "Name"
FROM in_export_product"""
BODIES["export_group"] = f"""
SELECT * REPLACE (CAST("Product_Group_Id_GLBL__c" AS BIGINT) AS "Product_Group_Id_GLBL__c") FROM ({EXPORT_GROUP}) g"""
BODIES["export_indication"] = (
    f"SELECT {', '.join(_indication_export_column(e, c) for e, c in C.EXPORT_INDICATION_NAMES.items())} FROM in_export_indication"
)

BODIES["history_close"] = f"SELECT * FROM {closed(stamp=True)} c"
BODIES["history_apply"] = f"SELECT * FROM {closed(stamp=False)} c UNION ALL SELECT k, payload, {AUDIT} FROM in_stage"
BODIES["history_rollback"] = f"SELECT * FROM {closed(stamp=False)} c"
BODIES["landing_arrays"] = """
SELECT CAST(o->>'event_id' AS BIGINT) AS event_id, o->>'event_type' AS event_type FROM (
  SELECT unnest(CASE WHEN line LIKE '[%' THEN CAST(CAST(line AS JSON) AS JSON[]) ELSE [CAST(line AS JSON)] END) AS o
  FROM in_landed_line WHERE json_valid(line)) x"""
BODIES["stream_rejects"] = "SELECT line, COUNT(*) AS n FROM in_landed_line WHERE TRIM(line) <> '' AND NOT json_valid(line) GROUP BY line"
_EARLIER_AND_LATER = f"""
WITH earlier AS ({WINDOWED} > '{AFTER}' AND Participant_ToV_Updated_Date_MERC__c <= '{BETWEEN}'),
     later AS ({WINDOWED} > '{BETWEEN}' AND Participant_ToV_Updated_Date_MERC__c <= '{UNTIL}')
SELECT owner_id, meeting_id, CASE WHEN again THEN 'N' ELSE 'Y' END AS is_active, '{RUN_TS}' AS created_ts,
       CASE WHEN again THEN '{NEXT_TS}' ELSE '{RUN_TS}' END AS updated_ts, CAST(77 AS BIGINT) AS created_by_job_exec_id,
       CAST(CASE WHEN again THEN 78 ELSE 77 END AS BIGINT) AS updated_by_job_exec_id
FROM (SELECT *, owner_id IN (SELECT owner_id FROM later) AS again FROM earlier) e"""
BODIES["incremental_run"] = f"""{_EARLIER_AND_LATER}
UNION ALL
SELECT owner_id, meeting_id, 'Y', '{NEXT_TS}', '{NEXT_TS}', CAST(78 AS BIGINT), CAST(78 AS BIGINT) FROM later"""
BODIES["job_rollback"] = _EARLIER_AND_LATER
BODIES["job_repeated_after_rollback"] = BODIES["incremental_run"]
BODIES["stream_history"] = f"""
WITH first_rows AS (SELECT o_custkey AS k, o_orderpriority AS payload FROM orders),
     second_rows AS (SELECT k, payload FROM in_stage),
     third_rows AS (SELECT s_suppkey * 3 AS k, s_name AS payload FROM supplier),
     versions AS (
       SELECT k, payload, k IN (SELECT k FROM second_rows UNION ALL SELECT k FROM third_rows) AS again, 77 AS made, '{RUN_TS}' AS made_ts FROM first_rows
       UNION ALL SELECT k, payload, k IN (SELECT k FROM third_rows), 78, '{NEXT_TS}' FROM second_rows
       UNION ALL SELECT k, payload, FALSE, 78, '{NEXT_TS}' FROM third_rows)
SELECT k, payload, CASE WHEN again THEN 'N' ELSE 'Y' END AS is_active, made_ts AS created_ts,
       CASE WHEN again THEN '{NEXT_TS}' ELSE made_ts END AS updated_ts,
       CAST(made AS BIGINT) AS created_by_job_exec_id, CAST(made AS BIGINT) AS updated_by_job_exec_id
FROM versions"""


def _joined(body: str) -> str:
    """Put the inputs in front of a body that may start with its own WITH."""
    stripped = body.strip()
    return with_inputs(f"SELECT * FROM ({stripped}) result" if stripped.startswith("WITH") else stripped)


ORACLE = {name: _joined(body) for name, body in BODIES.items()}
