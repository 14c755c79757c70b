"""Column names of the data contract. These are fixed values that inputs and outputs must carry."""

from __future__ import annotations

# The product master.
PRODUCT_MASTER = """
brnd_cd collab_ind crt_dt dmnd_dflt_cnvrsn_fctr dmnd_dflt_cnvrsn_uom_cd dmnd_dsg_ptncy_uom_cd
dmnd_pkg_cntnt_prsntn_abbr_cd dmnd_pkg_cntnt_qty dmnd_pkg_cntnt_uom_cd dmnd_pkg_qty dmnd_pkg_typ_cd
dmnd_pkg_uom_cd dmnd_ptncy_dsg_qty dmnd_ptncy_qty dmnd_qty_ptncy_uom_cd dmnd_salable_ind dsg_freq_cd
edctnl_mtrl_id edp_fmly_cd edp_pkg_size_cd edp_prod_cd end_dt fda_pkg_size_cd item_rgltry_sched_cd lbl_cd
lst_lot_exprtn_dt mtrl_nbr nbr_of_doses prod_id prod_nm prod_typ prscptn_prod_cd rpkg_cd shpmnt_multi src_cd
start_dt std_dot_cnvrsn_fctr trd_nm_id updt_dt lst_pblsh_dt cease_pblsh_dt edctnl_mtrl_itm_typ
prod_disease_st_flg refrig_cd trackable_item
""".split()

# What each product feed adds to the master.
FEED_LINKS = ["prod_grp_prnt_id", "cntry_cd", "grp_prps_cd", "end_dt_prod_grp_prod", "cease_pblsh_dt_prod_grp_prod"]
PRODUCT_FEED = PRODUCT_MASTER + FEED_LINKS

# Staged product columns that do not follow the rule "name + __c".
STAGED_PRODUCT_EXCEPTIONS = {
    "dmnd_pkg_cntnt_prsntn_abbr_cd": "dmnd_pkg_cntnt_prstn_abr_cd__c",
    "altrnt_id": "alternate_id__c",
    "sfdc_id_prod_grp": "product_group__c",
    "altrnt_id_type_cd__c": "altrnt_id_type_cd__c",
    "recordtype": "recordtype",
}
STAGED_PRODUCT_LOOKUPS = """
altrnt_id trnsltd_dsply_nm trnsltd_prod_desc_txt dialect_nm cntry_cd sfdc_id_prod_grp altrnt_id_type_cd__c
product_external_id recordtype
""".split()
STAGED_PRODUCT = {c: STAGED_PRODUCT_EXCEPTIONS.get(c, f"{c}__c") for c in PRODUCT_MASTER + STAGED_PRODUCT_LOOKUPS}

# The product-group source and its staged form.
GROUP_SOURCE = """
prod_grp_id src_cd grp_nm grp_abbr_nm prod_grp_desc_txt grp_prps_cd grp_cnvrsn_unit_cd start_dt end_dt crt_dt
updt_dt lst_pblsh_dt cease_pblsh_dt cntry_cd prod_grp_typ
""".split()
GROUP_ROW = """
prod_grp_prnt_id src_cd grp_nm grp_abbr_nm prod_grp_desc_txt grp_prps_cd grp_cnvrsn_unit_cd start_dt end_dt
crt_dt updt_dt lst_pblsh_dt cease_pblsh_dt cntry_cd dialect_nm trnsltd_grp_nm prod_grp_typ_cd
""".split()
STAGED_GROUP_EXCEPTIONS = {
    "prod_grp_prnt_id": "product_group_id_glbl__c",
    "grp_nm": "name",
    "prod_external_id": "prod_grp_external_id_glbl__c",
    "prod_grp_id_prnt": "glbl_parent_product_group__c",
}
STAGED_GROUP = {
    c: STAGED_GROUP_EXCEPTIONS.get(c, f"{c}_glbl__c") for c in [*GROUP_ROW, "prod_external_id", "prod_grp_id_prnt"]
}

# The indication source and its staged form.
INDICATION_SOURCE = """
prod_grp_id indctn_id indctn_desc indctn_short_desc indctn_sts indctn_typ apprvl_dt revoke_dt start_dt end_dt
apprvl_sts_cd cntry_cd crt_dt updt_dt lst_pblsh_dt cease_pblsh_dt prod_grp_typ
""".split()
STAGED_INDICATION = {
    "prod_grp_id": "prod_grp_prnt_id_glbl__c",
    "indctn_desc": "indctn_desc_glbl__c",
    "indctn_short_desc": "name__c",
    "indctn_id": "indctn_id_glbl__c",
    "indctn_sts": "indctn_sts_glbl__c",
    "indctn_typ": "indctn_typ_glbl__c",
    "apprvl_dt": "approval_dt_glbl__c",
    "revoke_dt": "revoke_dt_glbl__c",
    "start_dt": "start_dt_glbl__c",
    "end_dt": "end_dt_glbl__c",
    "apprvl_sts_cd": "apprvl_sts_glbl__c",
    "cntry_cd": "country_cd_glbl__c",
    "crt_dt": "crt_dt_glbl__c",
    "updt_dt": "updt_dt_glbl__c",
    "lst_pblsh_dt": "lst_pblsh_dt_glbl__c",
    "cease_pblsh_dt": "cease_pblsh_dt_glbl__c",
    "dialect_nm": "dialect_nm_glbl__c",
    "trnsltd_indctn_desc_txt": "trnsltd_indctn_desc_glbl__c",
    "trnsltd_indctn_short_desc": "trnsltd_indctn_sh_desc_glbl__c",
    "indctn_ext_id_glbl__c": "indctn_ext_id_glbl__c",
    "prod_grp_prnt_id_glbl_sfdc_id": "prod_grp_prnt_id_glbl_sfdc_id",
}

# Landed objects of the spend chain.
LANDED_MEETING = """
Id Event_Id_MERC__c Event_Country_MERC__c Date_of_Event_MERC__c Owner_Master_Id_MERC__c Name
Participant_ToV_Updated_Date_MERC__c Participant_ToV_Final_MERC__c
""".split()
LANDED_PARTICIPANT = """
Id Meeting_MERC__c Account_MERC__c Participant_Typ_MERC__c Status_MERC__c Customer_Id_GLBL__c
ToV_Currency_MERC__c Total_Hotel_ToV_MERC__c Total_Ground_Transporation_ToV_MERC__c
Total_Registration_ToV_MERC__c Total_Food_Beverage_ToV_MERC__c Total_Individual_Transport_ToV_MERC__c
CoPay_AODS_Hotel_MERC__c CoPay_AODS_Ground_Transport_MERC__c CoPay_AODS_Food_Beverage_MERC__c
CoPay_AODS_Registration_MERC__c CoPay_AODS_Flight_Rail_MERC__c CoPay_AODS_Indiv_Transportation_MERC__c
Record_Type_Name_MERC__c
""".split()
LANDED_ACCOUNT = ["Id", "Name"]
LANDED_DAY_VALUE = """
Id Meeting_Participant_MERC__c Meeting_Day_Date_MERC__c CurrencyIsoCode Est_Hotel_ToV_MERC__c
Est_Grp_Grnd_Transp_MERC__c Est_Food_Bev_ToV_MERC__c Est_Reg_Amt_ToV_MERC__c Est_Indv_Transfer_MERC__c
""".split()
LANDED_PRODUCT_ID = ["Id", "Prod_id__c", "Product_External_ID__c", "Cntry_Cd__c"]
LANDED_GROUP_ID = ["Id", "Product_Group_External_ID_GLBL__c", "Cntry_Cd_GLBL__c", "Product_Group_Id_GLBL__c"]

# Attendee amounts, landed name -> staged name.
ATTENDEE_AMOUNTS = {
    "Total_Hotel_ToV_MERC__c": "total_hotel_tov_merc__c",
    "Total_Ground_Transporation_ToV_MERC__c": "total_ground_trnsprtn_tov_merc",
    "Total_Registration_ToV_MERC__c": "total_registration_tov_merc__c",
    "Total_Food_Beverage_ToV_MERC__c": "total_food_beverage_tov_merc",
    "Total_Individual_Transport_ToV_MERC__c": "total_indiv_trans_tov_merc__c",
    "CoPay_AODS_Hotel_MERC__c": "copay_hotel_merc__c",
    "CoPay_AODS_Ground_Transport_MERC__c": "copay_ground_transport_merc__c",
    "CoPay_AODS_Food_Beverage_MERC__c": "copay_food_beverage_merc__c",
    "CoPay_AODS_Registration_MERC__c": "copay_registration_merc__c",
    "CoPay_AODS_Flight_Rail_MERC__c": "copay_flight_rail_merc__c",
    "CoPay_AODS_Indiv_Transportation_MERC__c": "copay_aods_indiv_trans_merc__c",
}

# Day-value amounts, landed name -> staged name.
DAY_AMOUNTS = {
    "Est_Hotel_ToV_MERC__c": "est_hotel_tov_merc__c",
    "Est_Grp_Grnd_Transp_MERC__c": "est_grnd_transp_merc__c",
    "Est_Food_Bev_ToV_MERC__c": "est_food_bev_tov_merc__c",
    "Est_Reg_Amt_ToV_MERC__c": "est_reg_amt_tov_merc__c",
    "Est_Indv_Transfer_MERC__c": "est_indv_transfer_merc__c",
}

# Columns of the staged product table, as the product export reads them.
EXPORT_PRODUCT = """
alternate_id__c altrnt_id_type_cd__c avg_rx_quantity__c brnd_cd__c cease_pblsh_dt__c class_dvlpmnt_cd__c
cntry_cd__c cnvrsn_fctr__c collab_ind__c crt_dt__c dflt_cnvrsn_fctr__c dflt_cnvrsn_uom_cd__c dfnd_dly_dsg__c
dialect_nm__c dmnd_dflt_cnvrsn_fctr__c dmnd_dflt_cnvrsn_uom_cd__c dmnd_dsg_ptncy_uom_cd__c
dmnd_pkg_cntnt_prstn_abr_cd__c dmnd_pkg_cntnt_qty__c dmnd_pkg_cntnt_uom_cd__c dmnd_pkg_qty__c
dmnd_pkg_typ_cd__c dmnd_pkg_uom_cd__c dmnd_ptncy_dsg_qty__c dmnd_ptncy_qty__c dmnd_qty_ptncy_uom_cd__c
dmnd_salable_ind__c dscnt_dscrptn_txt__c dsg_freq_cd__c dsg_ptncy_uom_cd__c dsg_uom_cd__c dsgntd_indctr__c
edctnl_mtrl_itm_typ__c edctnl_mtrl_ctgry_cd__c edctnl_mtrl_dscnt_pct__c edctnl_mtrl_id__c edp_fmly_cd__c
edp_pkg_size_cd__c edp_prod_cd__c eqvlncy_fctr__c fda_pkg_size_cd__c hcfa_unit_per_pkg__c
item_rgltry_sched_cd__c lbl_cd__c lst_lot_exprtn_dt__c lst_pblsh_dt__c mtrl_nbr__c nbr_of_doses__c
nhi_prc_lst_dt__c oral_admnstrn_cd__c ordr_frm_flg__c pkg_cntnt_prstn_abr_cd__c pkg_cntnt_qty__c
pkg_cntnt_uom_cd__c pkg_qty__c pkg_typ_cd__c pkg_uom_cd__c prod_disease_st_flg__c prod_id__c
prod_long_desc__c prod_nm__c prod_typ__c product_external_id__c product_group__c prscptn_prod_cd__c
ptncy_dsg_qty__c ptncy_qty__c qty_ptncy_uom_cd__c recordtype refrig_cd__c rpkg_cd__c salable_ind__c
salt_qty__c shpmnt_multi__c smpl_invntry_var_pct__c smpl_invntry_var_unit_qty__c src_cd__c start_dt__c
std_dot_cnvrsn_fctr__c thrptc_cd__c trackable_item__c trd_nm_id__c trmntn_dt__c trnsltd_dsply_nm__c
trnsltd_prod_desc_txt__c unt_typ_cd__c updt_dt__c vet_unit_pkg_txt__c vha_plus_flg__c end_dt__c prft_ctr__c
""".split()

# Product export names that are not the staged name with a capital first letter.
EXPORT_PRODUCT_EXCEPTIONS = {
    "alternate_id__c": "Alternate_ID__c",
    "altrnt_id_type_cd__c": "Altrnt_Id_Type_Cd__c",
    "cntry_cd__c": "Cntry_Cd__c",
    "dmnd_pkg_cntnt_prstn_abr_cd__c": "Dmnd_pkg_cntnt_prsntn_abbr_cd__c",
    "edctnl_mtrl_itm_typ__c": "Edctnl_Mtrl_Itm_Typ__c",
    "pkg_cntnt_prstn_abr_cd__c": "Pkg_cntnt_prsntn_abbr_cd__c",
    "prod_disease_st_flg__c": "Prod_Disease_St_Flg__c",
    "product_external_id__c": "Product_External_ID__c",
    "product_group__c": "Product_Group__c",
    "recordtype": "RecordTypeId",
    "refrig_cd__c": "Refrig_Cd__c",
    "trackable_item__c": "Trackable_Item__c",
    "trnsltd_dsply_nm__c": "Trnsltd_Dsply_Nm__c",
    "trnsltd_prod_desc_txt__c": "Trnsltd_Prod_Desc_Txt__c",
    "end_dt__c": "end_dt__c",
    "prft_ctr__c": "prft_ctr__c",
}
EXPORT_PRODUCT_NAMES = {c: EXPORT_PRODUCT_EXCEPTIONS.get(c, c.capitalize()) for c in EXPORT_PRODUCT}

# Product export dates, and those of them with a far-future clamp.
EXPORT_PRODUCT_DATES = """
cease_pblsh_dt__c crt_dt__c lst_lot_exprtn_dt__c lst_pblsh_dt__c nhi_prc_lst_dt__c start_dt__c trmntn_dt__c
updt_dt__c end_dt__c
""".split()
EXPORT_PRODUCT_CLAMPED = ["cease_pblsh_dt__c", "lst_lot_exprtn_dt__c", "trmntn_dt__c", "end_dt__c"]

# Product export columns with the null marker.
EXPORT_PRODUCT_MARKED = """
brnd_cd__c collab_ind__c dflt_cnvrsn_fctr__c dflt_cnvrsn_uom_cd__c dmnd_dsg_ptncy_uom_cd__c
dmnd_pkg_cntnt_uom_cd__c dmnd_pkg_qty__c dmnd_pkg_typ_cd__c dmnd_pkg_uom_cd__c dmnd_pkg_cntnt_prstn_abr_cd__c
dmnd_ptncy_dsg_qty__c dmnd_ptncy_qty__c dmnd_salable_ind__c dsg_ptncy_uom_cd__c edctnl_mtrl_ctgry_cd__c
edctnl_mtrl_id__c edctnl_mtrl_itm_typ__c fda_pkg_size_cd__c item_rgltry_sched_cd__c lst_lot_exprtn_dt__c
nbr_of_doses__c pkg_cntnt_prstn_abr_cd__c pkg_cntnt_qty__c pkg_cntnt_uom_cd__c pkg_qty__c pkg_typ_cd__c
pkg_uom_cd__c ptncy_dsg_qty__c ptncy_qty__c prscptn_prod_cd__c prod_disease_st_flg__c qty_ptncy_uom_cd__c
rpkg_cd__c salable_ind__c shpmnt_multi__c std_dot_cnvrsn_fctr__c trackable_item__c
""".split()

# Group export, staged name -> exported name. ``end_dt_glbl__c`` is exported as well.
EXPORT_GROUP_NAMES = {
    "cease_pblsh_dt_glbl__c": "Cease_Pblsh_Dt_GLBL__c",
    "cntry_cd_glbl__c": "Cntry_Cd_GLBL__c",
    "crt_dt_glbl__c": "Crt_Dt_GLBL__c",
    "dialect_nm_glbl__c": "Dialect_Nm_GLBL__c",
    "end_dt_glbl__c": "End_Dt_GLBL__c",
    "glbl_parent_product_group__c": "GLBL_Parent_Product_Group__c",
    "grp_abbr_nm_glbl__c": "Grp_Abbr_Nm_GLBL__c",
    "grp_cnvrsn_unit_cd_glbl__c": "Grp_Cnvrsn_Unit_Cd_GLBL__c",
    "grp_prps_cd_glbl__c": "Grp_Prps_Cd_GLBL__c",
    "lst_pblsh_dt_glbl__c": "Lst_Pblsh_Dt_GLBL__c",
    "prod_grp_desc_txt_glbl__c": "Prod_Grp_Desc_Txt_GLBL__c",
    "prod_grp_typ_cd_glbl__c": "Prod_Grp_Typ_Cd_GLBL__c",
    "prod_grp_external_id_glbl__c": "Product_Group_External_ID_GLBL__c",
    "product_group_id_glbl__c": "Product_Group_Id_GLBL__c",
    "src_cd_glbl__c": "Src_Cd_GLBL__c",
    "start_dt_glbl__c": "Start_Dt_GLBL__c",
    "trnsltd_grp_nm_glbl__c": "Trnsltd_Grp_Nm_GLBL__c",
    "name": "Untrnsltd_Grp_Nm_GLBL__c",
    "updt_dt_glbl__c": "Updt_Dt_GLBL__c",
}
EXPORT_GROUP_INSTANTS = ["crt_dt_glbl__c", "lst_pblsh_dt_glbl__c", "updt_dt_glbl__c"]
EXPORT_GROUP_CLAMPED = ["cease_pblsh_dt_glbl__c", "end_dt_glbl__c"]
EXPORT_GROUP_MARKED = """
Cease_Pblsh_Dt_GLBL__c GLBL_Parent_Product_Group__c Grp_Abbr_Nm_GLBL__c Grp_Cnvrsn_Unit_Cd_GLBL__c
Prod_Grp_Desc_Txt_GLBL__c Prod_Grp_Typ_Cd_GLBL__c Src_Cd_GLBL__c Trnsltd_Grp_Nm_GLBL__c
""".split()

# Indication export, exported name -> staged name.
EXPORT_INDICATION_NAMES = {
    "Approval_Dt_GLBL__c": "approval_dt_glbl__c",
    "Approval_Sts_GLBL__c": "apprvl_sts_glbl__c",
    "Cease_Pblsh_Dt_GLBL__c": "cease_pblsh_dt_glbl__c",
    "Country_Cd_GLBL__c": "country_cd_glbl__c",
    "Crt_Dt_GLBL__c": "crt_dt_glbl__c",
    "Dialect_Nm_GLBL__c": "dialect_nm_glbl__c",
    "End_Dt_GLBL__c": "end_dt_glbl__c",
    "Indctn_Desc_GLBL__c": "indctn_desc_glbl__c",
    "Name": "indctn_desc_glbl__c",
    "Indctn_External_Id_GLBL__c": "indctn_ext_id_glbl__c",
    "Indctn_Id_GLBL__c": "indctn_id_glbl__c",
    "Indctn_Short_Desc_GLBL__c": "name__c",
    "Indctn_Sts_GLBL__c": "indctn_sts_glbl__c",
    "Indctn_Typ_GLBL__c": "indctn_typ_glbl__c",
    "Lst_Pblsh_Dt_GLBL__c": "lst_pblsh_dt_glbl__c",
    "Prod_Grp_Prnt_Id_GLBL__c": "prod_grp_prnt_id_glbl_sfdc_id",
    "Revoke_Dt_GLBL__c": "revoke_dt_glbl__c",
    "Start_Dt_GLBL__c": "start_dt_glbl__c",
    "Trnsltd_Indctn_Desc_GLBL__c": "trnsltd_indctn_desc_glbl__c",
    "Trnsltd_Indctn_Short_Desc_GLBL__c": "trnsltd_indctn_sh_desc_glbl__c",
    "Updt_Dt_GLBL__c": "updt_dt_glbl__c",
}
EXPORT_INDICATION_DATES = """
Approval_Dt_GLBL__c Cease_Pblsh_Dt_GLBL__c Crt_Dt_GLBL__c End_Dt_GLBL__c Lst_Pblsh_Dt_GLBL__c
Revoke_Dt_GLBL__c Start_Dt_GLBL__c Updt_Dt_GLBL__c
""".split()
EXPORT_INDICATION_CLAMPED = ["Cease_Pblsh_Dt_GLBL__c", "End_Dt_GLBL__c", "Revoke_Dt_GLBL__c"]
EXPORT_INDICATION_MARKED = """
Approval_Dt_GLBL__c Revoke_Dt_GLBL__c Start_Dt_GLBL__c Approval_Sts_GLBL__c Cease_Pblsh_Dt_GLBL__c
""".split()

# Names of the 27 columns of the spend export, in order.
SPEND_EXPORT = """
CompanyCd SrcSysCd CountryCd SrcSysTypeCd EventId EventStartDt EventTypeCd EventDesc EventParentId
EventParentCompanyCD EventParentSrcSysCd EventParentCountryCd EventStatusCd EventCreatedById
EventValueCustomerId EventValueCustomerEventRole EventValueCustomerStatusCd EventCustomerTypeCd
EventCustomerInternalId EventCustomerNm ValueId ValueTypeCode ValuePurposeCd ValuePurposeSecondaryCd
ValuePaidDt ValueAmount ValueCurrencyCD
""".split()
