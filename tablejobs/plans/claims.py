"""Claims hub: the latest version of each claim with its lookups and audit columns.

Inputs and output columns are given; which input column feeds which output column is this library's
reading of their names. Output columns without a source are typed NULL.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.functions.dates import DateLike
from tablejobs.operators.joins import HALVES, Edge, require_tables, star_join
from tablejobs.plans.hub import AUDIT_TYPES, VERSION_COUNT, conform, with_audit
from tablejobs.sources.snapshots import OBJECT_ID, VERSION, load_snapshots, log_table, reader_of, short_name

# Input tables with the columns the job reads.
CLAIM_REFERENCES = (
    "CaseManager IMA InjuredWorker ProcessingCentre Accident LiabilityRejectReason WCInsurer Policy "
    "ReasonForDecline ClaimStatus ClaimProfile"
)
CLAIM_ATTRIBUTES = (
    "aDateLimitationExtendedTo aAIFRequestedDate aHasClaimFormEntryAssistance aClaimNumber "
    "aDateClaimFormsReceived aDateNOACFirstReported aDoesS5Apply aDateIniialConsultGP "
    "aDateInitialConsultSolicitor aDateANFReported aIsEscalatedClaim aDateTimeEntered aCareType aDescription "
    "aLimitationExtendedBy aNOACS39FollowUpStatus aNominalDefendantPerc aNominalDefendantReference "
    "aIsNotableAndSignificantClaim aDateFirstFinalised aClaimStatusDate aDateReopened aIsUnreasonableContact "
    "aDateNOACFirstResponse aANFAtFault aDateClaimSatisfied aDateNOACSatisfied aDateS110 aNOACFirstResponseCode "
    "aWorkcoverSOCRECDate aDateLastContClaimant aS84AHardshipPayment aS84AHardshipRequestDate aInterimPayments "
    "aLateClaimAcceptedDate aClaimFormEntryAssistantName aDatePrescribedAuthoritySigned aIsPrescribedAuthority "
    "aDatePrescribedAuthorityValidTo aClaimFormEntryAssistanceReason aSatisfactoryAIFRecvDate aWorkcoverRecovery"
)


def _input(name: str, attributes: str, references: str = "", **options):
    return log_table(name, attributes, references, with_operation=False, **options)


TABLES = (
    _input("dl_TIMPolicyClaim", CLAIM_ATTRIBUTES, CLAIM_REFERENCES),
    _input("dl_TIMPolicy", "aPolicyNumber"),
    _input("dl_TIMReasonForDecline", "aDescription"),
    _input("dl_TIMAddress", "aPostCode aStreetName aStreetNumber aUnitNumber", "State StreetType Suburb"),
    _input("dl_TIMState", "aName"),
    # One row per claim, not per object: the latest status change of each claim.
    _input("dl_TIMProfileHistoryStatus", "", "Claim StatusChangeReason", keys=("myClaim_clsno", "myClaim_instid")),
    _input("dl_TIMClaimStatusHistoryReopen", "aCode aDescription"),
    _input("dl_TIMClaimStatusHistoryFinalise", "aCode aDescription"),
    _input("dl_TIMClaimStatus", "aCode aDescription"),
    _input("dl_CARClaimProfileCode", "aDescription"),
    _input("dl_CTPAccident", "aUniqueID aDateTimeOfAccident", "AccidentLocation"),
    _input("dl_TIMLiabilityRejectReason", "aDescription"),
)

# Tables whose columns the output has; the others of TABLES are unique by key, so a left join of them would change nothing.
# Claims lie by their own key, as their latest changes do, so these come first.
EDGES = (
    Edge("change", "dl_TIMProfileHistoryStatus", "claim.oid", "change.myClaim"),
    Edge("reopen", "dl_TIMClaimStatusHistoryReopen", "change.myStatusChangeReason", "reopen.oid"),
    Edge("status", "dl_TIMClaimStatus", "claim.myClaimStatus", "status.oid"),
    Edge("decline", "dl_TIMReasonForDecline", "claim.myReasonForDecline", "decline.oid"),
    Edge("accident", "dl_CTPAccident", "claim.myAccident", "accident.oid"),
    Edge("address", "dl_TIMAddress", "accident.myAccidentLocation", "address.oid"),
    Edge("state", "dl_TIMState", "address.myState", "state.oid"),
)

# Business columns of the output in order; the audit columns follow them.
BUSINESS_COLUMNS = """
clm_no clm_key acc_no clm_notifcn_flg clm_racq_yes_no_flg clm_rs_for_decline clm_s5_complnce_does_s5_apply
clm_initial_consult_gp_dt clm_initial_consult_solicitor_dt clm_limitatn_extnded_to_dt clm_aif_reqst_dt
clm_assistnce_completng_icf clm_acc_notifcn_rcvd_dt clm_escalated clm_disp_type clm_disp_type_cd clm_entrd_dt
clm_flg clm_rpted_dt clm_stat clm_high_care_flg clm_stat_cd clm_type clm_limitatn_extnded_by clm_noac_rpted_dt
clm_noac_s39_1b_follow_up_stat clm_nominal_defendnt_pct clm_nominal_defendnt clm_company clm_notable_significnt
clm_sensitive_rs clm_form_notice_of_claim_rcvd_dt clm_first_fnlised_dt clm_status_dt clm_reopened_dt
clm_unreas_con clm_first_non_complnce_qld_s39_dt clm_acc_fault_notifcn_form clm_cls clm_complnce_dt
clm_first_resp_noac_complnce_cd clm_first_resp_noac_complnce_dt clm_subj_to_procedural_issue clm_wc_recov_dt
clm_last_con_clmnt_dt clm_days_in_lifecyc_stg clm_demonstratable clm_lifecycle_stg clm_maic_rpted_flg
clm_fincl_hardshp_paymt_req_amt clm_fincl_hardshp_paymt_req_dt clm_fnlisation_ay_grping clm_noac_satisfied_dt
clm_null clm_online_form_id clm_interim_pymt clm_latst_of_accptnce_of_clm_subj_to_procedrl_issu_dt
clm_persn_assistng_icf_completn clm_mangng_state clm_minimal_impact_flg clm_nominal_defendnt_ref_no clm_null_rs
clm_nulled_dt clm_prescrbd_auth_signd_dt clm_prescrbd_auth_valid clm_prescrbd_auth_valid_to_dt
clm_rs_icf_completn_assistnce_reqrd clm_recov_by_anoth_insur clm_reopen_rs_pir_cd clm_reopen_rs
clm_rturn_to_wrk_full_dt clm_rturn_to_wrk_partial_dt clm_satisfactry_aif_rcvd_dt clm_event_cd clm_s74_rpted
clm_ContactType clm_wc_recov
""".split()

SOURCES = {
    "clm_no": "claim.aClaimNumber",
    "acc_no": "accident.aUniqueID",
    "clm_rs_for_decline": "decline.aDescription",
    "clm_s5_complnce_does_s5_apply": "claim.aDoesS5Apply",
    "clm_initial_consult_gp_dt": "claim.aDateIniialConsultGP",
    "clm_initial_consult_solicitor_dt": "claim.aDateInitialConsultSolicitor",
    "clm_limitatn_extnded_to_dt": "claim.aDateLimitationExtendedTo",
    "clm_aif_reqst_dt": "claim.aAIFRequestedDate",
    "clm_assistnce_completng_icf": "claim.aHasClaimFormEntryAssistance",
    "clm_escalated": "claim.aIsEscalatedClaim",
    "clm_entrd_dt": "claim.aDateTimeEntered",
    "clm_stat": "status.aDescription",
    "clm_high_care_flg": "claim.aCareType",
    "clm_stat_cd": "status.aCode",
    "clm_limitatn_extnded_by": "claim.aLimitationExtendedBy",
    "clm_noac_rpted_dt": "claim.aDateNOACFirstReported",
    "clm_noac_s39_1b_follow_up_stat": "claim.aNOACS39FollowUpStatus",
    "clm_nominal_defendnt_pct": "claim.aNominalDefendantPerc",
    "clm_notable_significnt": "claim.aIsNotableAndSignificantClaim",
    "clm_form_notice_of_claim_rcvd_dt": "claim.aDateClaimFormsReceived",
    "clm_first_fnlised_dt": "claim.aDateFirstFinalised",
    "clm_status_dt": "claim.aClaimStatusDate",
    "clm_reopened_dt": "claim.aDateReopened",
    "clm_unreas_con": "claim.aIsUnreasonableContact",
    "clm_acc_fault_notifcn_form": "claim.aANFAtFault",
    "clm_first_resp_noac_complnce_cd": "claim.aNOACFirstResponseCode",
    "clm_first_resp_noac_complnce_dt": "claim.aDateNOACFirstResponse",
    "clm_wc_recov_dt": "claim.aWorkcoverSOCRECDate",
    "clm_last_con_clmnt_dt": "claim.aDateLastContClaimant",
    "clm_fincl_hardshp_paymt_req_amt": "claim.aS84AHardshipPayment",
    "clm_fincl_hardshp_paymt_req_dt": "claim.aS84AHardshipRequestDate",
    "clm_noac_satisfied_dt": "claim.aDateNOACSatisfied",
    "clm_interim_pymt": "claim.aInterimPayments",
    "clm_persn_assistng_icf_completn": "claim.aClaimFormEntryAssistantName",
    "clm_mangng_state": "state.aName",
    "clm_nominal_defendnt_ref_no": "claim.aNominalDefendantReference",
    "clm_prescrbd_auth_signd_dt": "claim.aDatePrescribedAuthoritySigned",
    "clm_prescrbd_auth_valid": "claim.aIsPrescribedAuthority",
    "clm_prescrbd_auth_valid_to_dt": "claim.aDatePrescribedAuthorityValidTo",
    "clm_rs_icf_completn_assistnce_reqrd": "claim.aClaimFormEntryAssistanceReason",
    "clm_reopen_rs_pir_cd": "reopen.aCode",
    "clm_reopen_rs": "reopen.aDescription",
    "clm_satisfactry_aif_rcvd_dt": "claim.aSatisfactoryAIFRecvDate",
    "clm_wc_recov": "claim.aWorkcoverRecovery",
}

BUSINESS_TYPES = {c: "date" if c.endswith("_dt") else "string" for c in BUSINESS_COLUMNS}
TARGET = {**BUSINESS_TYPES, **AUDIT_TYPES}
GRANULARITY = ("clm_no",)


# Columns of the claims that the output, its joins and its audit columns need.
CARRIED = tuple(
    dict.fromkeys(
        [
            VERSION,
            *OBJECT_ID,
            *[source.removeprefix("claim.") for source in SOURCES.values() if source.startswith("claim.")],
            *[f"{e.near.removeprefix('claim.')}_{half}" for e in EDGES if e.near.startswith("claim.") for half in HALVES],
        ]
    )
)
TABLES = (replace(TABLES[0], carried=CARRIED), *TABLES[1:])


def claims(
    ds: Mapping[str, DataFrame], versions: DataFrame | None = None, load_dt: DateLike = None
) -> DataFrame:
    """Claims hub rows from snapshots.

    The version number is that of the claims' snapshot where it counts versions, or of `versions` (from `version_counts`).
    """
    require_tables(ds, [short_name(t.name) for t in TABLES])
    joined = star_join(ds, ("claim", "dl_TIMPolicyClaim"), EDGES)
    business = [
        (F.col(SOURCES[c]) if c in SOURCES else F.lit(None)).try_cast(t).alias(c) for c, t in BUSINESS_TYPES.items()
    ]
    own = ["_timestamp", *OBJECT_ID, *[c for c in ds["dl_TIMPolicyClaim"].columns if c == VERSION_COUNT]]
    rows = joined.select(*[F.col(f"claim.{c}") for c in own], *business)
    if versions is not None:
        rows = rows.join(versions, list(OBJECT_ID), "left")
    return conform(with_audit(rows, BUSINESS_COLUMNS, load_dt=load_dt), TARGET)


def claims_of_logs(logs: Mapping[str, DataFrame], load_dt: DateLike = None) -> DataFrame:
    """The same from change-log tables at hand, with version numbers."""
    require_tables(logs, [short_name(t.name) for t in TABLES])
    spark = next(iter(logs.values())).sparkSession
    counted = {"dl_TIMPolicyClaim": VERSION_COUNT}
    return claims(load_snapshots(spark, TABLES, "", read=reader_of(logs), counted=counted), load_dt=load_dt)
