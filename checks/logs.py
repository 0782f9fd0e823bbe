"""Snapshots and hub jobs, on change logs derived from the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.registry import query
from checks.standins import (
    LINE_KEY,
    LOGS,
    USER_DAY_LOG,
    USER_LOG,
    logs,
    read,
    sql_latest,
    sql_logs,
    sql_text,
    stand_in,
)
from tablejobs.operators.joins import Edge, lookup_join, star_join
from tablejobs.operators.windows import latest_per_key, number_rows
from tablejobs.plans import activity, claims, history, legal
from tablejobs.plans.hub import conform, duplicate_keys, version_counts, with_audit
from tablejobs.plans.jobs import JOBS
from tablejobs.session import scratch_dir
from tablejobs.sources.snapshots import TableSpec, load_snapshots, reader_of, short_name
from tablejobs.sources.tables import qualify, scan, write_bucketed

OID = "oid_clsno, oid_instid"


# --- latest per key ------------------------------------------------------------------------------


@query("latest_row_number", f"WITH log AS ({sql_text(USER_LOG)}) {sql_latest('log', OID)}")
def latest_row_number(spark, sf):
    latest = latest_per_key(stand_in(spark, sf, USER_LOG), ["oid_clsno", "oid_instid"])
    return latest.filter("_operation <> 'D'")


@query("latest_rank_ties", f"WITH log AS ({sql_text(USER_DAY_LOG)}) {sql_latest('log', OID, 'rank')}")
def latest_rank_ties(spark, sf):
    latest = latest_per_key(stand_in(spark, sf, USER_DAY_LOG), ["oid_clsno", "oid_instid"], mode="rank")
    return latest.filter("_operation <> 'D'")


@query(
    "latest_by_foreign_key",
    """SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_shipdate FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey
  ORDER BY l_shipdate DESC NULLS LAST, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) = 1""",
)
def latest_by_foreign_key(spark, sf):
    lines = read(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate")
    order = ["l_shipdate desc"]
    return latest_per_key(
        lines, ["l_partkey"], order, tiebreak=["l_orderkey desc", "l_linenumber desc", "l_suppkey desc"]
    )


# --- spec-driven snapshots -----------------------------------------------------------------------


def _user_snapshot(spark, sf, text: str, dedup: str):
    spec = TableSpec("{db_env}_logs.users", ("oid_instid", "_timestamp", "aEventId", "aHeader"))
    loaded = load_snapshots(spark, [spec], "test", dedup, reader_of({"users": stand_in(spark, sf, text)}))
    return loaded["users"]


SNAPSHOT_SQL = "SELECT oid_instid, _timestamp, aEventId, aHeader FROM"


@query(
    "snapshot_row_number",
    f"WITH log AS ({sql_text(USER_LOG)}) {SNAPSHOT_SQL} ({sql_latest('log', OID)})",
)
def snapshot_row_number(spark, sf):
    return _user_snapshot(spark, sf, USER_LOG, "row_number")


@query(
    "snapshot_rank",
    f"WITH log AS ({sql_text(USER_DAY_LOG)}) {SNAPSHOT_SQL} ({sql_latest('log', OID, 'rank')})",
)
def snapshot_rank(spark, sf):
    return _user_snapshot(spark, sf, USER_DAY_LOG, "rank")


@query("snapshot_filter_only", f"{SNAPSHOT_SQL} ({sql_text(USER_LOG)}) WHERE _operation <> 'D'")
def snapshot_filter_only(spark, sf):
    return _user_snapshot(spark, sf, USER_LOG, "none")


# --- joins ---------------------------------------------------------------------------------------


def _as_objects(spark, sf) -> dict:
    """Test tables with two-part ids: the class number is constant per table."""
    nation = read(spark, sf, "nation").selectExpr(
        "7 AS oid_clsno", "n_nationkey AS oid_instid", "n_name", "8 AS myRegion_clsno", "n_regionkey AS myRegion_instid"
    )
    return {
        "line": read(spark, sf, "lineitem").selectExpr(
            "l_orderkey", "l_linenumber", "l_quantity",
            "1 AS myOrder_clsno", "l_orderkey AS myOrder_instid",
            "2 AS myPart_clsno", "l_partkey AS myPart_instid",
            "3 AS mySupplier_clsno", "CASE WHEN l_tax > 0 THEN l_suppkey END AS mySupplier_instid",
        ),
        "orders": read(spark, sf, "orders").selectExpr(
            "1 AS oid_clsno", "o_orderkey AS oid_instid", "o_orderstatus",
            "4 AS myCustomer_clsno", "o_custkey AS myCustomer_instid",
        ),
        "customer": read(spark, sf, "customer").selectExpr(
            "4 AS oid_clsno", "c_custkey AS oid_instid", "c_name", "7 AS myNation_clsno", "c_nationkey AS myNation_instid"
        ),
        "part": read(spark, sf, "part").filter("p_size <= 40").selectExpr(
            "2 AS oid_clsno", "p_partkey AS oid_instid", "p_name"
        ),
        "supplier": read(spark, sf, "supplier").selectExpr(
            "3 AS oid_clsno", "s_suppkey AS oid_instid", "s_name", "7 AS myNation_clsno", "s_nationkey AS myNation_instid"
        ),
        "nation": nation,
        "region": read(spark, sf, "region").selectExpr("8 AS oid_clsno", "r_regionkey AS oid_instid", "r_name"),
    }


@query(
    "composite_join_star",
    """SELECT l_orderkey, l_linenumber, l_quantity, o_orderstatus, c_name, p_name, s_name, n_name, r_name,
  CAST(NULL AS VARCHAR) AS to_be_defined
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
LEFT JOIN part ON l_partkey = p_partkey AND p_size <= 40
LEFT JOIN supplier ON l_suppkey = s_suppkey AND l_tax > 0
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def composite_join_star(spark, sf):
    edges = [
        Edge("o", "orders", "l.myOrder", "o.oid", "inner"),
        Edge("c", "customer", "o.myCustomer", "c.oid", "inner"),
        Edge("p", "part", "l.myPart", "p.oid"),
        Edge("s", "supplier", "l.mySupplier", "s.oid"),
        Edge("n", "nation", "c.myNation", "n.oid"),
        Edge("r", "region", "n.myRegion", "r.oid"),
    ]
    return star_join(_as_objects(spark, sf), ("l", "line"), edges).select(
        "l_orderkey", "l_linenumber", "l_quantity", "o_orderstatus", "c_name", "p_name", "s_name", "n_name", "r_name",
        F.lit(None).cast("string").alias("to_be_defined"),
    )


@query(
    "catalog_star",
    """SELECT l_orderkey, l_linenumber, l_quantity, o_orderstatus, c_name
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey""",
)
def catalog_star(spark, sf):
    """A star over catalog tables; the two large ones lie in buckets of the order."""
    tables, env = _as_objects(spark, sf), f"run_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {qualify('{db_env}_objects', env)} LOCATION '{scratch_dir(spark, 'catalog')}'")
    for name, ref in (("line", "myOrder"), ("orders", "oid"), ("customer", "oid")):
        write_bucketed(tables[name], qualify(f"{{db_env}}_objects.{name}", env), ref)
    ds = {name: scan(spark, f"{{db_env}}_objects.{name}", env) for name in ("line", "orders", "customer")}
    edges = [Edge("o", "orders", "l.myOrder", "o.oid", "inner"), Edge("c", "customer", "o.myCustomer", "c.oid")]
    star = star_join(ds, ("l", "line"), edges)
    return star.select("l_orderkey", "l_linenumber", "l_quantity", "o_orderstatus", "c_name")


@query(
    "broadcast_lookup",
    "SELECT c_name, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey < 3",
)
def broadcast_lookup(spark, sf):
    tables = _as_objects(spark, sf)
    nations = tables["nation"].filter("myRegion_instid < 3")
    joined = lookup_join(tables["customer"].alias("c"), nations.alias("n"), "c.myNation", "n.oid")
    return joined.select("c_name", "n_name")


@query(
    "role_join",
    """SELECT l_orderkey, l_linenumber, l_quantity, a.n_name AS customer_nation, b.n_name AS supplier_nation
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
LEFT JOIN supplier ON l_suppkey = s_suppkey AND l_tax > 0
LEFT JOIN nation a ON c_nationkey = a.n_nationkey LEFT JOIN nation b ON s_nationkey = b.n_nationkey""",
)
def role_join(spark, sf):
    edges = [
        Edge("o", "orders", "l.myOrder", "o.oid", "inner"),
        Edge("c", "customer", "o.myCustomer", "c.oid", "inner"),
        Edge("s", "supplier", "l.mySupplier", "s.oid"),
        Edge("cn", "nation", "c.myNation", "cn.oid"),
        Edge("sn", "nation", "s.myNation", "sn.oid"),
    ]
    return star_join(_as_objects(spark, sf), ("l", "line"), edges).select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.col("cn.n_name").alias("customer_nation"), F.col("sn.n_name").alias("supplier_nation"),
    )


@query(
    "union_by_position",
    """SELECT 'Event' AS kind, event_id AS id, user_id AS owner, ts AS happened FROM events
UNION ALL SELECT 'Order', o_orderkey, o_custkey, o_orderdate FROM orders""",
)
def union_by_position(spark, sf):
    events = read(spark, sf, "events").select(
        F.lit("Event").alias("kind"), F.col("event_id").alias("id"), F.col("user_id").alias("owner"), F.col("ts").alias("happened")
    )
    placed = read(spark, sf, "orders").select(F.lit("Order"), "o_orderkey", "o_custkey", "o_orderdate")
    return events.unionAll(placed)


# --- numbering and uniqueness --------------------------------------------------------------------


RANK_SQL = """SELECT l_suppkey, l_returnflag, l_shipdate, l_orderkey, l_linenumber, l_partkey,
  row_number() OVER (PARTITION BY l_suppkey, l_returnflag
    ORDER BY l_shipdate ASC NULLS LAST, l_orderkey, l_linenumber, l_partkey) AS first_rank FROM lineitem"""


@query("first_engaged_rank", RANK_SQL)
def first_engaged_rank(spark, sf):
    lines = read(spark, sf, "lineitem").select(
        "l_suppkey", "l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"
    )
    return number_rows(
        lines,
        ["l_suppkey", "l_returnflag"],
        ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"],
        "first_rank",
    )


@query("first_engaged_rank_sliced", RANK_SQL)
def first_engaged_rank_sliced(spark, sf):
    """As above above a join, whose shuffle by the supplier must not stand in for the one by slices."""
    lines = read(spark, sf, "lineitem").select(
        "l_suppkey", "l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"
    )
    suppliers = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"))
    return number_rows(
        lines.join(suppliers, "l_suppkey"),
        ["l_suppkey", "l_returnflag"],
        ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"],
        "first_rank",
    )


@query(
    "granularity_check",
    "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def granularity_check(spark, sf):
    return duplicate_keys(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "hub_conform_audit",
    """WITH v AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
h AS (SELECT c_custkey AS cust_no, c_name AS cust_name, CASE WHEN c_nationkey < 5 THEN NULL ELSE c_mktsegment END AS segment,
  n AS record_version_no FROM customer LEFT JOIN v ON c_custkey = o_custkey)
SELECT cust_no, cust_name, segment, record_version_no,
  sha256(concat_ws(chr(1), CAST(cust_no AS VARCHAR), coalesce(cust_name, chr(2)), coalesce(segment, chr(2)))) AS rec_sha,
  DATE '2024-03-09' AS active_dt, '202403' AS active_ym, DATE '2024-04-01' AS load_dt, 'PIMS' AS source_system_cd
FROM h""",
)
def hub_conform_audit(spark, sf):
    versions = version_counts(read(spark, sf, "orders"), ["o_custkey"])
    rows = read(spark, sf, "customer").selectExpr(
        "c_custkey AS cust_no",
        "c_name AS cust_name",
        "CASE WHEN c_nationkey < 5 THEN NULL ELSE c_mktsegment END AS segment",
        "TIMESTAMP '2024-03-09 10:00:00' AS _timestamp",
    )
    rows = rows.join(versions, F.col("cust_no") == F.col("o_custkey"), "left")
    audited = with_audit(rows, ["cust_no", "cust_name", "segment"], load_dt="2024-04-01")
    return conform(
        audited,
        {
            "cust_no": "bigint", "cust_name": "string", "segment": "string", "record_version_no": "bigint",
            "rec_sha": "string", "active_dt": "date", "active_ym": "string", "load_dt": "date",
            "source_system_cd": "string",
        },
    )


# --- hub jobs ------------------------------------------------------------------------------------


def _names(specs) -> list[str]:
    return [short_name(s.name) for s in specs]


def _ref(left: str, right: str) -> str:
    return f"{left}_clsno = {right}_clsno AND {left}_instid = {right}_instid"


@query(
    "activity_details",
    f"""WITH {sql_logs(_names(activity.TABLES))}
SELECT e.aUniqueID AS conev_id, c.aClaimNumber AS clm_no, a.aUniqueID AS acc_no, p.aPolicyNumber AS pol_no,
  u.aUserID AS user_id, e.aDateTime AS conev_acc_comm_dt, CAST(NULL AS VARCHAR) AS conev_acc_comm_frm,
  CAST(NULL AS VARCHAR) AS conev_acc_comms_to, e.aHeader AS conev_acc_comm_subj,
  CAST(NULL AS VARCHAR) AS conev_acc_comm_doc_type, m.aDescription AS conev_acc_comm_meth,
  r.aDescription AS conev_acc_comm_reason, s.aDescription AS conev_acc_comm_status,
  t.aDescription AS conev_acc_comm_type, CAST(NULL AS VARCHAR) AS conev_acc_comm_dist_not_verfd,
  CAST(NULL AS VARCHAR) AS conev_acc_comm_frm_user_team
FROM s_dl_TIMContactEvent e
JOIN s_dl_CTPAccident a ON {_ref('e.myAccident', 'a.oid')}
JOIN s_dl_TIMPolicyClaim c ON {_ref('c.myAccident', 'a.oid')}
LEFT JOIN s_dl_TIMPolicy p ON {_ref('c.myPolicy', 'p.oid')}
LEFT JOIN s_dl_TIMContactEventMethod m ON {_ref('e.myContactEventMethod', 'm.oid')}
LEFT JOIN s_dl_TIMContactEventReason r ON {_ref('e.myContactEventReason', 'r.oid')}
LEFT JOIN s_dl_TIMContactEventType t ON {_ref('e.myContactEventType', 't.oid')}
LEFT JOIN s_dl_TIMContactEventStatus s ON {_ref('e.myContactEventStatus', 's.oid')}
LEFT JOIN s_dl_TIMContactTypeUser u ON {_ref('e.myUser', 'u.oid')}
LEFT JOIN s_dl_TIMContactIndividual i ON {_ref('e.myContactToFrom', 'i.oid')}""",
)
def activity_details(spark, sf):
    inputs = logs(spark, sf, _names(activity.TABLES))
    return activity.activity_details(load_snapshots(spark, activity.TABLES, "", read=reader_of(inputs)))


def _history_sql(relation) -> str:
    """Both branches over `relation(table)`."""
    r = relation
    return f"""SELECT a.aUniqueID AS wrkflw_no, c.aClaimNumber AS clm_no, h.oid_instid AS hist_id,
  'Activity History' AS wrkflw_hist_type, h._timestamp AS wrkflw_hist_time_dt, u.aKey AS wrkflw_hist_user,
  h.aPrevReferStatus AS wrkflw_hist_frm_stat, h.aNewReferStatus AS wrkflw_hist_to_stat, n.aName AS wrkflw_hist_rs
FROM {r('dl_TIMWflProcess')} p JOIN {r('dl_TIMPolicyClaim')} c ON {_ref('p.myClaim', 'c.oid')}
JOIN {r('dl_TIMWflActivity')} a ON {_ref('a.myWflProcess', 'p.oid')}
JOIN {r('dl_CONWflForwardHistoryUpdate')} h ON {_ref('h.myHistoriedComponent', 'a.oid')}
LEFT JOIN {r('dl_TIMContactTypeUser')} u ON {_ref('h.myCreatedBy', 'u.oid')}
LEFT JOIN {r('dl_CONWflReferralChangeReason')} n ON {_ref('h.myChangeReason', 'n.oid')}
UNION ALL
SELECT p.aUniqueID, c.aClaimNumber, h.oid_instid, 'Process History', h.aLastModified, u.aKey, f.aName, t.aName, n.aName
FROM {r('dl_TIMWflProcess')} p JOIN {r('dl_TIMPolicyClaim')} c ON {_ref('p.myClaim', 'c.oid')}
JOIN {r('dl_CONWflStateHistoryUpdate')} h ON {_ref('h.myHistoriedComponent', 'p.oid')}
LEFT JOIN {r('dl_TIMContactTypeUser')} u ON {_ref('h.myCreatedBy', 'u.oid')}
LEFT JOIN {r('dl_CONWflProcessState')} f ON {_ref('h.myPreviousState', 'f.oid')}
LEFT JOIN {r('dl_CONWflProcessState')} t ON {_ref('h.myNewState', 't.oid')}
LEFT JOIN {r('dl_CONWflStateChangeReason')} n ON {_ref('h.myChangeReason', 'n.oid')}"""


HISTORY_NAMES = _names(history.LOG_TABLES)


def _plain_time(df):
    """Without a time zone, as DuckDB gives it."""
    return df.withColumn("wrkflw_hist_time_dt", F.col("wrkflw_hist_time_dt").cast("timestamp_ntz"))


@query(
    "workflow_history_rank",
    f"""WITH {sql_logs(HISTORY_NAMES)},
{", ".join(f"r_{n} AS ({sql_latest(n, OID, 'rank')})" for n in HISTORY_NAMES)}
{_history_sql(lambda n: f'r_{n}')}""",
)
def workflow_history_rank(spark, sf):
    return _plain_time(history.workflow_history_of_logs(logs(spark, sf, HISTORY_NAMES), "rank"))


@query(
    "workflow_history_filter_only",
    f"""WITH {sql_logs(HISTORY_NAMES)},
{", ".join(f"f_{n} AS (SELECT * FROM {n} WHERE {'true' if n == history.PROCESS_TABLE else "_operation <> 'D'"})" for n in HISTORY_NAMES)}
{_history_sql(lambda n: f'f_{n}')}""",
)
def workflow_history_filter_only(spark, sf):
    return _plain_time(history.workflow_history_of_logs(logs(spark, sf, HISTORY_NAMES), "none"))


@query(
    "legal_contacts",
    f"""WITH {sql_logs(_names(legal.TABLES))}
SELECT coalesce(c.aClaimNumber, '') AS clm_no, TRY_CAST(c.aDateInitialConsultSolicitor AS DATE) AS legl_consultatn_dt,
  TRY_CAST(k.aDateEngaged AS DATE) AS legl_rep_date, coalesce(s.aCode, '') AS "legl_aCode",
  coalesce(s.aDescription, '') AS "legl_subCategory", concat_ws('', 'ClaimLink - ', s.aDescription) AS legl_contact_type,
  TRY_CAST(l.aKey AS INT) AS "legl_Contact_Id", c.aLitDefendantCounsel AS legl_defendnt_counsel,
  c.aLitPlaintiffCounsel AS legl_plntif_counsel, r.aDescription AS legl_defendnt_refrl_type,
  row_number() OVER (PARTITION BY k.myClaim_clsno, k.myClaim_instid, k.myContactTypeSubCategory_clsno,
    k.myContactTypeSubCategory_instid ORDER BY k.aDateEngaged NULLS LAST, k._timestamp NULLS LAST,
    k.oid_instid NULLS LAST) AS legl_rank_first, 'PIMS' AS source
FROM s_dl_TIMClaimContactType k
JOIN s_dl_TIMPolicyClaim c ON {_ref('k.myClaim', 'c.oid')}
JOIN s_dl_TIMContactTypeSubcategory s ON {_ref('k.myContactTypeSubCategory', 's.oid')}
LEFT JOIN s_dl_TIMContactTypeClaimLink l ON {_ref('k.myContactType', 'l.oid')}
LEFT JOIN s_dl_TIMLitigationReferralType r ON {_ref('c.myLitReferralType', 'r.oid')}""",
)
def legal_contacts(spark, sf):
    return legal.legal_contacts_of_logs(logs(spark, sf, _names(legal.TABLES)))


CLAIM_VALUES = {
    "clm_no": "c.aClaimNumber",
    "acc_no": "a.aUniqueID",
    "clm_rs_for_decline": "d.aDescription",
    "clm_s5_complnce_does_s5_apply": "c.aDoesS5Apply",
    "clm_initial_consult_gp_dt": "TRY_CAST(c.aDateIniialConsultGP AS DATE)",
    "clm_initial_consult_solicitor_dt": "TRY_CAST(c.aDateInitialConsultSolicitor AS DATE)",
    "clm_limitatn_extnded_to_dt": "TRY_CAST(c.aDateLimitationExtendedTo AS DATE)",
    "clm_aif_reqst_dt": "TRY_CAST(c.aAIFRequestedDate AS DATE)",
    "clm_assistnce_completng_icf": "c.aHasClaimFormEntryAssistance",
    "clm_escalated": "c.aIsEscalatedClaim",
    "clm_entrd_dt": "TRY_CAST(c.aDateTimeEntered AS DATE)",
    "clm_stat": "st.aDescription",
    "clm_high_care_flg": "c.aCareType",
    "clm_stat_cd": "st.aCode",
    "clm_limitatn_extnded_by": "c.aLimitationExtendedBy",
    "clm_noac_rpted_dt": "TRY_CAST(c.aDateNOACFirstReported AS DATE)",
    "clm_noac_s39_1b_follow_up_stat": "c.aNOACS39FollowUpStatus",
    "clm_nominal_defendnt_pct": "c.aNominalDefendantPerc",
    "clm_notable_significnt": "c.aIsNotableAndSignificantClaim",
    "clm_form_notice_of_claim_rcvd_dt": "TRY_CAST(c.aDateClaimFormsReceived AS DATE)",
    "clm_first_fnlised_dt": "TRY_CAST(c.aDateFirstFinalised AS DATE)",
    "clm_status_dt": "TRY_CAST(c.aClaimStatusDate AS DATE)",
    "clm_reopened_dt": "TRY_CAST(c.aDateReopened AS DATE)",
    "clm_unreas_con": "c.aIsUnreasonableContact",
    "clm_acc_fault_notifcn_form": "c.aANFAtFault",
    "clm_first_resp_noac_complnce_cd": "c.aNOACFirstResponseCode",
    "clm_first_resp_noac_complnce_dt": "TRY_CAST(c.aDateNOACFirstResponse AS DATE)",
    "clm_wc_recov_dt": "TRY_CAST(c.aWorkcoverSOCRECDate AS DATE)",
    "clm_last_con_clmnt_dt": "TRY_CAST(c.aDateLastContClaimant AS DATE)",
    "clm_fincl_hardshp_paymt_req_amt": "c.aS84AHardshipPayment",
    "clm_fincl_hardshp_paymt_req_dt": "TRY_CAST(c.aS84AHardshipRequestDate AS DATE)",
    "clm_noac_satisfied_dt": "TRY_CAST(c.aDateNOACSatisfied AS DATE)",
    "clm_interim_pymt": "c.aInterimPayments",
    "clm_persn_assistng_icf_completn": "c.aClaimFormEntryAssistantName",
    "clm_mangng_state": "z.aName",
    "clm_nominal_defendnt_ref_no": "c.aNominalDefendantReference",
    "clm_prescrbd_auth_signd_dt": "TRY_CAST(c.aDatePrescribedAuthoritySigned AS DATE)",
    "clm_prescrbd_auth_valid": "c.aIsPrescribedAuthority",
    "clm_prescrbd_auth_valid_to_dt": "TRY_CAST(c.aDatePrescribedAuthorityValidTo AS DATE)",
    "clm_rs_icf_completn_assistnce_reqrd": "c.aClaimFormEntryAssistanceReason",
    "clm_reopen_rs_pir_cd": "ro.aCode",
    "clm_reopen_rs": "ro.aDescription",
    "clm_satisfactry_aif_rcvd_dt": "TRY_CAST(c.aSatisfactoryAIFRecvDate AS DATE)",
    "clm_wc_recov": "c.aWorkcoverRecovery",
}


def _claims_sql() -> str:
    empty = {c: f"CAST(NULL AS {'DATE' if t == 'date' else 'VARCHAR'})" for c, t in claims.BUSINESS_TYPES.items()}
    values = ", ".join(f'{CLAIM_VALUES.get(c, e)} AS "{c}"' for c, e in empty.items())
    hashed = ", ".join(f'coalesce(CAST("{c}" AS VARCHAR), chr(2))' for c in empty)
    names = _names(claims.TABLES)
    return f"""WITH {sql_logs([n for n in names if n != 'dl_TIMProfileHistoryStatus'])},
dl_TIMProfileHistoryStatus AS ({sql_text(LOGS['dl_TIMProfileHistoryStatus'])}),
changes AS ({sql_latest('dl_TIMProfileHistoryStatus', 'myClaim_clsno, myClaim_instid')}),
versions AS (SELECT oid_clsno, oid_instid, count(*) AS n FROM dl_TIMPolicyClaim GROUP BY ALL),
rows AS (SELECT {values}, v.n AS record_version_no, CAST(c._timestamp AS DATE) AS active_dt
  FROM s_dl_TIMPolicyClaim c JOIN versions v ON {_ref('c.oid', 'v.oid')}
  LEFT JOIN s_dl_CTPAccident a ON {_ref('c.myAccident', 'a.oid')}
  LEFT JOIN s_dl_TIMReasonForDecline d ON {_ref('c.myReasonForDecline', 'd.oid')}
  LEFT JOIN s_dl_TIMClaimStatus st ON {_ref('c.myClaimStatus', 'st.oid')}
  LEFT JOIN s_dl_TIMAddress ad ON {_ref('a.myAccidentLocation', 'ad.oid')}
  LEFT JOIN s_dl_TIMState z ON {_ref('ad.myState', 'z.oid')}
  LEFT JOIN changes h ON {_ref('h.myClaim', 'c.oid')}
  LEFT JOIN s_dl_TIMClaimStatusHistoryReopen ro ON {_ref('h.myStatusChangeReason', 'ro.oid')})
SELECT * , sha256(concat_ws(chr(1), {hashed})) AS rec_sha, strftime(active_dt, '%Y%m') AS active_ym,
  DATE '2024-04-01' AS load_dt, 'PIMS' AS source_system_cd FROM rows"""


@query("claims_hub", _claims_sql())
def claims_hub(spark, sf):
    return claims.claims_of_logs(logs(spark, sf, _names(claims.TABLES)), load_dt="2024-04-01")


@query(
    "claims_job",
    f"SELECT * EXCLUDE (load_dt) FROM ({_claims_sql()})",
)
def claims_job(spark, sf):
    """The registered job over the same logs; its load day is today."""
    inputs = logs(spark, sf, _names(claims.TABLES))
    return JOBS["claims"].build(spark, "test", reader_of(inputs)).drop("load_dt")


@query(
    "version_numbers",
    f"""SELECT {LINE_KEY} AS oid_instid, l_shipdate, l_partkey, row_number() OVER (PARTITION BY {LINE_KEY}
  ORDER BY l_shipdate ASC NULLS LAST, l_partkey ASC NULLS LAST, l_suppkey ASC NULLS LAST) AS record_version_no,
  l_suppkey FROM lineitem""",
)
def version_numbers(spark, sf):
    lines = read(spark, sf, "lineitem").select(
        F.expr(LINE_KEY).alias("oid_instid"), "l_shipdate", "l_partkey", "l_suppkey"
    )
    return number_rows(
        lines,
        ["oid_instid"],
        ["l_shipdate", "l_partkey", "l_suppkey"],
        "record_version_no",
    )
