"""Inputs of the jobs, derived from the test tables.

Each is one SELECT in the part of SQL that Spark and DuckDB share; `{orders}` stands for a table. The
stand-ins grow with the tables, so every query over them does.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tablejobs.plans.claims import CLAIM_ATTRIBUTES, CLAIM_REFERENCES

RUN_DATE = "2001-08-01"

# All orders as usable sales; product divisions 10 to 16, of which some have no name.
SALES = """
SELECT 10000000 + o_custkey AS indiv_id, o_orderdate AS txn_dt,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'A' ELSE 'F' END AS prch_chnl_cd,
       'Y' AS fin_own_lease_ind,
       CASE WHEN o_orderstatus = 'P' THEN 71 ELSE 77 END AS rtl_divn_nbr,
       CAST(10 + o_orderkey % 7 AS INT) AS pdiv_id,
       o_orderpriority AS dept_vnd_cd, o_orderstatus AS vst_cd
FROM {orders}
"""

# All orders, some of them unusable for each of the reasons a sale can be.
MIXED_SALES = """
SELECT CASE WHEN o_totalprice < 20000 THEN NULL WHEN o_totalprice < 30000 THEN 1
            WHEN o_totalprice < 60000 THEN o_custkey ELSE 10000000 + o_custkey END AS indiv_id,
       o_orderdate AS txn_dt,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'A' WHEN o_orderpriority = '2-HIGH' THEN 'X' ELSE 'F' END
           AS prch_chnl_cd,
       CASE WHEN o_totalprice > 450000 THEN 'N' ELSE 'Y' END AS fin_own_lease_ind,
       CASE WHEN o_orderstatus = 'P' THEN 71 WHEN o_totalprice > 400000 THEN 80 ELSE 77 END AS rtl_divn_nbr,
       CASE WHEN o_totalprice < 100000 THEN NULL WHEN o_totalprice < 150000 THEN 0
            WHEN o_totalprice < 200000 THEN 65 ELSE CAST(10 + o_orderkey % 7 AS INT) END AS pdiv_id,
       NULLIF(o_orderpriority, '5-LOW') AS dept_vnd_cd,
       CASE WHEN o_orderdate < TIMESTAMP '1996-01-01 00:00:00' THEN NULL ELSE o_orderstatus END AS vst_cd
FROM {orders}
"""

EVENT_CODE = "CASE WHEN event_type = 'error' THEN 'D' WHEN event_type = 'signup' THEN 'I' ELSE 'U' END"

# Events as the change log of their users.
USER_LOG = f"""
SELECT 1 AS oid_clsno, user_id AS oid_instid, ts AS _timestamp, {EVENT_CODE} AS _operation,
       event_id AS aEventId, event_type AS aHeader, value AS aValue, props AS aProps
FROM {{events}}
"""

# The same cut to days, which makes many versions tie.
USER_DAY_LOG = f"""
SELECT 1 AS oid_clsno, user_id AS oid_instid, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS _timestamp,
       {EVENT_CODE} AS _operation, event_id AS aEventId, event_type AS aHeader
FROM {{events}}
"""

# Attributes of claims that hold dates.
CLAIM_DATES = [a for a in CLAIM_ATTRIBUTES.split() if "Date" in a or a in ("aDateS110",)]

FIXED_TIME = "TIMESTAMP '2024-01-01 00:00:00' AS _timestamp, 'U' AS _operation"


def _claim_log() -> str:
    """Orders as claims, two versions per key. Every attribute and reference has values of its own."""
    own = {
        "aClaimNumber": "concat('C', CAST(o_orderkey AS STRING))",
        "aDateInitialConsultSolicitor": "CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown' "
        "ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
        "aDateTimeEntered": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
        "aCareType": "o_orderpriority",
        "aDescription": "o_orderstatus",
    }
    references = {
        "CaseManager": (31, "o_custkey % 11"),
        "IMA": (32, "o_custkey % 12"),
        "InjuredWorker": (33, "o_custkey"),
        "ProcessingCentre": (34, "o_custkey % 13"),
        "WCInsurer": (35, "o_custkey % 14"),
        "Accident": (2, "o_custkey"),
        "Policy": (4, "o_custkey"),
        "ClaimStatus": (23, "o_custkey % 25"),
        "ReasonForDecline": (24, "o_orderkey % 30"),
        "ClaimProfile": (25, "o_orderkey % 5"),
        "LiabilityRejectReason": (26, "o_orderkey % 7"),
        "LitReferralType": (21, "o_custkey % 7"),
    }
    parts = [
        "3 AS oid_clsno",
        "o_orderkey - o_orderkey % 2 AS oid_instid",
        "o_orderdate + (o_orderkey % 2) * INTERVAL '1' SECOND AS _timestamp",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 'D' ELSE 'U' END AS _operation",
        "o_orderpriority AS aLitDefendantCounsel",
        "o_orderstatus AS aLitPlaintiffCounsel",
    ]
    for i, a in enumerate(CLAIM_ATTRIBUTES.split()):
        text = f"concat('v{i}-', CAST(o_orderkey % {i + 7} AS STRING))"
        if a in CLAIM_DATES:
            text = f"CAST(CAST(o_orderdate AS DATE) + {i} AS STRING)"
        parts.append(f"{own.get(a, f'CASE WHEN o_orderkey % {i + 3} <> 0 THEN {text} END')} AS {a}")
    for name in [*CLAIM_REFERENCES.split(), "LitReferralType"]:
        clsno, instid = references[name]
        parts += [f"{clsno} AS my{name}_clsno", f"{instid} AS my{name}_instid"]
    return f"SELECT {', '.join(parts)} FROM {{orders}}"


def _nation_log(clsno: int, column: str = "aDescription", code: str = "n_name") -> str:
    return f"SELECT {clsno} AS oid_clsno, n_nationkey AS oid_instid, {FIXED_TIME}, {code} AS {column} FROM {{nation}}"


LINE_KEY = "l_orderkey * 8 + l_linenumber"
LINE_TIME = "l_shipdate + l_partkey * INTERVAL '1' SECOND AS _timestamp"

LOGS = {
    "dl_TIMPolicyClaim": _claim_log(),
    "dl_TIMContactEvent": f"""
SELECT 1 AS oid_clsno, event_id - event_id % 2 AS oid_instid, ts AS _timestamp, {EVENT_CODE} AS _operation,
       concat('EV', CAST(event_id AS STRING)) AS aUniqueID, ts AS aDateTime, event_type AS aHeader,
       2 AS myAccident_clsno, user_id AS myAccident_instid,
       5 AS myContactEventMethod_clsno, user_id % 30 AS myContactEventMethod_instid,
       6 AS myContactEventReason_clsno, event_id % 28 AS myContactEventReason_instid,
       7 AS myContactEventType_clsno, event_id % 4 AS myContactEventType_instid,
       8 AS myContactEventStatus_clsno,
       CASE WHEN event_type = 'view' THEN NULL ELSE event_id % 3 END AS myContactEventStatus_instid,
       9 AS myUser_clsno, user_id % 20 AS myUser_instid,
       10 AS myContactToFrom_clsno, user_id AS myContactToFrom_instid
FROM {{events}}""",
    "dl_CTPAccident": f"""
SELECT 2 AS oid_clsno, c_custkey AS oid_instid, {FIXED_TIME}, c_name AS aUniqueID,
       CAST(NULL AS STRING) AS aDateTimeOfAccident, 22 AS myAccidentLocation_clsno,
       c_custkey AS myAccidentLocation_instid
FROM {{customer}}""",
    "dl_TIMPolicy": f"""
SELECT 4 AS oid_clsno, c_custkey AS oid_instid, {FIXED_TIME}, concat('P', CAST(c_custkey AS STRING)) AS aPolicyNumber
FROM {{customer}}""",
    "dl_TIMContactEventMethod": _nation_log(5),
    "dl_TIMContactEventReason": _nation_log(6),
    "dl_TIMContactEventType": _nation_log(7),
    "dl_TIMContactEventStatus": _nation_log(8),
    "dl_TIMContactTypeUser": f"""
SELECT 9 AS oid_clsno, s_suppkey AS oid_instid, {FIXED_TIME}, s_name AS aUserID, CAST(s_suppkey AS STRING) AS aKey
FROM {{supplier}}""",
    "dl_TIMContactIndividual": f"""
SELECT 10 AS oid_clsno, c_custkey AS oid_instid, {FIXED_TIME}, c_name AS aUniqueID FROM {{customer}}""",
    "dl_TIMWflProcess": """
SELECT 11 AS oid_clsno, o_orderkey AS oid_instid, o_orderdate AS _timestamp,
       CASE WHEN o_orderstatus = 'F' THEN 'D' ELSE 'U' END AS _operation,
       concat('W', CAST(o_orderkey AS STRING)) AS aUniqueID,
       3 AS myClaim_clsno, o_orderkey - o_orderkey % 2 AS myClaim_instid
FROM {orders}""",
    "dl_TIMWflActivity": f"""
SELECT 12 AS oid_clsno, {LINE_KEY} AS oid_instid, l_shipdate AS _timestamp,
       CASE WHEN l_returnflag = 'A' THEN 'D' ELSE 'U' END AS _operation,
       concat('A', CAST(l_partkey AS STRING)) AS aUniqueID,
       11 AS myWflProcess_clsno, l_orderkey AS myWflProcess_instid
FROM {{lineitem}}""",
    "dl_CONWflForwardHistoryUpdate": f"""
SELECT 13 AS oid_clsno, {LINE_KEY} AS oid_instid, l_shipdate AS _timestamp,
       CASE WHEN l_tax = 0 THEN NULL ELSE 'U' END AS _operation,
       l_returnflag AS aPrevReferStatus, l_linestatus AS aNewReferStatus,
       12 AS myHistoriedComponent_clsno, {LINE_KEY} AS myHistoriedComponent_instid,
       9 AS myCreatedBy_clsno, l_suppkey AS myCreatedBy_instid,
       14 AS myChangeReason_clsno, l_partkey % 40 AS myChangeReason_instid
FROM {{lineitem}}""",
    "dl_CONWflReferralChangeReason": _nation_log(14, "aName"),
    "dl_CONWflStateHistoryUpdate": f"""
SELECT 15 AS oid_clsno, event_id AS oid_instid, ts AS _timestamp, {EVENT_CODE} AS _operation, ts AS aLastModified,
       11 AS myHistoriedComponent_clsno, event_id AS myHistoriedComponent_instid,
       9 AS myCreatedBy_clsno, user_id AS myCreatedBy_instid,
       16 AS myPreviousState_clsno, user_id % 25 AS myPreviousState_instid,
       16 AS myNewState_clsno, event_id % 25 AS myNewState_instid,
       17 AS myChangeReason_clsno, event_id % 30 AS myChangeReason_instid
FROM {{events}}""",
    "dl_CONWflProcessState": _nation_log(16, "aName"),
    "dl_CONWflStateChangeReason": _nation_log(17, "aName"),
    "dl_TIMClaimContactType": f"""
SELECT 18 AS oid_clsno, {LINE_KEY} AS oid_instid, {LINE_TIME},
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'D' ELSE 'U' END AS _operation,
       CASE WHEN l_tax = 0 THEN 'not known' WHEN l_discount = 0 THEN NULL
            ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS aDateEngaged,
       3 AS myClaim_clsno, l_orderkey - l_orderkey % 2 AS myClaim_instid,
       19 AS myContactTypeSubCategory_clsno, l_suppkey % 3 AS myContactTypeSubCategory_instid,
       20 AS myContactType_clsno, l_partkey * 2 AS myContactType_instid
FROM {{lineitem}}""",
    "dl_TIMContactTypeSubcategory": f"""
SELECT 19 AS oid_clsno, n_nationkey AS oid_instid, {FIXED_TIME}, concat('N', CAST(n_nationkey AS STRING)) AS aCode,
       CASE WHEN n_regionkey = 1 THEN NULL ELSE n_name END AS aDescription
FROM {{nation}}""",
    "dl_TIMContactTypeClaimLink": f"""
SELECT 20 AS oid_clsno, p_partkey AS oid_instid, {FIXED_TIME},
       CASE WHEN p_size > 40 THEN concat('x', CAST(p_size AS STRING)) ELSE CAST(p_size AS STRING) END AS aKey
FROM {{part}}""",
    "dl_TIMLitigationReferralType": f"""
SELECT 21 AS oid_clsno, r_regionkey AS oid_instid, {FIXED_TIME}, r_name AS aDescription FROM {{region}}""",
    "dl_TIMAddress": f"""
SELECT 22 AS oid_clsno, c_custkey AS oid_instid, {FIXED_TIME}, CAST(NULL AS STRING) AS aPostCode,
       CAST(NULL AS STRING) AS aStreetName, CAST(NULL AS STRING) AS aStreetNumber, CAST(NULL AS STRING) AS aUnitNumber,
       27 AS myState_clsno, c_nationkey AS myState_instid,
       CAST(NULL AS INT) AS myStreetType_clsno, CAST(NULL AS BIGINT) AS myStreetType_instid,
       CAST(NULL AS INT) AS mySuburb_clsno, CAST(NULL AS BIGINT) AS mySuburb_instid
FROM {{customer}}""",
    "dl_TIMState": _nation_log(27, "aName"),
    "dl_TIMProfileHistoryStatus": f"""
SELECT 28 AS oid_clsno, {LINE_KEY} AS oid_instid, {LINE_TIME},
       CASE WHEN l_returnflag = 'A' THEN 'D' ELSE 'U' END AS _operation,
       3 AS myClaim_clsno, l_orderkey - l_orderkey % 2 AS myClaim_instid,
       29 AS myStatusChangeReason_clsno, l_suppkey % 25 AS myStatusChangeReason_instid
FROM {{lineitem}}""",
    "dl_TIMClaimStatusHistoryReopen": f"""
SELECT 29 AS oid_clsno, n_nationkey AS oid_instid, {FIXED_TIME}, concat('R', CAST(n_nationkey AS STRING)) AS aCode,
       n_name AS aDescription
FROM {{nation}}""",
    "dl_TIMClaimStatusHistoryFinalise": f"""
SELECT 30 AS oid_clsno, n_nationkey AS oid_instid, {FIXED_TIME}, concat('F', CAST(n_nationkey AS STRING)) AS aCode,
       n_name AS aDescription
FROM {{nation}}""",
    "dl_TIMClaimStatus": f"""
SELECT 23 AS oid_clsno, n_nationkey AS oid_instid, {FIXED_TIME}, concat('S', CAST(n_nationkey AS STRING)) AS aCode,
       n_name AS aDescription
FROM {{nation}}""",
    "dl_TIMReasonForDecline": _nation_log(24),
    "dl_CARClaimProfileCode": _nation_log(25),
    "dl_TIMLiabilityRejectReason": _nation_log(26),
}

# One report per event: a test case named after the event, a run named after its user's file.
REPORTS = """
SELECT event_id,
       concat('{{"test_case_report": {{"TC_', CAST(event_id AS STRING), '": {{"description": "', event_type,
              '", "result": "', CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'PASS' END,
              '", "error": "', CASE WHEN event_type = 'error' THEN 'bad input' ELSE 'null' END,
              '"}}}}, "adf_run_details": {{"user_', CAST(user_id AS STRING), '.txt": {{"id": "run-',
              CAST(event_id AS STRING), '", "run_status": "Succeeded", "message": "", "run_duration": ',
              CAST(event_id % 100 AS STRING), '.5}}}}}}') AS report
FROM {events}
"""


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stand_in(spark: SparkSession, sf: str, text: str) -> DataFrame:
    names = set(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", text))
    return spark.sql(text, **{n: read(spark, sf, n) for n in names})


def logs(spark: SparkSession, sf: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {n: stand_in(spark, sf, LOGS[n]) for n in names}


class _SameName(dict):
    def __missing__(self, key: str) -> str:
        return key


def sql_text(text: str) -> str:
    """The stand-in for DuckDB, where tables go by their own names."""
    return text.format_map(_SameName())


def sql_logs(names: Iterable[str]) -> str:
    """WITH entries: every log as `name`, its snapshot as `s_name`."""
    entries = []
    for name in names:
        entries.append(f"{name} AS ({sql_text(LOGS[name])})")
        entries.append(f"s_{name} AS ({sql_latest(name, 'oid_clsno, oid_instid')})")
    return ",\n".join(entries)


def sql_latest(table: str, keys: str, number: str = "row_number") -> str:
    return (
        f"SELECT * EXCLUDE (rnk) FROM (SELECT *, {number}() OVER (PARTITION BY {keys} "
        f"ORDER BY _timestamp DESC NULLS LAST) AS rnk FROM {table}) WHERE rnk = 1 AND _operation <> 'D'"
    )
