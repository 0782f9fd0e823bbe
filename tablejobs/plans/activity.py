"""Contact-event activity: one row per event and claim of the event's accident."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.functions.text import empty
from tablejobs.operators.joins import Edge, require_tables, star_join
from tablejobs.sources.snapshots import log_table, short_name

# Input tables with the columns the job reads.
TABLES = (
    log_table(
        "dl_TIMContactEvent",
        "aUniqueID aDateTime aHeader",
        "Accident ContactEventMethod ContactEventReason ContactEventType ContactEventStatus User ContactToFrom",
    ),
    log_table("dl_TIMPolicyClaim", "aClaimNumber", "Accident Policy"),
    log_table("dl_TIMPolicy", "aPolicyNumber"),
    log_table("dl_CTPAccident", "aUniqueId"),
    log_table("dl_TIMContactEventMethod", "aDescription"),
    log_table("dl_TIMContactEventReason", "aDescription"),
    log_table("dl_TIMContactEventType", "aDescription"),
    log_table("dl_TIMContactEventStatus", "aDescription"),
    log_table("dl_TIMContactIndividual", "aUniqueID"),
    log_table("dl_TIMContactTypeUser", "aUserID aKey"),
)

EDGES = (
    Edge("acc", "dl_CTPAccident", "ev.myAccident", "acc.oid", "inner"),
    Edge("clm", "dl_TIMPolicyClaim", "acc.oid", "clm.myAccident", "inner"),
    Edge("pol", "dl_TIMPolicy", "clm.myPolicy", "pol.oid"),
    Edge("meth", "dl_TIMContactEventMethod", "ev.myContactEventMethod", "meth.oid"),
    Edge("rsn", "dl_TIMContactEventReason", "ev.myContactEventReason", "rsn.oid"),
    Edge("typ", "dl_TIMContactEventType", "ev.myContactEventType", "typ.oid"),
    Edge("sts", "dl_TIMContactEventStatus", "ev.myContactEventStatus", "sts.oid"),
    Edge("usr", "dl_TIMContactTypeUser", "ev.myUser", "usr.oid"),
)

# Output columns in order with their sources; those without one are not defined yet.
OUTPUT = {
    "conev_id": "ev.aUniqueID",
    "clm_no": "clm.aClaimNumber",
    "acc_no": "acc.aUniqueId",
    "pol_no": "pol.aPolicyNumber",
    "user_id": "usr.aUserID",
    "conev_acc_comm_dt": "ev.aDateTime",
    "conev_acc_comm_frm": None,
    "conev_acc_comms_to": None,
    "conev_acc_comm_subj": "ev.aHeader",
    "conev_acc_comm_doc_type": None,
    "conev_acc_comm_meth": "meth.aDescription",
    "conev_acc_comm_reason": "rsn.aDescription",
    "conev_acc_comm_status": "sts.aDescription",
    "conev_acc_comm_type": "typ.aDescription",
    "conev_acc_comm_dist_not_verfd": None,
    "conev_acc_comm_frm_user_team": None,
}
TARGET = {name: "timestamp" if name == "conev_acc_comm_dt" else "string" for name in OUTPUT}


def activity_details(ds: Mapping[str, DataFrame]) -> DataFrame:
    """Activity rows from the snapshots of TABLES."""
    require_tables(ds, [short_name(t.name) for t in TABLES])
    joined = star_join(ds, ("ev", "dl_TIMContactEvent"), EDGES)
    return joined.select(
        *[(F.col(source) if source else empty("string")).alias(name) for name, source in OUTPUT.items()]
    )
