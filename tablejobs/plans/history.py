"""Workflow history: referrals of workflow activities and state changes of workflow processes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.operators.joins import Edge, require_tables, star_join
from tablejobs.sources.snapshots import NOT_DELETED, TableSpec, load_snapshots, log_table, reader_of, short_name

# Input tables with the columns the job reads. Processes come from a second database.
LOG_TABLES = (
    log_table("dl_TIMWflProcess", "aUniqueID", "Claim", database="{db_env}_workflow"),
    log_table("dl_TIMPolicyClaim", "aClaimNumber", "Accident Policy"),
    log_table("dl_TIMWflActivity", "aUniqueID", "WflProcess"),
    log_table(
        "dl_CONWflForwardHistoryUpdate", "aPrevReferStatus aNewReferStatus", "HistoriedComponent CreatedBy ChangeReason"
    ),
    log_table("dl_CONWflReferralChangeReason", "aName"),
    log_table(
        "dl_CONWflStateHistoryUpdate", "aLastModified", "HistoriedComponent CreatedBy PreviousState NewState ChangeReason"
    ),
    log_table("dl_CONWflProcessState", "aName"),
    log_table("dl_CONWflStateChangeReason", "aName"),
    log_table("dl_TIMContactTypeUser", "aKey"),
)

PROCESS_TABLE = "dl_TIMWflProcess"

# Processes get their claims and activities their processes first: what is moved for it is narrower than the changes, which
# are then moved once.
PROCESS_EDGES = (Edge("claim", "dl_TIMPolicyClaim", "process.myClaim", "claim.oid", "inner"),)
ACTIVITY_EDGES = (Edge("process", "processes", "activity.myWflProcess", "process.oid", "inner"),)
REFERRAL_EDGES = (
    Edge("subject", "activities", "change.myHistoriedComponent", "subject.oid", "inner"),
    Edge("reason", "dl_CONWflReferralChangeReason", "change.myChangeReason", "reason.oid"),
)
STATE_EDGES = (
    Edge("subject", "processes", "change.myHistoriedComponent", "subject.oid", "inner"),
    Edge("old_state", "dl_CONWflProcessState", "change.myPreviousState", "old_state.oid"),
    Edge("new_state", "dl_CONWflProcessState", "change.myNewState", "new_state.oid"),
    Edge("reason", "dl_CONWflStateChangeReason", "change.myChangeReason", "reason.oid"),
)
AUTHOR_EDGES = (Edge("author", "dl_TIMContactTypeUser", "change.myCreatedBy", "author.oid"),)

# Output columns with their types, and the names of the two kinds of history.
TARGET = {
    "wrkflw_no": "string",
    "clm_no": "string",
    "hist_id": "bigint",
    "wrkflw_hist_type": "string",
    "wrkflw_hist_time_dt": "timestamp",
    "wrkflw_hist_user": "string",
    "wrkflw_hist_frm_stat": "string",
    "wrkflw_hist_to_stat": "string",
    "wrkflw_hist_rs": "string",
}
ACTIVITY_HISTORY = "Activity History"
PROCESS_HISTORY = "Process History"


def tables_for(dedup: str = "none") -> tuple[TableSpec, ...]:
    """Input specs by route.

    `rank` and `row_number` take the latest versions and drop deleted keys. `none` trusts that the
    input has one version per key: it only filters deleted rows, and processes not even that.
    """
    if dedup != "none":
        return LOG_TABLES
    return tuple(
        replace(t, keys=(), condition=None if short_name(t.name) == PROCESS_TABLE else NOT_DELETED) for t in LOG_TABLES
    )


def _changes(
    ds: Mapping[str, DataFrame], table: str, edges: Sequence[Edge], kind: str, time: str, old: str, new: str
) -> DataFrame:
    """Changes of one kind in the layout of TARGET."""
    made = {
        "wrkflw_no": F.col("subject.number"),
        "clm_no": F.col("subject.aClaimNumber"),
        "hist_id": F.col("change.oid_instid"),
        "wrkflw_hist_type": F.lit(kind),
        "wrkflw_hist_time_dt": F.col(time).try_cast("timestamp"),
        "wrkflw_hist_user": F.col("author.aKey"),
        "wrkflw_hist_frm_stat": F.col(old).cast("string"),
        "wrkflw_hist_to_stat": F.col(new).cast("string"),
        "wrkflw_hist_rs": F.col("reason.aName"),
    }
    joined = star_join(ds, ("change", table), (*edges, *AUTHOR_EDGES))
    return joined.select(*[made[c].alias(c) for c in TARGET])


def workflow_history(ds: Mapping[str, DataFrame]) -> DataFrame:
    """Both histories from snapshots.

    Processes and their claims are joined once for both kinds. Their times come from different columns and are cast to one
    type.
    """
    require_tables(ds, [short_name(t.name) for t in LOG_TABLES])
    named = [F.col("process.oid_clsno"), F.col("process.oid_instid"), F.col("process.aUniqueID").alias("number")]
    processes = star_join(ds, ("process", PROCESS_TABLE), PROCESS_EDGES).select(*named, "claim.aClaimNumber")
    activities = star_join({**ds, "processes": processes}, ("activity", "dl_TIMWflActivity"), ACTIVITY_EDGES).select(
        "activity.oid_clsno", "activity.oid_instid", F.col("activity.aUniqueID").alias("number"), "process.aClaimNumber"
    )
    tables = {**ds, "processes": processes, "activities": activities}
    referrals = _changes(
        tables,
        "dl_CONWflForwardHistoryUpdate",
        REFERRAL_EDGES,
        ACTIVITY_HISTORY,
        time="change._timestamp",
        old="change.aPrevReferStatus",
        new="change.aNewReferStatus",
    )
    states = _changes(
        tables,
        "dl_CONWflStateHistoryUpdate",
        STATE_EDGES,
        PROCESS_HISTORY,
        time="change.aLastModified",
        old="old_state.aName",
        new="new_state.aName",
    )
    return referrals.unionByName(states)


def workflow_history_of_logs(logs: Mapping[str, DataFrame], dedup: str = "rank") -> DataFrame:
    """The same from change-log tables at hand; `rank` keeps all rows of a tied latest version."""
    require_tables(logs, [short_name(t.name) for t in LOG_TABLES])
    spark = next(iter(logs.values())).sparkSession
    return workflow_history(load_snapshots(spark, tables_for(dedup), "", dedup, reader_of(logs)))
