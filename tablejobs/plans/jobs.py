"""The hub jobs by name."""

from __future__ import annotations

from tablejobs.plans import activity, claims, history, legal
from tablejobs.plans.hub import PARTITIONS, HubJob

# Target tables and input databases are neutral names; `HubJob.located` puts a site's own in their place. Uniqueness keys are
# fixed values.
JOBS = {
    job.name: job
    for job in (
        HubJob(
            "activity_details",
            activity.TABLES,
            activity.activity_details,
            activity.TARGET,
            "{db_env}_hub.workflow_activity_details",
        ),
        HubJob(
            "workflow_history",
            history.tables_for("none"),
            history.workflow_history,
            history.TARGET,
            "{db_env}_hub.workflow_history",
            dedup="none",
        ),
        HubJob(
            "legal_contacts",
            legal.TABLES,
            legal.legal_contacts,
            legal.TARGET,
            "{db_env}_hub.legal_contacts",
            ("source", "clm_no", "legl_aCode", "legl_rank_first"),
        ),
        HubJob(
            "claims",
            claims.TABLES,
            claims.claims,
            claims.TARGET,
            "{db_env}_hub.claims",
            claims.GRANULARITY,
            PARTITIONS,
            versioned="dl_TIMPolicyClaim",
        ),
    )
}
