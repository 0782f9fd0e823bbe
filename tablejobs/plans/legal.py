"""Legal contacts of claims, numbered by the day they were engaged."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.functions.dates import parse_date
from tablejobs.functions.text import or_blank, parse_int, prefixed
from tablejobs.operators.joins import Edge, oid_join, require_tables, star_join
from tablejobs.operators.windows import number_rows
from tablejobs.plans.hub import SOURCE_SYSTEM
from tablejobs.sources.snapshots import load_snapshots, log_table, reader_of, short_name

# Input tables with the columns the job reads.
TABLES = (
    log_table("dl_TIMClaimContactType", "aDateEngaged", "Claim ContactTypeSubCategory ContactType"),
    log_table(
        "dl_TIMPolicyClaim",
        "aClaimNumber aDateInitialConsultSolicitor aLitDefendantCounsel aLitPlaintiffCounsel",
        "LitReferralType",
    ),
    log_table("dl_TIMContactTypeSubcategory", "aCode aDescription"),
    log_table("dl_TIMContactTypeClaimLink", "aKey"),
    log_table("dl_TIMLitigationReferralType", "aDescription"),
)
REQUIRED_EDGES = (
    Edge("claim", "dl_TIMPolicyClaim", "contact.myClaim", "claim.oid", "inner"),
    Edge("subcat", "dl_TIMContactTypeSubcategory", "contact.myContactTypeSubCategory", "subcat.oid", "inner"),
)
GROUP = (
    "myClaim_clsno",
    "myClaim_instid",
    "myContactTypeSubCategory_clsno",
    "myContactTypeSubCategory_instid",
)

# Output columns with their types, uniqueness keys, and the text before a contact type.
TARGET = {
    "clm_no": "string",
    "legl_consultatn_dt": "date",
    "legl_rep_date": "date",
    "legl_aCode": "string",
    "legl_subCategory": "string",
    "legl_contact_type": "string",
    "legl_Contact_Id": "int",
    "legl_defendnt_counsel": "string",
    "legl_plntif_counsel": "string",
    "legl_defendnt_refrl_type": "string",
    "legl_rank_first": "bigint",
    "source": "string",
}
CONTACT_TYPE_PREFIX = "ClaimLink - "


def legal_contacts(ds: Mapping[str, DataFrame]) -> DataFrame:
    """Legal contact rows from snapshots.

    Every contact of a claim and subcategory gets a number. The numbers depend on the two inner joins only and are given
    before the two lookups are joined.
    """
    require_tables(ds, [short_name(t.name) for t in TABLES])
    matched = star_join(ds, ("contact", "dl_TIMClaimContactType"), REQUIRED_EDGES).select(
        *[F.col(f"contact.{c}") for c in ("oid_clsno", "oid_instid", "_timestamp", "aDateEngaged", *GROUP)],
        "contact.myContactType_clsno",
        "contact.myContactType_instid",
        "claim.aClaimNumber",
        "claim.aDateInitialConsultSolicitor",
        "claim.aLitDefendantCounsel",
        "claim.aLitPlaintiffCounsel",
        "claim.myLitReferralType_clsno",
        "claim.myLitReferralType_instid",
        F.col("subcat.aCode").alias("subcat_code"),
        F.col("subcat.aDescription").alias("subcat_text"),
    )
    numbered = number_rows(
        matched,
        GROUP,
        ["aDateEngaged", "_timestamp", "oid_instid", "oid_clsno"],
        "legl_rank_first",
    )
    with_link = oid_join(
        numbered.alias("c"), ds["dl_TIMContactTypeClaimLink"].alias("link"), "c.myContactType", "link.oid"
    )
    joined = oid_join(with_link, ds["dl_TIMLitigationReferralType"].alias("lit"), "c.myLitReferralType", "lit.oid")
    return joined.select(
        or_blank(F.col("c.aClaimNumber")).alias("clm_no"),
        parse_date(F.col("c.aDateInitialConsultSolicitor")).alias("legl_consultatn_dt"),
        parse_date(F.col("c.aDateEngaged")).alias("legl_rep_date"),
        or_blank(F.col("c.subcat_code")).alias("legl_aCode"),
        or_blank(F.col("c.subcat_text")).alias("legl_subCategory"),
        prefixed(CONTACT_TYPE_PREFIX, F.col("c.subcat_text")).alias("legl_contact_type"),
        parse_int(F.col("link.aKey")).alias("legl_Contact_Id"),
        F.col("c.aLitDefendantCounsel").alias("legl_defendnt_counsel"),
        F.col("c.aLitPlaintiffCounsel").alias("legl_plntif_counsel"),
        F.col("lit.aDescription").alias("legl_defendnt_refrl_type"),
        F.col("c.legl_rank_first"),
        F.lit(SOURCE_SYSTEM).alias("source"),
    )


def legal_contacts_of_logs(logs: Mapping[str, DataFrame]) -> DataFrame:
    """The same from change-log tables at hand."""
    require_tables(logs, [short_name(t.name) for t in TABLES])
    spark = next(iter(logs.values())).sparkSession
    return legal_contacts(load_snapshots(spark, TABLES, "", read=reader_of(logs)))
