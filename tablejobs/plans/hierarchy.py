"""Names of the product divisions, and the report flag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Product division number and name, for store division 71 and for 77.
NAMES_71 = """
10 WOMENS SHOES
12 HANDBAGS & DRESS ACC
13 WOMENS BASICS OUTDOOR ACTIVE
14 COSMETICS
15 JEWELRY / WATCHES
17 FRAGRANCES
18 CENTER CORE VDF PLAN
19 COSM/FRAG VDF PLAN
22 TOTAL RTW SPORTSWEAR
23 CLASSIFICATIONS
24 SPECIAL SIZES
25 CLOSED RTW DEPTS
26 CONTEMPORARY/DENIM/JUNIORS
29 RTW VDF PLAN
41 WORKSHOP AT MACYS
43 SOFT HOME
44 BIG TICKET
46 FOOD & CANDY
47 HOME VDF PLAN
48 FANATICS
50 TOTAL MENS
52 TOTAL CHILDRENS
53 MENS/KIDS VDF PLAN
59 BRANDED PARTNERSHIPS
60 C/WKRM/EXP/FEES/OTHER
62 LEASED
66 MARKETPLACE
69 STORY
70 GIFT WRAP EXTRAS
71 BACKSTAGE RTW
72 BACKSTAGE CENTER CORE
75 BACKSTAGE MENS
76 BACKSTAGE CHILDREN
90 BACKSTAGE HOME
"""
NAMES_77 = """
10 HANDBAGS
11 JEWELRY
12 SHOES
13 DRESS ACCESSORIES
14 BEAUTY
20 SWIM/OUTRWR/ACTIVE/INT APP
21 MISSY
22 JUNIORS
23 DRESSES
24 SPECIAL SIZES
30 SOFT HOME
31 HOME GOODS
32 TOYS/QUEUE/LUGGAGE
40 CHILDRENS
50 MENS FURN/SEASNL/TAILORED
51 MENS SPORTSWEAR
60 COST
62 LEASED
92 MISC
"""
# The division and product divisions of the report, and the two texts of the flag.
REPORT_DIVISION = 71
REPORT_PDIV = (14, 15, 17, 44, 50, 52)
IN_REPORT = "Is WBR Report Hierarchy"
NOT_IN_REPORT = "Is not WBR Report Hierarchy"

MAPPING_SCHEMA = "rtl_divn_nbr int, pdiv_id int, filter_level string"


def default_names() -> list[tuple[int, int, str]]:
    rows = []
    for division, text in ((71, NAMES_71), (77, NAMES_77)):
        for line in text.strip().splitlines():
            number, name = line.split(" ", 1)
            rows.append((division, int(number), name))
    return rows


def mapping_of(spark: SparkSession, names: Sequence[tuple[int, int, str]]) -> DataFrame:
    """Names by division and product division as a literal relation.

    Spark knows its exact size, so some dozens of names are broadcast without a hint and a longer list is not.
    """
    if not names:
        return spark.createDataFrame([], MAPPING_SCHEMA)
    quoted = ["NULL" if n is None else "'" + n.replace("\\", "\\\\").replace("'", "\\'") + "'" for _, _, n in names]
    rows = ", ".join(f"({int(division)}, {int(pdiv)}, {name})" for (division, pdiv, _), name in zip(names, quoted))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS names(rtl_divn_nbr, pdiv_id, filter_level)")


def default_mapping(spark: SparkSession) -> DataFrame:
    return mapping_of(spark, default_names())


def in_report(division: Column, pdiv: Column) -> Column:
    """True, false, or false for unknown: the product division is one of the report's."""
    return F.coalesce((division == REPORT_DIVISION) & pdiv.isin(*REPORT_PDIV), F.lit(False))


def with_hierarchy(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Adds FILTER_LEVEL (NULL where the mapping has no name), Attr_Flag and Flag_Desc.

    The mapping must be unique by (rtl_divn_nbr, pdiv_id). Its statistics tell whether it is broadcast.
    """
    flagged = in_report(F.col("rtl_divn_nbr"), F.col("pdiv_id"))
    names = mapping.select("rtl_divn_nbr", "pdiv_id", F.col("filter_level").alias("FILTER_LEVEL"))
    return df.join(names, ["rtl_divn_nbr", "pdiv_id"], "left").withColumns(
        {
            "Attr_Flag": F.when(flagged, 1).otherwise(0),
            "Flag_Desc": F.when(flagged, IN_REPORT).otherwise(NOT_IN_REPORT),
        }
    )
