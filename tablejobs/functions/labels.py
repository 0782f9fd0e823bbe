"""Lifecycle label of one customer on one day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablejobs.functions.dates import month_boundaries

# The labels and the month counts at which they change.
NET_NEW = "NET NEW"
NEW = "NEW"
REACTIVE = "REACTIVE"
RETAINED = "RETAINED"
LAPSED = "LAPSED"
INACTIVE = "INACTIVE"
LAPSE_MONTHS = 13
INACTIVE_MONTHS = 25
RETURN_AS_NEW_MONTHS = 24


def lifecycle_label(day: Column, first: Column, gap: Column, last: Column) -> Column:
    """Label on `day`, from the first purchase, the latest one, and the months between it and the one before.

    The purchase day itself says how the customer came back, every later day how long ago the purchase was.
    No purchase yet gives NULL.
    """
    bought_today = last == day
    months_since = month_boundaries(day, last)
    return (
        F.when(first == day, NET_NEW)
        .when(bought_today & (gap >= RETURN_AS_NEW_MONTHS), NEW)
        .when(bought_today & (gap >= LAPSE_MONTHS), REACTIVE)
        .when(months_since >= INACTIVE_MONTHS, INACTIVE)
        .when(months_since >= LAPSE_MONTHS, LAPSED)
        .when(last.isNotNull(), RETAINED)
    )
