"""Join operators.

An object reference `x` stands for the two columns `x_clsno` and `x_instid`. References are compared
with plain equality, so a reference with a NULL half matches nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablejobs.functions.dates import DateLike, as_date
from tablejobs.functions.text import all_of
from tablejobs.operators.windows import Ranges

HALVES = ("clsno", "instid")

# Days per slice of an interval join: a slice of one key holds at most this many distinct days.
SLICE_DAYS = 32

# First and last day of all.
CALENDAR = ("0001-01-01", "9999-12-31")


def ref_equal(left: str, right: str) -> Column:
    """Both halves of two references are equal; each side reads `alias.ref`."""
    return all_of([F.col(f"{left}_{h}") == F.col(f"{right}_{h}") for h in HALVES])


def oid_join(left: DataFrame, right: DataFrame, left_ref: str, right_ref: str, how: str = "left") -> DataFrame:
    """Equi join of two aliased relations on an object reference."""
    return left.join(right, ref_equal(left_ref, right_ref), how)


@dataclass(frozen=True)
class Edge:
    """One join of a star: bring in `table` as `alias` where the reference `near` equals `far`."""

    alias: str
    table: str
    near: str
    far: str
    how: str = "left"


def lookup_join(left: DataFrame, lookup: DataFrame, left_ref: str, right_ref: str) -> DataFrame:
    """Left join of an aliased lookup table; statistics and adaptive execution tell whether it is broadcast."""
    return oid_join(left, lookup, left_ref, right_ref, "left")


def star_join(ds: Mapping[str, DataFrame], base: tuple[str, str], edges: Sequence[Edge]) -> DataFrame:
    """Joins the tables of `edges` to the base `(alias, table)` in order.

    The same table may come in under several aliases. No join is hinted: adaptive execution knows the
    size of each snapshot once its shuffle has run, broadcasts those below its threshold and splits
    skewed partitions of the others.
    """
    alias, table = base
    joined = ds[table].alias(alias)
    for edge in edges:
        joined = oid_join(joined, ds[edge.table].alias(edge.alias), edge.near, edge.far, edge.how)
    return joined


def require_tables(ds: Mapping[str, DataFrame], names: Sequence[str]) -> None:
    missing = [n for n in names if n not in ds]
    if missing:
        raise ValueError(f"missing input tables: {', '.join(missing)}")


# --- interval join -------------------------------------------------------------------------------


def _slice(day: Column) -> Column:
    return F.floor(F.unix_date(day) / SLICE_DAYS)


def point_slices(points: DataFrame, day: str, horizon: DateLike) -> DataFrame:
    """Adds the slice of each point; all days after the horizon share the last slice."""
    return points.withColumn("__slice", _slice(F.least(F.col(day), as_date(horizon))))


def interval_slices(intervals: DataFrame, start: str, end: str, horizon: DateLike) -> DataFrame:
    """One row per slice an interval touches, cut at the horizon so that open ends stay short."""
    last = as_date(horizon)
    slices = F.sequence(_slice(F.least(F.col(start), last)), _slice(F.least(F.col(end), last)))
    return intervals.filter(F.col(start) <= F.col(end)).withColumn("__slice", F.explode(slices))


def sliced_join(
    points: DataFrame, intervals: DataFrame, keys: Sequence[str], day: str, start: str, end: str, how: str
) -> DataFrame:
    """Join of two sliced inputs; the points keep their slice for a further join on it.

    Both sides are shuffled, never broadcast: Spark's statistics do not see how many slices an interval gives, and take the
    intervals of a large table for a small one.
    """
    right_keys = {k: f"__right_{k}" for k in (*keys, "__slice")}
    right = intervals.withColumnsRenamed(right_keys).hint("merge")
    match = [F.col(k) == F.col(r) for k, r in right_keys.items()]
    match.append(F.col(day).between(F.col(start), F.col(end)))
    return points.join(right, all_of(match), how).drop(*right_keys.values())


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    day: str,
    start: str,
    end: str,
    horizon: DateLike,
    how: str = "left",
) -> DataFrame:
    """Points joined to the intervals of the same key that contain their day, both ends included.

    Days are cut into slices of SLICE_DAYS and the slice becomes an equi key. This bounds the pairs
    that are compared and spreads one big key over many tasks. `horizon` should be near the last day of
    the points; it limits how far open intervals are repeated and has no influence on the result.
    """
    return sliced_join(
        point_slices(points, day, horizon),
        interval_slices(intervals, start, end, horizon),
        keys,
        day,
        start,
        end,
        how,
    ).drop("__slice")


# --- spans instead of days -----------------------------------------------------------------------


def with_gaps(intervals: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """The intervals of each key and, with NULL for all their columns, the days of the key that lie in none of them.

    `__from` and `__to` are the days of a row, both included. The first gap begins and the last one ends with the calendar.
    """
    own = [c for c in intervals.columns if c not in keys]
    by_start = Window.partitionBy(*keys).orderBy(start, end)
    before = F.max(end).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    following = F.lead(start).over(by_start)
    until = F.max(end).over(by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranged = intervals.filter(F.col(start) <= F.col(end)).select(
        "*", before.alias("__before"), following.alias("__following"), until.alias("__until")
    )

    def part(first: Column, last: Column, real: bool) -> Column:
        value = lambda c: F.col(c) if real else F.lit(None).cast(intervals.schema[c].dataType)
        return F.struct(*[value(c).alias(c) for c in own], first.alias("__from"), last.alias("__to"))

    head = part(F.coalesce(F.date_add("__before", 1), F.lit(CALENDAR[0]).cast("date")), F.date_sub(start, 1), False)
    tail = part(F.date_add("__until", 1), F.when(F.col("__following").isNull(), F.lit(CALENDAR[1]).cast("date")), False)
    parts = F.array(part(F.col(start), F.col(end), True), head, tail)
    return ranged.select(*keys, F.inline(parts)).filter("__from <= __to")


def span_join(
    spans: DataFrame, intervals: DataFrame, keys: Sequence[str], first: str, last: str, start: str, end: str, how: str = "left"
) -> DataFrame:
    """`interval_join` of whole spans of days: one row for each span and interval that meet, cut to the days they share.

    Its rows spread over the days `first` to `last` are those of `interval_join` on every day of the spans. No day is
    shuffled or sorted, only spans and intervals are. Both sides come together by key, so the pairs of a key are compared:
    intervals that begin on different days are no more than the days they lie in.
    """
    right_keys = {k: f"__right_{k}" for k in keys}
    if how == "left":
        right = with_gaps(intervals, keys, start, end)
    else:
        right = intervals.select("*", F.col(start).alias("__from"), F.col(end).alias("__to"))
    match = [F.col(k) == F.col(r) for k, r in right_keys.items()]
    match += [F.col("__from") <= F.col(last), F.col("__to") >= F.col(first)]
    joined = spans.join(right.withColumnsRenamed(right_keys).hint("merge"), all_of(match), how)
    cut = {first: F.greatest(first, "__from"), last: F.least(last, "__to")}
    return joined.withColumns(cut).filter(F.col(first) <= F.col(last)).drop(*right_keys.values(), "__from", "__to")


def each_day(spans: DataFrame, first: str, last: str, day: str, monthly: bool = False) -> DataFrame:
    """Every day of each span as `day`, or those that begin a month."""
    if not monthly:
        return spans.withColumn(day, F.explode(F.sequence(first, last))).drop(first, last)
    begin = F.add_months(F.trunc(F.date_sub(first, 1), "MM"), 1)
    days = F.when(begin <= F.col(last), F.sequence(begin, last, F.expr("INTERVAL 1 MONTH")))
    return spans.withColumn(day, F.explode(days)).drop(first, last)


# --- as-of join ----------------------------------------------------------------------------------


def asof_latest(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_day: str,
    right_day: str,
    values: Sequence[str],
    spread: bool = False,
) -> DataFrame:
    """Each left row with `right_day` and `values` of the latest right row of its key on or before its day.

    All left rows of one key and day have the same answer. So both sides are first reduced to one mark
    per key and day (map-side), the forward fill runs over these marks only, and the answers are joined
    back on key and day. Of several right rows on a day the one with the greatest values counts.

    `spread` is for moments instead of days, of which a key may have any number: the marks are cut into ranges, the fill runs
    inside a range, and the latest find before it is carried into it. Left rows without a key or a day find nothing.
    """
    asked = left.select(*keys, F.col(left_day).alias("__day"), F.lit(True).alias("__asked"))
    found = right.select(
        *keys,
        F.col(right_day).alias("__day"),
        F.lit(False).alias("__asked"),
        F.struct(F.col(right_day), *[F.col(v) for v in values]).alias("__found"),
    )
    marks = (
        asked.unionByName(found, allowMissingColumns=True)
        .filter(F.col("__day").isNotNull())
        .groupBy(*keys, "__day")
        .agg(F.max("__asked").alias("__asked"), F.max("__found").alias("__found"))
    )
    groups, before = Window.partitionBy(*keys), F.lit(None)
    if spread:
        ranges = Ranges(marks, keys, [F.col("__day").asc()])
        # The day comes first in a find, so the greatest is the latest.
        marks, groups, before = ranges.carrying({"__before": (F.max("__found"), F.max)}), ranges.inside(), F.col("__before")
    so_far = groups.orderBy("__day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    answers = (
        marks.withColumn("__found", F.coalesce(F.last("__found", ignorenulls=True).over(so_far), before))
        .filter("__asked")
        .select(*[F.col(k).alias(f"__right_{k}") for k in keys], "__day", "__found.*")
    )
    match = [F.col(k) == F.col(f"__right_{k}") for k in keys] + [F.col(left_day) == F.col("__day")]
    return left.join(answers, all_of(match), "left").drop(*[f"__right_{k}" for k in keys], "__day")
