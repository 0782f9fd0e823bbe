"""Window operators.

Groups may be very uneven, so each operator here either keeps one row per group before the shuffle
(Spark's window group limit, or an aggregate), reduces the group to one row per distinct order value first, or cuts
the whole table into ranges of its order and carries what the earlier ranges of a group hold into the next ones.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.functions.dates import OPEN_END, month_boundaries
from tablejobs.functions.text import all_of
from tablejobs.session import written

DEDUP_MODES = ("row_number", "rank", "none")


def order_column(term: str) -> Column:
    """`"name"`, `"name asc"` or `"name desc"` as a sort column; NULLs come first going up, last going down."""
    name, _, direction = term.strip().partition(" ")
    direction = direction.strip().lower()
    if direction not in ("", "asc", "desc"):
        raise ValueError(f"cannot read the order term {term!r}")
    return F.col(name).desc_nulls_last() if direction == "desc" else F.col(name).asc_nulls_first()


def _can_be_hashed(kind: T.DataType) -> bool:
    """Maps and variants cannot, nor what holds them."""
    if isinstance(kind, T.ArrayType):
        return _can_be_hashed(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_can_be_hashed(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _row_fingerprint(df: DataFrame) -> Column:
    hashable = [f.name for f in df.schema.fields if _can_be_hashed(f.dataType)]
    return F.xxhash64(*[F.col(f"`{c}`") for c in hashable])


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ("_timestamp desc",),
    mode: str = "row_number",
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """First row (`row_number`) or rows (`rank`, which keeps ties) of each key; `none` changes nothing.

    The rank filter sits directly on the window, so every map task sends at most one row per key into the
    shuffle: a key with very many versions costs no more than any other. Ties under `row_number` fall to
    `tiebreak`, or to a hash of the row, so a recomputed task picks the same row.

    Ties that stay can be any number of rows. Under `rank` the first order value of each key is found by a map-side
    reduced grouping and its rows by a semi-join, whose skewed partitions adaptive execution splits and which moves no
    row where the values are few. Orders that go up in one column and down in another use the window.
    """
    if mode not in DEDUP_MODES:
        raise ValueError(f"mode must be one of {DEDUP_MODES}, not {mode!r}")
    if mode == "none":
        return df
    down = {t.strip().lower().endswith(" desc") for t in order}
    if mode == "rank" and len(down) == 1:
        return _first_with_ties(df, keys, [t.split()[0] for t in order], down.pop())
    sort = [order_column(t) for t in order]
    if mode == "row_number":
        sort += [order_column(t) for t in tiebreak] if tiebreak else [_row_fingerprint(df).asc()]
    window = Window.partitionBy(*keys).orderBy(*sort)
    number = F.row_number() if mode == "row_number" else F.rank()
    return df.withColumn("__rnk", number.over(window)).filter("__rnk = 1").drop("__rnk")


def _first_with_ties(df: DataFrame, keys: Sequence[str], order: Sequence[str], down: bool) -> DataFrame:
    # NULL is the lowest value of a struct, so it comes first going up and last going down, as in `order_column`.
    value = F.struct(*[F.col(c) for c in order])
    best = df.groupBy(*[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)]).agg(
        (F.max(value) if down else F.min(value)).alias("__best")
    )
    match = [F.col(k).eqNullSafe(F.col(f"__key_{i}")) for i, k in enumerate(keys)]
    match += [F.col(c).eqNullSafe(F.col("__best").getField(c)) for c in order]
    return df.join(best, all_of(match), "left_semi")


def latest_and_count(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """`latest_per_key` by `row_number`, with the number of rows of each key as `name`, in one map-side reduced grouping.

    The order must go down in every column. Ties fall to the same hash of the row. `columns` are those that are kept, all of
    them without it: the grouping moves whole rows, from which Spark cannot leave out what is not read later. The rows stay
    dealt by their keys, so a join on these moves them no further.
    """
    if not all(t.strip().lower().endswith(" desc") for t in order):
        raise ValueError(f"the order must go down, not {', '.join(order)}")
    columns = df.columns if columns is None else list(columns)
    rank = F.struct(*[F.col(t.split()[0]) for t in order], F.bitwise_not(_row_fingerprint(df)).alias("__tie"))
    row = F.struct(F.lit(True).alias("__any"), *[F.col(f"`{c}`") for c in columns if c not in keys])
    latest = df.groupBy(*keys).agg(F.max_by(row, rank).alias("__row"), F.count(F.lit(1)).alias(name))
    return latest.select(*[F.col(f"`{c}`") if c in keys else F.col(f"__row.`{c}`") for c in columns], name)


def pick_first(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep_rank: str | None = None) -> DataFrame:
    """One row per key by `order`; `keep_rank` names a column that shows the rank (always 1)."""
    window = Window.partitionBy(*keys).orderBy(*[order_column(t) for t in order])
    picked = df.withColumn("__rnk", F.row_number().over(window)).filter("__rnk = 1")
    return picked.withColumnRenamed("__rnk", keep_rank) if keep_rank else picked.drop("__rnk")


def neighbours(days: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Previous, next, first and last day of each key, and the month gaps to both sides.

    `days` must be one row per key and day; a group is then no larger than the number of days it spans.
    """
    by_day = Window.partitionBy(*keys).orderBy(day)
    whole = Window.partitionBy(*keys)
    prev, following = F.lag(day).over(by_day), F.lead(day).over(by_day)
    linked = days.select(
        *keys,
        prev.alias("prv_tx_date"),
        F.col(day).alias("tx_date"),
        following.alias("__next"),
        F.min(day).over(whole).alias("first_purchase"),
        F.max(day).over(whole).alias("last_purchase"),
    )
    return linked.select(
        *keys,
        "prv_tx_date",
        "tx_date",
        F.coalesce("__next", F.lit(OPEN_END)).alias("nxt_tx_dt"),
        "first_purchase",
        "last_purchase",
        month_boundaries(F.col("__next"), F.col("tx_date")).alias("months_between_txn_nxt"),
        month_boundaries(F.col("tx_date"), F.col("prv_tx_date")).alias("months_between_txn_prv"),
    )


def running_range(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[str],
    start: str,
    end: str,
    carry: Sequence[str] = (),
    names: tuple[str, str] = ("range_start", "range_end"),
    spread: bool = False,
) -> DataFrame:
    """Running MIN(start) and MAX(end) of each partition in the given order, rows of equal order included.

    One row per distinct (partition, order, carry). Rows that agree on all of these get the same
    range, so they are merged before the window runs; the window then sees distinct order values only.

    `spread` is for orders without a bound on their values, such as timestamps: the whole table is then cut into ranges, the
    window runs inside a range, and the range of what lies before is carried into it. A partition of any size lies in
    as many tasks as it has ranges. NULL orders come first; NULL starts and ends count for nothing.
    """
    low, high = names
    merged = df.groupBy(*partition, *[c for c in order if c not in partition], *carry).agg(
        F.min(start).alias("__low"), F.max(end).alias("__high")
    )
    sort = [F.col(c).asc_nulls_first() for c in order]
    window = Window.partitionBy(*partition).orderBy(*sort)
    before = [F.lit(None), F.lit(None)]
    if spread:
        ranges = Ranges(merged, partition, sort)
        merged = ranges.carrying({"__low_before": (F.min("__low"), F.min), "__high_before": (F.max("__high"), F.max)})
        window = ranges.inside().orderBy(*sort)
        before = [F.col("__low_before"), F.col("__high_before")]
    return (
        merged.withColumn(low, F.least(F.min("__low").over(window), before[0]))
        .withColumn(high, F.greatest(F.max("__high").over(window), before[1]))
        .drop("__low", "__high", "__low_before", "__high_before", "__range", "__at")
    )


# --- ranges of a whole table -----------------------------------------------------------------------


class Ranges:
    """A table in the order of its groups, cut into ranges: one range shuffle deals a group of any size to many tasks.

    The table is written once, with `__range` and the place `__at`; rows of equal keys and order lie in one range. Only the
    first group of a range can have begun in an earlier one, so what is carried into a range is at most one row for each.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> None:
        self.keys = list(keys)
        sort = [*[F.col(k).asc_nulls_first() for k in keys], *order]
        ranged = df.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("__at", F.monotonically_increasing_id())
        # The id has the number of the partition above bit 33.
        self.rows = written(ranged, "ranges").withColumn("__range", F.shiftright("__at", 33))

    def inside(self) -> Window:
        """The rows of a group in one range."""
        return Window.partitionBy("__range", *self.keys)

    def carrying(self, parts: Mapping[str, tuple[Column, Callable[[Column], Column]]]) -> DataFrame:
        """The rows with what their group has in earlier ranges: for each name an aggregate of a range, and how aggregates of
        several ranges come together. NULL where there is no earlier range."""
        sizes = self.rows.groupBy("__range", *self.keys).agg(*[part.alias(name) for name, (part, _) in parts.items()])
        earlier = Window.partitionBy(*self.keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
        carried = sizes.select(
            *[F.col(k).alias(f"__carried_{k}") for k in ("__range", *self.keys)],
            F.count(F.lit(1)).over(earlier).alias("__earlier"),
            *[joined(F.col(name)).over(earlier).alias(name) for name, (_, joined) in parts.items()],
        )
        # One row for each range at most, however many groups there are.
        carried = F.broadcast(carried.filter("__earlier > 0").drop("__earlier"))
        match = all_of([F.col(k).eqNullSafe(F.col(f"__carried_{k}")) for k in ("__range", *self.keys)])
        return self.rows.join(carried, match, "left").drop(*[f"__carried_{k}" for k in ("__range", *self.keys)])


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """ROW_NUMBER of every row in its group, ascending with NULLs last, as column `name`.

    Every row keeps its number, so a group cannot be cut down before it is sorted. Rows are numbered inside the ranges of the
    whole table, and the rows of the group in earlier ranges are added. The input is planned and read once. Which of several
    rows of equal order comes first is settled when the ranges are written.
    """
    ranges = Ranges(df, keys, [F.col(c).asc_nulls_last() for c in order])
    rows = ranges.carrying({"__before": (F.count(F.lit(1)), F.sum)})
    number = F.row_number().over(ranges.inside().orderBy("__at")).cast("long")
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], (number + F.coalesce("__before", F.lit(0))).alias(name))
