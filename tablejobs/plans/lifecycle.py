"""Customer lifecycle labels as date ranges.

Three forms give the same rows.

* `segment` (default) never builds the customer × day table. A label can only change on a purchase
  day, on the day after it, and on the first day of the months in which a latest purchase turns 13 and
  25 month boundaries old. These at most eight days are computed inside the row of each purchase day,
  so the ranges are complete without another grouping.
  The job shuffles twice: once to reduce transactions to purchase days (map-side), once to bring a
  customer's purchase days together. A customer has at most one row per day (and product division), so
  a customer with any number of transactions fits one task.
* `daily` spreads those spans over their days, inside each row, for those who need the day table.
* `staged` builds the day table the long way round: every customer with the look-back, joined to three
  tables of purchase intervals, cut to one row a day, spread over the days and labelled. The joins and the
  cut work on spans of days; its stages can be used singly, by spans or by days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablejobs.functions.dates import (
    DateLike,
    as_date,
    month_boundaries,
    month_start,
    spine_days,
    within_lookback,
)
from tablejobs.functions.labels import INACTIVE_MONTHS, LAPSE_MONTHS, lifecycle_label
from tablejobs.functions.text import all_of, empty, min_text_length
from tablejobs.operators.joins import each_day, interval_slices, point_slices, sliced_join, span_join
from tablejobs.operators.windows import neighbours, pick_first, running_range
from tablejobs.plans.hierarchy import NOT_IN_REPORT, default_mapping, with_hierarchy

# Channels, store divisions, product divisions left out of the total, placeholder customer.
STORE = "A"
WEB = "F"
DIVISIONS = (71, 77)
TOTAL_EXCLUDED_PDIV = (0, 65)
PLACEHOLDER_CUSTOMER = 1
LOOKBACK_DAYS = 2500
MIN_ID_LENGTH = 8

# Transactions whose customers' days come together in one task, about; a day becomes two or three wide rows there.
DEALT_ROWS = 200_000

TOTAL_KEYS = ("indiv_id",)
DIVISION_KEYS = ("indiv_id", "pdiv_id", "rtl_divn_nbr")

LABELS = ("TOTAL_CS", "MCOM_CS", "STORE_CS")
LAST_DAYS = ("last_purchase_dt_total", "last_purchase_dt_mcom", "last_purchase_dt_store")

# The output columns in order, and the two sort orders of the reports.
RANGE_COLUMNS = (
    "GREG_START_DT",
    "GREG_END_DT",
    "INDV_ID",
    "RTL_DIVN_NBR",
    "FILTER_TYPE",
    "FILTER_LEVEL",
    *LABELS,
    *LAST_DAYS,
    "Attr_Flag",
    "Flag_Desc",
)
TOTAL_ORDER = ("INDV_ID", "RTL_DIVN_NBR", "FILTER_TYPE", "FILTER_LEVEL", "GREG_START_DT", "GREG_END_DT")
DIVISION_ORDER = ("INDV_ID", "GREG_START_DT", "GREG_END_DT", "RTL_DIVN_NBR", "FILTER_TYPE", "FILTER_LEVEL")


# --- inputs --------------------------------------------------------------------------------------


def base_transactions(
    transactions: DataFrame,
    run_date: DateLike = None,
    lookback_days: int = LOOKBACK_DAYS,
    divisions: Sequence[int] = DIVISIONS,
    exclude_pdiv: Sequence[int] = (),
    min_id_len: int = MIN_ID_LENGTH,
    customers: Sequence[int] | DataFrame | None = None,
    month: str | None = None,
) -> DataFrame:
    """Owned sales of the two channels within the look-back, with a usable customer id.

    `exclude_pdiv` also drops rows without a product division. `customers` limits the job to some ids: a short list, or the
    first column of a table of any size, which is semi-joined. `month` names a column with the sale's month as `yyyyMM`, by
    which the sales are partitioned; months before the look-back are then not read.
    """
    col = F.col
    kept = transactions.filter(
        within_lookback(transactions, "txn_dt", run_date, lookback_days)
        & col("prch_chnl_cd").isin(STORE, WEB)
        & (col("fin_own_lease_ind") == "Y")
        & col("rtl_divn_nbr").isin(*divisions)
        & col("dept_vnd_cd").isNotNull()
        & col("vst_cd").isNotNull()
        & col("indiv_id").isNotNull()
        & (col("indiv_id") != PLACEHOLDER_CUSTOMER)
        & min_text_length(transactions, "indiv_id", min_id_len)
    )
    if exclude_pdiv:
        kept = kept.filter(~col("pdiv_id").isin(*exclude_pdiv))
    if month is not None:
        start = F.date_sub(as_date(run_date), lookback_days)
        kept = kept.filter(col(month).cast("string") >= F.date_format(start, "yyyyMM"))
    if isinstance(customers, DataFrame):
        wanted = customers.select(col(customers.columns[0]).alias("__wanted"))
        kept = kept.join(wanted, col("indiv_id") == col("__wanted"), "left_semi")
    elif customers is not None:
        kept = kept.filter(col("indiv_id").isin(*customers))
    return kept.select(
        "indiv_id", "pdiv_id", "rtl_divn_nbr", F.to_date("txn_dt").alias("tx_date"), "prch_chnl_cd"
    )


def date_spine(df: DataFrame, run_date: DateLike = None, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Every row of `df` with every day of the look-back, as GREG_DATE.

    The days are generated inside each row, so no second relation and no join is needed.
    """
    return df.withColumn("greg_date", F.explode(spine_days(run_date, lookback_days)))


def customer_spine(tx: DataFrame, run_date: DateLike = None, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    return date_spine(tx.select("indiv_id").distinct(), run_date, lookback_days)


def customer_span(tx: DataFrame, run_date: DateLike = None, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """`customer_spine` as one span a customer, `first_day` to `last_day`."""
    run = as_date(run_date)
    return tx.select("indiv_id").distinct().withColumns({"first_day": F.date_sub(run, lookback_days), "last_day": run})


def purchase_days(tx: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key and day with a flag per channel. Several purchases on a day count once."""
    return tx.groupBy(*keys, "tx_date").agg(
        F.max(F.col("prch_chnl_cd") == WEB).alias("web"),
        F.max(F.col("prch_chnl_cd") == STORE).alias("store"),
    )


def dealt_days(tx: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`purchase_days` dealt by customer to as many tasks as their number asks for.

    What follows is done where the days lie and multiplies them, so partitions that adaptive execution merges by their size
    in the shuffle would be too large for a task. Transactions are counted for it, by a scan that moves no row.
    """
    tasks = max(int(tx.sparkSession.conf.get("spark.sql.shuffle.partitions")), tx.count() // DEALT_ROWS + 1)
    return purchase_days(tx, keys).repartition(tasks, "indiv_id")


def purchase_intervals(tx: DataFrame, keys: Sequence[str] = TOTAL_KEYS, channel: str | None = None) -> DataFrame:
    """Each purchase day with its neighbours: the interval in which it is the latest purchase."""
    if channel is not None:
        tx = tx.filter(F.col("prch_chnl_cd") == channel)
    return neighbours(tx.select(*keys, "tx_date").distinct(), keys, "tx_date")


# --- segment form --------------------------------------------------------------------------------


CHANNELS = ("total", "web", "store")


def _channel_state(keys: Sequence[str], channel: str, bought: Column) -> dict[str, Column]:
    """First, previous and latest purchase of one channel, as seen on each purchase day."""
    by_day = Window.partitionBy(*keys).orderBy("tx_date")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = by_day.rowsBetween(Window.unboundedPreceding, -1)
    day = F.when(bought, F.col("tx_date"))
    return {
        f"{channel}_first": F.min(day).over(so_far),
        f"{channel}_last": F.max(day).over(so_far),
        f"{channel}_prev": F.max(day).over(earlier),
    }


def _gap(channel: str) -> Column:
    return month_boundaries(F.col(f"{channel}_last"), F.col(f"{channel}_prev"))


def _label(day: str, channel: str) -> Column:
    return lifecycle_label(F.col(day), F.col(f"{channel}_first"), _gap(channel), F.col(f"{channel}_last"))


def _special_day(channel: str) -> Column:
    """The channel's label on the purchase day is not the one of the day after it."""
    last = F.col(f"{channel}_last")
    returned = (last == F.col(f"{channel}_first")) | (_gap(channel) >= LAPSE_MONTHS)
    return F.coalesce((last == F.col("total_last")) & returned, F.lit(False))


def label_segments(tx: DataFrame, keys: Sequence[str], run_date: DateLike = None) -> DataFrame:
    """Spans of constant labels from transactions, see `segments_of`."""
    return segments_of(dealt_days(tx, keys), keys, run_date)


def segments_of(days: DataFrame, keys: Sequence[str], run_date: DateLike = None) -> DataFrame:
    """Spans of constant labels per key: seg_start, seg_end, the labels and the latest purchase days.

    Spans end at `run_date` and are as long as they can be: two spans of a key that agree in all labels
    and days do not occur. `days` are `purchase_days`, dealt by customer; rows stay with their customer, so windows and
    groupings whose keys include the customer need no further shuffle.
    """
    run = as_date(run_date)
    # A channel row is matched by its key with plain equality, so a NULL key has no channel state.
    known = all_of([F.col(k).isNotNull() for k in keys])
    bought = {"total": F.lit(True), "web": F.col("web") & known, "store": F.col("store") & known}
    states = days.select(
        *keys,
        F.lead("tx_date").over(Window.partitionBy(*keys).orderBy("tx_date")).alias("__next"),
        *[c.alias(name) for channel in CHANNELS for name, c in _channel_state(keys, channel, bought[channel]).items()],
    )

    started = F.col("total_last")
    special = F.when(_special_day("total") | _special_day("web") | _special_day("store"), F.date_add(started, 1))
    changes = [started, special]
    for channel in CHANNELS:
        for months in (LAPSE_MONTHS, INACTIVE_MONTHS):
            changes.append(month_start(F.col(f"{channel}_last"), months))
    breaks = F.sort_array(
        F.array_distinct(F.array(*[F.when(c.between(started, F.col("__span_end")), c) for c in changes]))
    )
    spans = (
        states.withColumn("__span_end", F.least(F.date_sub("__next", 1), run))
        .filter(started <= run)
        .withColumn("__breaks", breaks)
        .select("*", F.posexplode_outer("__breaks").alias("__pos", "seg_start"))
        .filter(F.col("seg_start").isNotNull())
    )
    following = F.get("__breaks", F.col("__pos") + 1)
    return spans.select(
        *keys,
        "seg_start",
        F.coalesce(F.date_sub(following, 1), "__span_end").alias("seg_end"),
        *[_label("seg_start", channel).alias(name) for channel, name in zip(CHANNELS, LABELS)],
        *[F.col(f"{channel}_last").alias(name) for channel, name in zip(CHANNELS, LAST_DAYS)],
    )


def day_table(tx: DataFrame, keys: Sequence[str], run_date: DateLike = None) -> DataFrame:
    """One labelled row per key and day from the first purchase to the run date, as `greg_date`."""
    days = F.explode(F.sequence("seg_start", "seg_end"))
    return label_segments(tx, keys, run_date).withColumn("greg_date", days).drop("seg_start", "seg_end")


# --- staged form ---------------------------------------------------------------------------------


def _channel_columns(intervals: DataFrame, suffix: str, keys: Sequence[str]) -> DataFrame:
    return intervals.withColumnsRenamed({c: f"{c}_{suffix}" for c in intervals.columns if c not in keys})


def roll_up(
    spine: DataFrame,
    total: DataFrame,
    web: DataFrame,
    store: DataFrame,
    keys: Sequence[str] = TOTAL_KEYS,
    run_date: DateLike = None,
) -> DataFrame:
    """Each spine day with the total, web and store intervals that contain it.

    Days before the first purchase drop out. Intervals are closed, so a purchase day lies both in the
    interval it ends and in the one it starts and comes back once for each combination.
    """
    spread = [
        (interval_slices(total, "tx_date", "nxt_tx_dt", run_date), TOTAL_KEYS, "", "inner"),
        (interval_slices(_channel_columns(web, "mcom", keys), "tx_date_mcom", "nxt_tx_dt_mcom", run_date), keys, "_mcom", "left"),
        (interval_slices(_channel_columns(store, "store", keys), "tx_date_store", "nxt_tx_dt_store", run_date), keys, "_store", "left"),
    ]
    rolled = point_slices(spine, "greg_date", run_date)
    for intervals, on, suffix, how in spread:
        rolled = sliced_join(rolled, intervals, on, "greg_date", f"tx_date{suffix}", f"nxt_tx_dt{suffix}", how)
    return rolled.drop("__slice")


def roll_up_spans(
    spans: DataFrame, total: DataFrame, web: DataFrame, store: DataFrame, keys: Sequence[str] = TOTAL_KEYS
) -> DataFrame:
    """`roll_up` of spans of days: spans in which the total, web and store intervals stay the same.

    Their days (`spine_of`) are the rows of `roll_up`. A customer has a few spans for each purchase day, whatever the
    number of days; only spans are shuffled and sorted.
    """
    own = ("first_day", "last_day")
    rolled = span_join(spans, total, TOTAL_KEYS, *own, "tx_date", "nxt_tx_dt", "inner")
    rolled = span_join(rolled, _channel_columns(web, "mcom", keys), keys, *own, "tx_date_mcom", "nxt_tx_dt_mcom")
    return span_join(rolled, _channel_columns(store, "store", keys), keys, *own, "tx_date_store", "nxt_tx_dt_store")


def spine_of(spans: DataFrame, monthly: bool = False) -> DataFrame:
    """The days of each span as `greg_date`: all, or those that begin a month."""
    return each_day(spans, "first_day", "last_day", "greg_date", monthly)


def pick_spans(rolled: DataFrame, keys: Sequence[str] = TOTAL_KEYS) -> DataFrame:
    """`pick_daily` of the spans of `roll_up_spans`: each day stays in the span with the newest purchases.

    Purchase intervals follow one another and share one day, so a span meets newer ones on its last day only, and
    the next newer one begins first.
    """
    newer = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in ("tx_date", "tx_date_mcom", "tx_date_store")])
    before_next = F.date_sub(F.lead("first_day").over(newer), 1)
    return rolled.withColumn("last_day", F.least("last_day", before_next)).filter("first_day <= last_day")


def label_days(rolled: DataFrame, keys: Sequence[str] = TOTAL_KEYS) -> DataFrame:
    """The three labels and latest purchase days of each rolled-up row."""

    def label(suffix: str) -> Column:
        first, gap, last = (
            F.col(f"{c}{suffix}") for c in ("first_purchase", "months_between_txn_prv", "tx_date")
        )
        return lifecycle_label(F.col("greg_date"), first, gap, last)

    return rolled.select(
        *keys,
        "greg_date",
        label("").alias("TOTAL_CS"),
        label("_mcom").alias("MCOM_CS"),
        label("_store").alias("STORE_CS"),
        F.col("tx_date").alias("last_purchase_dt_total"),
        F.col("tx_date_mcom").alias("last_purchase_dt_mcom"),
        F.col("tx_date_store").alias("last_purchase_dt_store"),
    )


def pick_daily(labelled: DataFrame, keys: Sequence[str] = TOTAL_KEYS) -> DataFrame:
    """One row per key and day: the one with the newest purchases."""
    return pick_first(labelled, [*keys, "greg_date"], [f"{c} desc" for c in LAST_DAYS])


def staged_days(
    tx: DataFrame, keys: Sequence[str], run_date: DateLike = None, lookback_days: int = LOOKBACK_DAYS
) -> DataFrame:
    """The rows of `day_table`, by the single stages."""
    rolled = roll_up_spans(
        customer_span(tx, run_date, lookback_days),
        purchase_intervals(tx, keys),
        purchase_intervals(tx, keys, WEB),
        purchase_intervals(tx, keys, STORE),
        keys,
    )
    return label_days(spine_of(pick_spans(rolled, keys)), keys)


# --- jobs ----------------------------------------------------------------------------------------


def lifecycle_ranges(
    tx: DataFrame,
    keys: Sequence[str],
    run_date: DateLike = None,
    lookback_days: int = LOOKBACK_DAYS,
    form: str = "segment",
) -> DataFrame:
    """Labelled rows with `seg_start` and `seg_end`; in the forms by day each row is one day."""
    if form == "segment":
        return label_segments(tx, keys, run_date)
    if form == "daily":
        days = day_table(tx, keys, run_date)
    elif form == "staged":
        days = staged_days(tx, keys, run_date, lookback_days)
    else:
        raise ValueError(f"form must be 'segment', 'daily' or 'staged', not {form!r}")
    day = F.col("greg_date")
    return days.withColumns({"seg_start": day, "seg_end": day}).drop("greg_date")


def compact_ranges(labelled: DataFrame, state: Sequence[str]) -> DataFrame:
    """First and last day of each distinct state."""
    return labelled.groupBy(*state).agg(F.min("seg_start").alias("seg_start"), F.max("seg_end").alias("seg_end"))


def lifecycle_total(
    transactions: DataFrame,
    run_date: DateLike = None,
    lookback_days: int = LOOKBACK_DAYS,
    form: str = "segment",
    ordered: bool = False,
    **filters,
) -> DataFrame:
    """Label ranges per customer over all product divisions, RANGE_COLUMNS.

    Within one latest purchase the channel dates are constant, so the running range of the report is
    the plain MIN and MAX of each label tuple; segments are such ranges already. `ordered` sorts the
    whole result as the report does.
    """
    filters.setdefault("exclude_pdiv", TOTAL_EXCLUDED_PDIV)
    tx = base_transactions(transactions, run_date, lookback_days, **filters)
    labelled = lifecycle_ranges(tx, TOTAL_KEYS, run_date, lookback_days, form)
    if form != "segment":
        labelled = compact_ranges(labelled, ["indiv_id", *LABELS, *LAST_DAYS])
    ranges = _total_report(labelled)
    return ranges.orderBy(*TOTAL_ORDER) if ordered else ranges


def _total_report(labelled: DataFrame) -> DataFrame:
    return (
        labelled.withColumnsRenamed({"indiv_id": "INDV_ID", "seg_start": "GREG_START_DT", "seg_end": "GREG_END_DT"})
        .withColumns(
            {
                "RTL_DIVN_NBR": empty("int"),
                "FILTER_TYPE": F.lit("TOTAL"),
                "FILTER_LEVEL": F.lit("TOTAL"),
                "Attr_Flag": F.lit(0),
                "Flag_Desc": F.lit(NOT_IN_REPORT),
            }
        )
        .select(*RANGE_COLUMNS)
    )


def lifecycle_division(
    transactions: DataFrame,
    run_date: DateLike = None,
    mapping: DataFrame | None = None,
    lookback_days: int = LOOKBACK_DAYS,
    form: str = "segment",
    ordered: bool = False,
    **filters,
) -> DataFrame:
    """Label ranges per customer, store division and product division name, RANGE_COLUMNS.

    Product divisions without a name share the level NULL. Their ranges then depend on the running
    frame, so the range window runs over the level, not over the product division.
    """
    tx = base_transactions(transactions, run_date, lookback_days, **filters)
    ranges = _division_report(lifecycle_ranges(tx, DIVISION_KEYS, run_date, lookback_days, form), mapping)
    return ranges.orderBy(*DIVISION_ORDER) if ordered else ranges


def _division_report(labelled: DataFrame, mapping: DataFrame | None) -> DataFrame:
    if mapping is None:
        mapping = default_mapping(labelled.sparkSession)
    labelled = with_hierarchy(labelled, mapping)
    return (
        running_range(
            labelled,
            partition=["indiv_id", "FILTER_LEVEL", "rtl_divn_nbr", *LABELS, LAST_DAYS[0]],
            order=LAST_DAYS,
            start="seg_start",
            end="seg_end",
            carry=["Attr_Flag", "Flag_Desc"],
            names=("GREG_START_DT", "GREG_END_DT"),
        )
        .withColumnsRenamed({"indiv_id": "INDV_ID", "rtl_divn_nbr": "RTL_DIVN_NBR"})
        .withColumn("FILTER_TYPE", F.lit("Prod_hier"))
        .select(*RANGE_COLUMNS)
    )


def lifecycle_total_and_division(
    transactions: DataFrame,
    run_date: DateLike = None,
    mapping: DataFrame | None = None,
    lookback_days: int = LOOKBACK_DAYS,
    exclude_pdiv: Sequence[int] = TOTAL_EXCLUDED_PDIV,
    **filters,
) -> DataFrame:
    """Both reports in one table, from one scan of the transactions.

    These are reduced to purchase days by product division and dealt by customer once; the days of the total, which leaves
    out `exclude_pdiv`, are made from the same days where they lie.
    """
    tx = base_transactions(transactions, run_date, lookback_days, **filters)
    days = dealt_days(tx, DIVISION_KEYS)
    # Counted, not filtered, and with all columns named: both reports then share one plan up to here, and its shuffles.
    counted = ~F.col("pdiv_id").isin(*exclude_pdiv) & F.col("rtl_divn_nbr").isNotNull()
    total = (
        days.groupBy("indiv_id", "tx_date")
        .agg(
            F.max(F.when(counted, F.col("web"))).alias("web"),
            F.max(F.when(counted, F.col("store"))).alias("store"),
            F.count_if(counted).alias("__counted"),
        )
        .filter("__counted > 0")
        .drop("__counted")
    )
    return total_and_division(
        _total_report(segments_of(total, TOTAL_KEYS, run_date)), _division_report(segments_of(days, DIVISION_KEYS, run_date), mapping)
    )


def total_and_division(total: DataFrame, division: DataFrame) -> DataFrame:
    """Both reports in one table."""
    return total.unionByName(division)
