"""Lifecycle jobs and their stages, on sales derived from orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query
from checks.standins import MIXED_SALES, RUN_DATE, SALES, read, sql_text, stand_in
from tablejobs.functions.dates import as_date, day_gap, month_boundaries, month_start
from tablejobs.operators.joins import asof_latest, interval_join, span_join
from tablejobs.operators.windows import running_range
from tablejobs.plans import lifecycle as job
from tablejobs.plans.hierarchy import IN_REPORT, NOT_IN_REPORT, default_mapping, default_names, with_hierarchy
from tablejobs.session import scratch_dir

RUN = f"DATE '{RUN_DATE}'"
START = f"({RUN} - INTERVAL 2500 DAY)"
SALES_SQL = sql_text(SALES)


def sales(spark: SparkSession, sf: str) -> DataFrame:
    return stand_in(spark, sf, SALES)


def total_tx(spark: SparkSession, sf: str) -> DataFrame:
    return job.base_transactions(sales(spark, sf), RUN_DATE, exclude_pdiv=job.TOTAL_EXCLUDED_PDIV)


# --- transactions and spine ----------------------------------------------------------------------

USABLE = f"""txn_dt >= {START} AND prch_chnl_cd IN ('A', 'F') AND fin_own_lease_ind = 'Y'
  AND rtl_divn_nbr IN (71, 77) AND dept_vnd_cd IS NOT NULL AND vst_cd IS NOT NULL AND indiv_id IS NOT NULL
  AND indiv_id <> 1 AND length(CAST(indiv_id AS VARCHAR)) >= 8"""
BASE_SQL = "SELECT indiv_id, pdiv_id, rtl_divn_nbr, CAST(txn_dt AS DATE) AS tx_date, prch_chnl_cd"


@query(
    "base_transactions",
    f"{BASE_SQL} FROM ({sql_text(MIXED_SALES)}) WHERE {USABLE} AND pdiv_id NOT IN (0, 65)",
)
def base_transactions(spark, sf):
    return job.base_transactions(
        stand_in(spark, sf, MIXED_SALES), RUN_DATE, exclude_pdiv=job.TOTAL_EXCLUDED_PDIV
    )


@query(
    "base_transactions_customers",
    f"""{BASE_SQL} FROM ({sql_text(MIXED_SALES)}) WHERE {USABLE}
  AND indiv_id IN (SELECT 10000000 + c_custkey FROM customer WHERE c_acctbal > 0 OR c_mktsegment = 'BUILDING')""",
)
def base_transactions_customers(spark, sf):
    """Sales of a table of customers, here those with a balance or of a segment."""
    wanted = read(spark, sf, "customer").filter("c_acctbal > 0 OR c_mktsegment = 'BUILDING'")
    wanted = wanted.select((F.lit(10000000) + F.col("c_custkey")).alias("customer"))
    return job.base_transactions(stand_in(spark, sf, MIXED_SALES), RUN_DATE, customers=wanted)


def sales_by_month(spark: SparkSession, sf: str) -> DataFrame:
    """The mixed sales as a table with a folder for each month."""
    months = stand_in(spark, sf, MIXED_SALES).withColumn("txn_month", F.date_format("txn_dt", "yyyyMM"))
    path = scratch_dir(spark, "sales")
    months.repartition("txn_month").write.partitionBy("txn_month").parquet(path)
    schema = months.drop("txn_month").schema.add("txn_month", "string")
    return spark.read.schema(schema).parquet(path)


@query("base_transactions_by_month", f"{BASE_SQL} FROM ({sql_text(MIXED_SALES)}) WHERE {USABLE}")
def base_transactions_by_month(spark, sf):
    """Sales partitioned by month, of which the look-back reads its own."""
    return job.base_transactions(sales_by_month(spark, sf), RUN_DATE, month="txn_month")


@query("base_transactions_division", f"{BASE_SQL} FROM ({sql_text(MIXED_SALES)}) WHERE {USABLE}")
def base_transactions_division(spark, sf):
    return job.base_transactions(stand_in(spark, sf, MIXED_SALES), RUN_DATE)


@query(
    "customer_date_spine",
    f"""SELECT 10000000 + o_custkey AS indiv_id, count(DISTINCT d) AS days, min(d) AS first_day, max(d) AS last_day
FROM (SELECT DISTINCT o_custkey FROM orders),
     (SELECT CAST(unnest(generate_series({START}, {RUN}, INTERVAL 1 DAY)) AS DATE) AS d)
GROUP BY o_custkey""",
)
def customer_date_spine(spark, sf):
    spine = job.customer_spine(total_tx(spark, sf), RUN_DATE)
    return spine.groupBy("indiv_id").agg(
        F.count("greg_date").alias("days"), F.min("greg_date").alias("first_day"), F.max("greg_date").alias("last_day")
    )


# --- purchase intervals --------------------------------------------------------------------------


def _intervals_sql(keys: str, where: str = "true", suffix: str = "") -> str:
    cols = {
        "prv_tx_date": "lag(d) OVER w",
        "tx_date": "d",
        "nxt_tx_dt": "coalesce(lead(d) OVER w, DATE '3499-12-31')",
        "first_purchase": f"min(d) OVER (PARTITION BY {keys})",
        "last_purchase": f"max(d) OVER (PARTITION BY {keys})",
        "months_between_txn_nxt": "CAST(date_diff('month', d, lead(d) OVER w) AS INTEGER)",
        "months_between_txn_prv": "CAST(date_diff('month', lag(d) OVER w, d) AS INTEGER)",
    }
    select = ", ".join(f"{e} AS {c}{suffix}" for c, e in cols.items())
    return f"""SELECT {keys}, {select}
FROM (SELECT DISTINCT {keys}, CAST(txn_dt AS DATE) AS d FROM ({SALES_SQL}) WHERE {where})
WINDOW w AS (PARTITION BY {keys} ORDER BY d)"""


@query("purchase_intervals", _intervals_sql("indiv_id"))
def purchase_intervals(spark, sf):
    return job.purchase_intervals(total_tx(spark, sf))


@query("purchase_intervals_web", _intervals_sql("indiv_id", "prch_chnl_cd = 'F'"))
def purchase_intervals_web(spark, sf):
    return job.purchase_intervals(total_tx(spark, sf), channel=job.WEB)


@query("purchase_intervals_store", _intervals_sql("indiv_id", "prch_chnl_cd = 'A'"))
def purchase_intervals_store(spark, sf):
    return job.purchase_intervals(total_tx(spark, sf), channel=job.STORE)


@query("purchase_intervals_division", _intervals_sql("indiv_id, pdiv_id, rtl_divn_nbr"))
def purchase_intervals_division(spark, sf):
    return job.purchase_intervals(job.base_transactions(sales(spark, sf), RUN_DATE), job.DIVISION_KEYS)


# --- joins on time -------------------------------------------------------------------------------

MONTHS_SQL = f"""SELECT DISTINCT 10000000 + o_custkey AS indiv_id, CAST(m AS DATE) AS greg_date FROM orders,
  (SELECT unnest(generate_series(DATE '1995-01-01', {RUN}, INTERVAL 1 MONTH)) AS m)"""


def month_spine(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer with the first day of every month since January 1995."""
    months = F.sequence(as_date("1995-01-01"), as_date(RUN_DATE), F.expr("INTERVAL 1 MONTH"))
    return total_tx(spark, sf).select("indiv_id").distinct().withColumn("greg_date", F.explode(months))


@query(
    "interval_join",
    f"""SELECT p.indiv_id, p.greg_date, i.tx_date, i.nxt_tx_dt FROM ({MONTHS_SQL}) p
LEFT JOIN ({_intervals_sql('indiv_id')}) i
  ON p.indiv_id = i.indiv_id AND p.greg_date BETWEEN i.tx_date AND i.nxt_tx_dt""",
)
def interval_join_months(spark, sf):
    intervals = job.purchase_intervals(total_tx(spark, sf)).select("indiv_id", "tx_date", "nxt_tx_dt")
    return interval_join(month_spine(spark, sf), intervals, ["indiv_id"], "greg_date", "tx_date", "nxt_tx_dt", RUN_DATE)


DAYS_SQL = f"""SELECT DISTINCT 10000000 + o_custkey AS indiv_id, d AS greg_date FROM orders,
  (SELECT CAST(unnest(generate_series({START}, {RUN}, INTERVAL 1 DAY)) AS DATE) AS d)"""


@query(
    "interval_join_days",
    f"""SELECT p.indiv_id, p.greg_date, i.tx_date, i.nxt_tx_dt FROM ({DAYS_SQL}) p
LEFT JOIN ({_intervals_sql('indiv_id')}) i
  ON p.indiv_id = i.indiv_id AND p.greg_date BETWEEN i.tx_date AND i.nxt_tx_dt""",
)
def interval_join_days(spark, sf):
    """`interval_join` on every day of the look-back: spans are joined, and spread over their days."""
    tx = total_tx(spark, sf)
    intervals = job.purchase_intervals(tx).select("indiv_id", "tx_date", "nxt_tx_dt")
    spans = job.customer_span(tx, RUN_DATE)
    return job.spine_of(span_join(spans, intervals, ["indiv_id"], "first_day", "last_day", "tx_date", "nxt_tx_dt"))


@query(
    "roll_up",
    f"""SELECT p.indiv_id, p.greg_date, t.* EXCLUDE (indiv_id), m.* EXCLUDE (indiv_id), s.* EXCLUDE (indiv_id)
FROM ({MONTHS_SQL}) p
JOIN ({_intervals_sql('indiv_id')}) t ON p.indiv_id = t.indiv_id AND p.greg_date BETWEEN t.tx_date AND t.nxt_tx_dt
LEFT JOIN ({_intervals_sql('indiv_id', "prch_chnl_cd = 'F'", '_mcom')}) m
  ON p.indiv_id = m.indiv_id AND p.greg_date BETWEEN m.tx_date_mcom AND m.nxt_tx_dt_mcom
LEFT JOIN ({_intervals_sql('indiv_id', "prch_chnl_cd = 'A'", '_store')}) s
  ON p.indiv_id = s.indiv_id AND p.greg_date BETWEEN s.tx_date_store AND s.nxt_tx_dt_store""",
)
def roll_up(spark, sf):
    return job.spine_of(month_spans(spark, sf), monthly=True)


def rolled_spans(spans: DataFrame, tx: DataFrame) -> DataFrame:
    return job.roll_up_spans(
        spans, job.purchase_intervals(tx), job.purchase_intervals(tx, channel=job.WEB), job.purchase_intervals(tx, channel=job.STORE)
    )


def month_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Rolled-up spans of the time since January 1995."""
    tx = total_tx(spark, sf)
    spans = tx.select("indiv_id").distinct().withColumns({"first_day": as_date("1995-01-01"), "last_day": as_date(RUN_DATE)})
    return rolled_spans(spans, tx)


def day_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Rolled-up spans of the look-back."""
    tx = total_tx(spark, sf)
    return rolled_spans(job.customer_span(tx, RUN_DATE), tx)


@query(
    "roll_up_days",
    f"""SELECT p.indiv_id, p.greg_date, t.* EXCLUDE (indiv_id), m.* EXCLUDE (indiv_id), s.* EXCLUDE (indiv_id)
FROM ({DAYS_SQL}) p
JOIN ({_intervals_sql('indiv_id')}) t ON p.indiv_id = t.indiv_id AND p.greg_date BETWEEN t.tx_date AND t.nxt_tx_dt
LEFT JOIN ({_intervals_sql('indiv_id', "prch_chnl_cd = 'F'", '_mcom')}) m
  ON p.indiv_id = m.indiv_id AND p.greg_date BETWEEN m.tx_date_mcom AND m.nxt_tx_dt_mcom
LEFT JOIN ({_intervals_sql('indiv_id', "prch_chnl_cd = 'A'", '_store')}) s
  ON p.indiv_id = s.indiv_id AND p.greg_date BETWEEN s.tx_date_store AND s.nxt_tx_dt_store""",
)
def roll_up_days(spark, sf):
    """`roll_up` on every day of the look-back."""
    return job.spine_of(day_spans(spark, sf))


@query(
    "asof_latest_purchase",
    f"""WITH days AS (SELECT DISTINCT indiv_id, CAST(txn_dt AS DATE) AS d, prch_chnl_cd, rtl_divn_nbr FROM ({SALES_SQL}))
SELECT l.indiv_id, l.d AS store_day, l.rtl_divn_nbr, r.d AS web_day, r.divn AS web_divn
FROM (SELECT * FROM days WHERE prch_chnl_cd = 'A') l
ASOF LEFT JOIN (SELECT indiv_id, d, max(rtl_divn_nbr) AS divn FROM days WHERE prch_chnl_cd = 'F' GROUP BY indiv_id, d) r
  ON l.indiv_id = r.indiv_id AND l.d >= r.d""",
)
def asof_latest_purchase(spark, sf):
    tx = total_tx(spark, sf).select("indiv_id", "tx_date", "prch_chnl_cd", "rtl_divn_nbr").distinct()
    store = tx.filter(F.col("prch_chnl_cd") == job.STORE).select(
        "indiv_id", F.col("tx_date").alias("store_day"), "rtl_divn_nbr"
    )
    web = tx.filter(F.col("prch_chnl_cd") == job.WEB).select(
        "indiv_id", F.col("tx_date").alias("web_day"), F.col("rtl_divn_nbr").alias("web_divn")
    )
    return asof_latest(store, web, ["indiv_id"], "store_day", "web_day", ["web_divn"])


# --- labels by day, in SQL -----------------------------------------------------------------------


def _label_sql(c: str) -> str:
    months = f"date_diff('month', {c}.d, days.day)"
    return f"""CASE WHEN {c}.first = days.day THEN 'NET NEW'
       WHEN {c}.d = days.day AND {c}.gap >= 24 THEN 'NEW' WHEN {c}.d = days.day AND {c}.gap >= 13 THEN 'REACTIVE'
       WHEN {months} > 24 THEN 'INACTIVE' WHEN {months} > 12 THEN 'LAPSED' WHEN {months} >= 0 THEN 'RETAINED' END"""


def _days_sql(keys: str) -> str:
    """WITH entries up to `labelled`: one row per key and day, by as-of joins on the day table."""
    same = lambda c: " AND ".join(f"days.{k} = {c}.{k}" for k in keys.split(", "))

    def channel(name: str, where: str) -> str:
        return f"""{name} AS (SELECT {keys}, d, date_diff('month', lag(d) OVER w, d) AS gap,
    min(d) OVER (PARTITION BY {keys}) AS first
  FROM (SELECT DISTINCT {keys}, d FROM purchases WHERE {where}) WINDOW w AS (PARTITION BY {keys} ORDER BY d))"""

    return f"""purchases AS (SELECT DISTINCT {keys}, CAST(txn_dt AS DATE) AS d, prch_chnl_cd AS ch
  FROM ({SALES_SQL}) WHERE {USABLE}),
{channel('total', 'true')},
{channel('web', "ch = 'F'")},
{channel('store', "ch = 'A'")},
days AS (SELECT {keys}, CAST(unnest(generate_series(min(d), {RUN}, INTERVAL 1 DAY)) AS DATE) AS day
  FROM purchases GROUP BY {keys}),
labelled AS (SELECT {', '.join('days.' + k for k in keys.split(', '))}, days.day,
    {_label_sql('total')} AS TOTAL_CS, {_label_sql('web')} AS MCOM_CS, {_label_sql('store')} AS STORE_CS,
    total.d AS last_purchase_dt_total, web.d AS last_purchase_dt_mcom, store.d AS last_purchase_dt_store
  FROM days ASOF JOIN total ON {same('total')} AND days.day >= total.d
  ASOF LEFT JOIN web ON {same('web')} AND days.day >= web.d
  ASOF LEFT JOIN store ON {same('store')} AND days.day >= store.d)"""


LABELS = "TOTAL_CS, MCOM_CS, STORE_CS"
LAST = "last_purchase_dt_total, last_purchase_dt_mcom, last_purchase_dt_store"
TOTAL_SQL = f"""SELECT min(day) AS GREG_START_DT, max(day) AS GREG_END_DT, indiv_id AS INDV_ID,
  CAST(NULL AS INT) AS RTL_DIVN_NBR, 'TOTAL' AS FILTER_TYPE, 'TOTAL' AS FILTER_LEVEL, {LABELS}, {LAST},
  0 AS Attr_Flag, '{NOT_IN_REPORT}' AS Flag_Desc
FROM labelled GROUP BY indiv_id, {LABELS}, {LAST}"""
NAMES_SQL = "(VALUES " + ", ".join(f"({d}, {p}, '{n}')" for d, p, n in default_names()) + ")"
FLAG_SQL = """rtl_divn_nbr = 71 AND coalesce(pdiv_id IN (14, 15, 17, 44, 50, 52), false)"""
NAMED_SQL = f"""named AS (SELECT l.*, n.name AS FILTER_LEVEL, CASE WHEN {FLAG_SQL} THEN 1 ELSE 0 END AS Attr_Flag
  FROM labelled l LEFT JOIN {NAMES_SQL} n(divn, pdiv, name) ON l.rtl_divn_nbr = n.divn AND l.pdiv_id = n.pdiv),
spans AS (SELECT indiv_id, FILTER_LEVEL, rtl_divn_nbr, {LABELS}, {LAST}, Attr_Flag, min(day) AS low, max(day) AS high
  FROM named GROUP BY ALL)"""
DIVISION_SQL = f"""SELECT DISTINCT min(low) OVER w AS GREG_START_DT, max(high) OVER w AS GREG_END_DT,
  indiv_id AS INDV_ID, rtl_divn_nbr AS RTL_DIVN_NBR, 'Prod_hier' AS FILTER_TYPE, FILTER_LEVEL, {LABELS}, {LAST},
  Attr_Flag, CASE WHEN Attr_Flag = 1 THEN '{IN_REPORT}' ELSE '{NOT_IN_REPORT}' END AS Flag_Desc
FROM spans WINDOW w AS (PARTITION BY indiv_id, FILTER_LEVEL, rtl_divn_nbr, {LABELS}, last_purchase_dt_total
  ORDER BY last_purchase_dt_mcom ASC NULLS FIRST, last_purchase_dt_store ASC NULLS FIRST)"""


@query("lifecycle_total", f"WITH {_days_sql('indiv_id')} {TOTAL_SQL}")
def lifecycle_total(spark, sf):
    return job.lifecycle_total(sales(spark, sf), RUN_DATE)


@query("lifecycle_total_ordered", f"WITH {_days_sql('indiv_id')} {TOTAL_SQL} ORDER BY {', '.join(job.TOTAL_ORDER)}")
def lifecycle_total_ordered(spark, sf):
    return job.lifecycle_total(sales(spark, sf), RUN_DATE, ordered=True)


@query("lifecycle_total_daily", f"WITH {_days_sql('indiv_id')} {TOTAL_SQL}")
def lifecycle_total_daily(spark, sf):
    return job.lifecycle_total(sales(spark, sf), RUN_DATE, form="daily")


@query("lifecycle_total_staged", f"WITH {_days_sql('indiv_id')} {TOTAL_SQL}")
def lifecycle_total_staged(spark, sf):
    return job.lifecycle_total(sales(spark, sf), RUN_DATE, form="staged")


@query(
    "lifecycle_days",
    f"""WITH {_days_sql('indiv_id')} SELECT day AS greg_date, {LABELS}, count(*) AS customers,
  min(last_purchase_dt_total) AS oldest_total, max(last_purchase_dt_mcom) AS newest_mcom,
  max(last_purchase_dt_store) AS newest_store
FROM labelled GROUP BY day, {LABELS}""",
)
def lifecycle_days(spark, sf):
    """Customers by day and labels, over the whole day table."""
    days = job.day_table(total_tx(spark, sf), job.TOTAL_KEYS, RUN_DATE)
    return days.groupBy("greg_date", *job.LABELS).agg(
        F.count(F.lit(1)).alias("customers"),
        F.min("last_purchase_dt_total").alias("oldest_total"),
        F.max("last_purchase_dt_mcom").alias("newest_mcom"),
        F.max("last_purchase_dt_store").alias("newest_store"),
    )


DIVISION_DAYS = _days_sql("indiv_id, pdiv_id, rtl_divn_nbr")


@query("lifecycle_division", f"WITH {DIVISION_DAYS}, {NAMED_SQL} {DIVISION_SQL}")
def lifecycle_division(spark, sf):
    return job.lifecycle_division(sales(spark, sf), RUN_DATE)


@query(
    "lifecycle_division_ordered",
    f"WITH {DIVISION_DAYS}, {NAMED_SQL} {DIVISION_SQL} ORDER BY {', '.join(job.DIVISION_ORDER)}",
)
def lifecycle_division_ordered(spark, sf):
    return job.lifecycle_division(sales(spark, sf), RUN_DATE, ordered=True)


@query(
    "total_plus_division",
    f"WITH {_days_sql('indiv_id')} {TOTAL_SQL} UNION ALL BY NAME "
    f"(WITH {DIVISION_DAYS}, {NAMED_SQL} {DIVISION_SQL})",
)
def total_plus_division(spark, sf):
    return job.lifecycle_total_and_division(sales(spark, sf), RUN_DATE)


# --- single stages -------------------------------------------------------------------------------


@query(
    "pick_daily",
    f"""WITH {_days_sql('indiv_id')} SELECT labelled.indiv_id, day AS greg_date, {LABELS}, {LAST} FROM labelled
WHERE day = date_trunc('month', day)""",
)
def pick_daily(spark, sf):
    return job.label_days(job.spine_of(job.pick_spans(month_spans(spark, sf)), monthly=True))


@query(
    "pick_daily_days",
    f"""WITH {_days_sql('indiv_id')} SELECT labelled.indiv_id, day AS greg_date, {LABELS}, {LAST} FROM labelled""",
)
def pick_daily_days(spark, sf):
    """`pick_daily` on every day of the look-back, purchase days among them."""
    return job.label_days(job.spine_of(job.pick_spans(day_spans(spark, sf))))


@query(
    "product_hierarchy",
    f"""SELECT indiv_id, pdiv_id, rtl_divn_nbr, n.name AS FILTER_LEVEL, CASE WHEN {FLAG_SQL} THEN 1 ELSE 0 END AS Attr_Flag,
  CASE WHEN {FLAG_SQL} THEN '{IN_REPORT}' ELSE '{NOT_IN_REPORT}' END AS Flag_Desc
FROM ({sql_text(MIXED_SALES)}) t LEFT JOIN {NAMES_SQL} n(divn, pdiv, name)
  ON t.rtl_divn_nbr = n.divn AND t.pdiv_id = n.pdiv""",
)
def product_hierarchy(spark, sf):
    sold = stand_in(spark, sf, MIXED_SALES).select("indiv_id", "pdiv_id", "rtl_divn_nbr")
    return with_hierarchy(sold, default_mapping(spark))


@query(
    "running_ranges",
    """SELECT DISTINCT o_custkey, o_orderstatus, d, min(d) OVER w AS range_start, max(o) OVER w AS range_end
FROM (SELECT o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS d, o_totalprice AS o FROM orders)
WINDOW w AS (PARTITION BY o_custkey, o_orderstatus ORDER BY d RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def running_ranges(spark, sf):
    days = read(spark, sf, "orders").withColumn("d", F.to_date("o_orderdate"))
    return running_range(days, ["o_custkey", "o_orderstatus"], ["d"], "d", "o_totalprice")


@query(
    "running_ranges_moments",
    """SELECT DISTINCT event_type, ts, min(user_id) OVER w AS range_start, max(user_id) OVER w AS range_end FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def running_ranges_moments(spark, sf):
    """A few groups, each with any number of moments."""
    return running_range(read(spark, sf, "events"), ["event_type"], ["ts"], "user_id", "user_id", spread=True)


@query(
    "asof_latest_error",
    """SELECT l.event_id, l.shard, l.ts, r.ts AS error_at, r.error_id
FROM (SELECT event_id, user_id % 4 AS shard, ts FROM events WHERE event_type <> 'error') l
ASOF LEFT JOIN (SELECT user_id % 4 AS shard, ts, max(event_id) AS error_id FROM events WHERE event_type = 'error' GROUP BY ALL) r
  ON l.shard = r.shard AND l.ts >= r.ts""",
)
def asof_latest_error(spark, sf):
    """Every other event of a shard with the error before it, by moments."""
    events = read(spark, sf, "events").withColumn("shard", F.col("user_id") % 4)
    others = events.filter("event_type <> 'error'").select("event_id", "shard", "ts")
    errors = events.filter("event_type = 'error'").selectExpr("shard", "ts AS error_at", "event_id AS error_id")
    return asof_latest(others, errors, ["shard"], "ts", "error_at", ["error_id"], spread=True)


@query(
    "group_without_aggregates",
    f"""SELECT o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS d FROM orders
WHERE o_orderpriority NOT IN ('3-MEDIUM', '5-LOW') AND o_orderstatus IN ('F', 'P')
  AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
  AND date_diff('day', CAST(o_orderdate AS DATE), {RUN}) <= 1800
GROUP BY ALL ORDER BY o_custkey NULLS FIRST, d NULLS FIRST""",
)
def group_without_aggregates(spark, sf):
    day = F.col("d")
    return (
        read(spark, sf, "orders")
        .withColumn("d", F.to_date("o_orderdate"))
        .filter(~F.col("o_orderpriority").isin("3-MEDIUM", "5-LOW") & F.col("o_orderstatus").isin("F", "P"))
        .filter(day.between(as_date("1996-01-01"), as_date("2000-12-31")))
        .filter(day_gap(as_date(RUN_DATE), day) <= 1800)
        .select("o_custkey", "o_orderpriority", "d")
        .dropDuplicates()
        .orderBy("o_custkey", "d")
    )


@query(
    "date_expressions",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(o_orderdate AS DATE) AS ordered, CAST(l_shipdate AS DATE) AS shipped,
  CAST(date_diff('month', o_orderdate, l_shipdate) AS INTEGER) AS months,
  CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS days,
  CAST(date_trunc('month', o_orderdate) + INTERVAL 13 MONTH AS DATE) AS lapse_start,
  CAST(l_shipdate AS DATE) - 30 AS month_before
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def date_expressions(spark, sf):
    joined = read(spark, sf, "lineitem").join(
        read(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    ordered, shipped = F.to_date("o_orderdate"), F.to_date("l_shipdate")
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        ordered.alias("ordered"),
        shipped.alias("shipped"),
        month_boundaries(shipped, ordered).alias("months"),
        day_gap(shipped, ordered).alias("days"),
        month_start(ordered, 13).alias("lapse_start"),
        F.date_sub(shipped, 30).alias("month_before"),
    )
