import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from checks.lifecycle import sales
from checks.registry import QUERIES
from checks.standins import RUN_DATE
from tablejobs.operators.joins import each_day, interval_join, span_join
from tablejobs.plans import lifecycle as job
from tests.helpers import plan, same


def test_stages_cover_every_day(spark, sf):
    """The queries of single stages have all days of the look-back, and purchase days in both intervals."""
    joined = QUERIES["interval_join_days"](spark, sf)
    days = joined.groupBy("indiv_id").agg(F.countDistinct("greg_date").alias("n"))
    assert [r.n for r in days.select("n").distinct().collect()] == [job.LOOKBACK_DAYS + 1]
    met = joined.filter("greg_date = tx_date").join(
        joined.filter("greg_date = nxt_tx_dt").select("indiv_id", "greg_date"), ["indiv_id", "greg_date"]
    )
    tx = job.base_transactions(sales(spark, sf), RUN_DATE).filter("pdiv_id not in (0, 65)")
    bought = tx.select("indiv_id", "tx_date").distinct()
    assert met.count() == bought.count() - bought.select("indiv_id").distinct().count() > 0
    rolled, picked = QUERIES["roll_up_days"](spark, sf), QUERIES["pick_daily_days"](spark, sf)
    own = ["indiv_id", "greg_date"]
    assert picked.count() == rolled.select(own).distinct().count() == picked.select(own).distinct().count() < rolled.count()
    assert {r.TOTAL_CS for r in picked.filter("greg_date = last_purchase_dt_total").select("TOTAL_CS").collect()} >= {"NET NEW", "RETAINED"}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_span_join_is_interval_join_of_days(spark, how):
    """Overlapping and open intervals, gaps, several spans of a key, NULL keys, an interval that ends before it starts."""
    random.seed(5)
    start = dt.date(2020, 1, 1)
    some_day = lambda: start + dt.timedelta(random.randrange(120))
    spans = [(i, random.choice(["a", "b", "c", None]), d, d + dt.timedelta(random.randrange(-2, 60))) for i in range(12) for d in [some_day()]]
    intervals = []
    for j in range(14):
        begin = some_day()
        end = dt.date(3499, 12, 31) if j == 9 else begin + dt.timedelta(random.randrange(-3, 12))
        intervals.append((j, random.choice(["a", "b", None]), begin, end))
    spans = spark.createDataFrame(spans, "p int, k string, f date, l date").filter("f <= l")
    intervals = spark.createDataFrame(intervals, "i int, k string, s date, e date")
    joined = each_day(span_join(spans, intervals, ["k"], "f", "l", "s", "e", how), "f", "l", "d")
    assert same(joined, interval_join(each_day(spans, "f", "l", "d"), intervals, ["k"], "d", "s", "e", dt.date(2020, 9, 1), how))
    months = each_day(spans, "f", "l", "d", monthly=True)
    assert same(months, each_day(spans, "f", "l", "d").filter("day(d) = 1")) and not months.isEmpty()


def test_stages_by_spans_are_those_by_days(spark, sf):
    tx = job.base_transactions(sales(spark, sf), RUN_DATE).withColumn("pdiv_id", F.when(F.col("pdiv_id") != 13, F.col("pdiv_id")))
    tx = tx.filter("indiv_id % 5 = 0")
    for keys in (job.TOTAL_KEYS, job.DIVISION_KEYS):
        parts = [job.purchase_intervals(tx, keys, channel) for channel in (None, job.WEB, job.STORE)]
        by_days = job.roll_up(job.customer_spine(tx, RUN_DATE), *parts, keys, RUN_DATE)
        spans = job.roll_up_spans(job.customer_span(tx, RUN_DATE), *parts, keys)
        assert same(by_days, job.spine_of(spans))
        assert same(job.pick_daily(job.label_days(by_days, keys), keys), job.label_days(job.spine_of(job.pick_spans(spans, keys)), keys))


def test_slices_are_not_broadcast(spark, sf, capsys):
    """However small the intervals look before they are cut into slices."""
    assert "Broadcast" not in plan(QUERIES["interval_join"](spark, sf), capsys)
    for name in ("roll_up_days", "interval_join_days", "pick_daily", "lifecycle_total_staged"):
        text = plan(QUERIES[name](spark, sf), capsys)
        assert "Broadcast" not in text and "SortMergeJoin" in text
        # Days are made last, above every shuffle and sort.
        assert text.index("explode(") < text.index("Exchange")
