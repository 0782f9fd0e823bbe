import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from tests.helpers import at, day, plan, rows, same

from checks.lifecycle import sales, sales_by_month
from checks.standins import RUN_DATE
from tablejobs.plans import lifecycle as job
from tablejobs.plans.hierarchy import MAPPING_SCHEMA, default_mapping, default_names, with_hierarchy

SCHEMA = (
    "indiv_id bigint, txn_dt timestamp, prch_chnl_cd string, fin_own_lease_ind string, rtl_divn_nbr int, "
    "pdiv_id int, dept_vnd_cd string, vst_cd string"
)
A = 10000001


def sale(customer=A, when="2000-01-05", channel="F", pdiv=14, division=71, own="Y", vendor="v", visit="s"):
    return (customer, at(when), channel, own, division, pdiv, vendor, visit)


def table(spark, *sales):
    return spark.createDataFrame(list(sales), SCHEMA)


def label(today, first, prev, last):
    """The rules, read once more, day by day."""
    if last is None:
        return None
    months = lambda a, b: (a.year - b.year) * 12 + a.month - b.month
    if today == first:
        return "NET NEW"
    if today == last and prev is not None and months(last, prev) >= 24:
        return "NEW"
    if today == last and prev is not None and 13 <= months(last, prev) <= 24:
        return "REACTIVE"
    away = months(today, last)
    return "INACTIVE" if away > 24 else "LAPSED" if away >= 13 else "RETAINED"


def by_day(purchases, run):
    """{day: (labels, last days)} of one key, from (day, channel) pairs."""
    out = {}
    today = min(d for d, _ in purchases)
    while today <= run:
        labels, lasts = [], []
        for channels in ("AF", "F", "A"):
            days = sorted({d for d, c in purchases if c in channels and d <= today})
            labels.append(
                label(today, days[0], days[-2] if len(days) > 1 else None, days[-1]) if days else None
            )
            lasts.append(days[-1] if days else None)
        out[today] = (*labels, *lasts)
        today += dt.timedelta(1)
    return out


def ranges_of(days):
    """Spans of equal labels and last days."""
    spans = {}
    for today, state in days.items():
        low, high = spans.get(state, (today, today))
        spans[state] = (min(low, today), max(high, today))
    return sorted(((low, high, *state) for state, (low, high) in spans.items()), key=repr)


PURCHASES = {
    "one purchase": ["2000-01-31 F"],
    "twice a day after a long gap": ["1998-01-10 A", "1999-03-01 F", "1999-03-01 F", "1999-03-01 A"],
    "12, 13, 24 and 25 months": ["1994-12-31 F", "1995-12-01 F", "1997-01-31 A", "1999-01-01 F", "2001-02-15 F"],
    "the 31st, then the 1st": ["1999-01-31 A", "1999-02-01 A", "1999-03-31 F"],
    "store only": ["1996-02-29 A", "1998-02-28 A"],
    "on the run date": ["2000-12-01 F", "2001-08-01 A"],
    "after the run date": ["2000-12-01 F", "2001-09-01 A"],
    "next purchase on a change day": ["1999-01-15 F", "2000-02-01 A", "2001-02-01 F"],
}


@pytest.mark.parametrize("form", ["segment", "daily", "staged"])
@pytest.mark.parametrize("name", PURCHASES)
def test_total_day_by_day(spark, name, form):
    bought = [p.split() for p in PURCHASES[name]]
    got = job.lifecycle_total(table(spark, *[sale(when=d, channel=c) for d, c in bought]), "2001-08-01", form=form)
    expected = ranges_of(by_day([(day(d), c) for d, c in bought], day("2001-08-01")))
    assert rows(got.select("GREG_START_DT", "GREG_END_DT", *job.LABELS, *job.LAST_DAYS)) == expected


def test_many_random_customers(spark):
    random.seed(11)
    run, data, expected = day("2001-08-01"), [], []
    for customer in range(A, A + 40):
        bought = [
            (run - dt.timedelta(random.randrange(2501)), random.choice("AF")) for _ in range(random.randrange(1, 12))
        ]
        data += [sale(customer, str(d), c) for d, c in bought]
        expected += [(customer, *r) for r in ranges_of(by_day(bought, run))]
    got = job.lifecycle_total(table(spark, *data), run)
    columns = ["INDV_ID", "GREG_START_DT", "GREG_END_DT", *job.LABELS, *job.LAST_DAYS]
    assert rows(got.select(*columns)) == sorted(expected, key=repr)


def test_transaction_rules(spark):
    kept = sale(when="1994-09-27 00:00:00")
    refused = [
        sale(when="1994-09-26 23:59:59"),
        sale(channel="X"),
        sale(own="N"),
        sale(own=None),
        sale(division=80),
        sale(vendor=None),
        sale(visit=None),
        sale(customer=None),
        sale(customer=1),
        sale(customer=1234567),
    ]
    df = table(spark, kept, *refused)
    assert rows(job.base_transactions(df, "2001-08-01")) == [(A, 14, 71, day("1994-09-27"), "F")]
    assert job.base_transactions(df, "2001-08-01", customers=[5]).isEmpty()


def test_excluding_product_divisions_also_drops_null(spark):
    df = table(spark, sale(pdiv=0), sale(pdiv=65), sale(pdiv=None), sale(pdiv=14))
    kept = job.base_transactions(df, "2001-08-01", exclude_pdiv=job.TOTAL_EXCLUDED_PDIV)
    assert [r.pdiv_id for r in kept.collect()] == [14]
    assert job.base_transactions(df, "2001-08-01").count() == 4


def unnamed(spark):
    """The running frame matters: two product divisions without a name share one level."""
    return table(
        spark,
        sale(when="2000-01-05", channel="F", pdiv=4),
        sale(when="2000-03-01", channel="A", pdiv=4),
        sale(when="2000-02-05", channel="F", pdiv=5),
        sale(when="2000-03-01", channel="A", pdiv=5),
    )


@pytest.mark.parametrize("form", ["segment", "daily", "staged"])
def test_running_frame_of_unnamed_levels(spark, form):
    got = job.lifecycle_division(unnamed(spark), "2001-08-01", form=form)
    retained = got.filter(" AND ".join(f"{c} = 'RETAINED'" for c in job.LABELS) + " AND GREG_START_DT = '2000-03-02'")
    assert got.count() == 12
    assert {str(r.GREG_END_DT) for r in retained.collect()} == {"2001-01-31", "2001-02-28"}


def test_null_product_division_has_no_channel(spark):
    df = table(spark, sale(when="2000-01-05", channel="F", pdiv=None), sale(when="2000-06-05", channel="A", pdiv=None))
    segment = job.lifecycle_division(df, "2001-08-01")
    assert {(r.MCOM_CS, r.STORE_CS, r.FILTER_LEVEL) for r in segment.collect()} == {(None, None, None)}
    assert same(segment, job.lifecycle_division(df, "2001-08-01", form="staged"))


def test_two_names_for_one_level_and_flags(spark):
    mapping = spark.createDataFrame([(71, 14, "both"), (71, 16, "both")], MAPPING_SCHEMA)
    df = table(
        spark,
        sale(when="2000-01-05", pdiv=14),
        sale(when="2000-01-05", pdiv=16),
        sale(when="2000-07-05", pdiv=16, channel="A"),
    )
    segment = job.lifecycle_division(df, "2001-08-01", mapping)
    assert same(segment, job.lifecycle_division(df, "2001-08-01", mapping, form="staged"))
    assert {r.Attr_Flag for r in segment.collect()} == {0, 1}


def test_forms_agree_on_the_test_tables(spark, sf):
    sold = sales(spark, sf)
    total = job.lifecycle_total(sold, RUN_DATE)
    for form in ("daily", "staged"):
        assert same(total, job.lifecycle_total(sold, RUN_DATE, form=form))
    some_null = sold.withColumn("pdiv_id", F.when(F.col("pdiv_id") != 13, F.col("pdiv_id")))
    few_names = default_mapping(spark).filter("pdiv_id < 12")
    segment = job.lifecycle_division(some_null, RUN_DATE, few_names).persist()
    for form in ("daily", "staged"):
        assert same(segment, job.lifecycle_division(some_null, RUN_DATE, few_names, form=form))
    segment.unpersist()
    nameless = default_mapping(spark).limit(0)
    assert same(
        job.lifecycle_division(some_null, RUN_DATE, nameless),
        job.lifecycle_division(some_null, RUN_DATE, nameless, form="daily"),
    )


def test_unknown_form(spark):
    with pytest.raises(ValueError, match="form"):
        job.lifecycle_total(table(spark, sale()), "2001-08-01", form="weekly")


def test_total_ranges_tile_the_time_of_each_customer(spark, sf):
    ranges = job.lifecycle_total(sales(spark, sf), RUN_DATE)
    window = Window.partitionBy("INDV_ID").orderBy("GREG_START_DT")
    after = ranges.withColumn("next", F.lead("GREG_START_DT").over(window))
    assert after.filter("next <> date_add(GREG_END_DT, 1)").isEmpty()
    assert after.filter(f"next IS NULL AND GREG_END_DT <> DATE '{RUN_DATE}'").isEmpty()
    assert ranges.filter("GREG_START_DT < last_purchase_dt_total").isEmpty()


def test_net_new_comes_once(spark, sf):
    ranges = job.lifecycle_total(sales(spark, sf), RUN_DATE)
    tx = job.base_transactions(sales(spark, sf), RUN_DATE)
    for column, channels in (("TOTAL_CS", "AF"), ("MCOM_CS", "F"), ("STORE_CS", "A")):
        found = ranges.filter(F.col(column) == "NET NEW").filter("GREG_START_DT = GREG_END_DT").select("INDV_ID")
        buyers = tx.filter(F.col("prch_chnl_cd").isin(*channels)).select("indiv_id").distinct()
        assert found.count() == found.distinct().count() == buyers.count()


def test_layout_and_order(spark, sf):
    total = job.lifecycle_total(sales(spark, sf), RUN_DATE, ordered=True)
    division = job.lifecycle_division(sales(spark, sf), RUN_DATE, ordered=True)
    both = job.total_and_division(total, division)
    assert tuple(total.columns) == tuple(division.columns) == job.RANGE_COLUMNS
    assert [f.dataType for f in total.schema] == [f.dataType for f in division.schema]
    assert both.count() == total.count() + division.count()
    null_first = lambda r, order: tuple((r[c] is not None, r[c]) for c in order)
    for df, order in ((total, job.TOTAL_ORDER), (division, job.DIVISION_ORDER)):
        listed = [null_first(r, order) for r in df.collect()]
        assert listed == sorted(listed)


def test_names(spark):
    names = default_names()
    assert len(names) == 53 and len({n[:2] for n in names}) == 53
    df = table(spark, sale(pdiv=14), sale(pdiv=14, division=77), sale(pdiv=11), sale(pdiv=None))
    got = with_hierarchy(df, default_mapping(spark)).select("rtl_divn_nbr", "pdiv_id", "FILTER_LEVEL", "Attr_Flag")
    assert rows(got) == sorted(
        [(71, 14, "COSMETICS", 1), (77, 14, "BEAUTY", 0), (71, 11, None, 0), (71, None, None, 0)], key=repr
    )


def test_segment_plan(spark, sf, capsys):
    """Two shuffles, no join in the total and one broadcast in the division, filters at the scan."""
    path = f"{sf}/orders.parquet"
    sold = sales(spark, sf)
    total = plan(job.lifecycle_total(sold, RUN_DATE), capsys)
    division = plan(job.lifecycle_division(sold, RUN_DATE), capsys)
    for text in (total, division):
        assert text.count("Exchange hashpartitioning") == 2
        assert "partial_max" in text[text.index("Exchange hashpartitioning") :]
        assert "GreaterThanOrEqual(o_orderdate,1994-09-27" in text and path.rsplit("/", 1)[-1] in text
    assert "Join" not in total
    assert division.count("Join") == division.count("BroadcastHashJoin") == 1


def test_both_reports_share_a_scan(spark, sf):
    """The final plan reads the sales once: the second report takes the shuffle of the first."""
    both = job.lifecycle_total_and_division(sales(spark, sf), RUN_DATE)
    apart = job.total_and_division(job.lifecycle_total(sales(spark, sf), RUN_DATE), job.lifecycle_division(sales(spark, sf), RUN_DATE))
    assert same(both, apart)
    both = job.lifecycle_total_and_division(sales(spark, sf), RUN_DATE)
    both.collect()
    final = both._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_months_before_the_look_back_are_not_read(spark, sf, capsys):
    text = plan(job.base_transactions(sales_by_month(spark, sf), RUN_DATE, month="txn_month"), capsys)
    assert "PartitionFilters: [isnotnull(txn_month" in text and ">= 199409)" in text


def test_customers_of_a_table(spark):
    df = table(spark, sale(), sale(20000000), sale(30000000))
    wanted = spark.createDataFrame([(20000000,), (20000000,), (None,), (5,)], "who long")
    got = job.base_transactions(df, "2001-08-01", customers=wanted)
    assert rows(got) == rows(job.base_transactions(df, "2001-08-01", customers=[20000000])) and got.count() == 1


def test_spine_plan_has_no_join(spark, sf, capsys):
    tx = job.base_transactions(sales(spark, sf), RUN_DATE)
    assert "Join" not in plan(job.customer_spine(tx, RUN_DATE), capsys)


def test_days_are_dealt_by_their_number(spark, sf, monkeypatch):
    """Not by their size in the shuffle, which adaptive execution would merge."""
    sold = sales(spark, sf)
    expected = job.lifecycle_division(sold, RUN_DATE)
    monkeypatch.setattr(job, "DEALT_ROWS", 100)
    tasks = job.base_transactions(sold, RUN_DATE).count() // 100 + 1
    assert job.dealt_days(job.base_transactions(sold, RUN_DATE), job.TOTAL_KEYS).rdd.getNumPartitions() == tasks > 4
    assert same(job.lifecycle_division(sold, RUN_DATE), expected)
