import datetime as dt

import pytest
from pyspark.sql import functions as F
from tests.helpers import day

from tablejobs.functions.dates import (
    as_date,
    day_gap,
    month_boundaries,
    month_start,
    parse_date,
    spine_days,
    within_lookback,
)
from tablejobs.functions.labels import lifecycle_label
from tablejobs.functions.text import empty, key_bytes, min_text_length, or_blank, parse_int, prefixed, row_hash


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def d(text):
    return as_date(text) if text else empty("date")


@pytest.mark.parametrize(
    "later, earlier, months",
    [("2024-02-01", "2024-01-31", 1), ("2024-01-31", "2024-01-01", 0), ("2025-02-28", "2023-12-31", 14)],
)
def test_month_boundaries_counts_firsts_of_months(spark, later, earlier, months):
    assert one(spark, month_boundaries(d(later), d(earlier))) == (months,)


def test_month_start_and_day_gap(spark):
    assert one(spark, month_start(d("2024-01-31"), 13), day_gap(d("2024-03-01"), d("2024-02-28"))) == (
        day("2025-02-01"),
        2,
    )


def test_spine_has_both_ends(spark):
    days = one(spark, spine_days("2001-08-01", 2500))[0]
    assert (len(days), days[0], days[-1]) == (2501, day("1994-09-27"), day("2001-08-01"))


def test_run_date_defaults_to_today(spark):
    assert one(spark, as_date(None) == F.current_date()) == (True,)


def test_bad_text_becomes_null_and_does_not_fail(spark):
    assert one(
        spark, parse_date(F.lit("2024-13-01")), parse_date(F.lit("2024-02-03")), parse_int(F.lit("x")), parse_int(F.lit("7"))
    ) == (None, day("2024-02-03"), None, 7)


def test_text(spark):
    nothing = empty("string")
    assert one(spark, prefixed("Link - ", nothing), prefixed("Link - ", F.lit("a")), or_blank(nothing)) == (
        "Link - ",
        "Link - a",
        "",
    )
    assert one(spark, key_bytes(F.lit(12)))[0] == b"12"


@pytest.mark.parametrize("length", [0, 1, 2, 3, 8])
def test_min_text_length_equals_the_length_of_the_text(spark, length):
    values = [-10000000, -9999999, -1000000, -999999, -100, -10, -9, -1, 0, 1, 9, 10, 99, 100, 9999999, 10000000, None]
    df = spark.createDataFrame([(v,) for v in values], "id bigint")
    kept = {r[0] for r in df.filter(min_text_length(df, "id", length)).collect()}
    assert kept == {v for v in values if v is not None and len(str(v)) >= length}
    texts = df.select(F.col("id").cast("string").alias("id"))
    assert {int(r[0]) for r in texts.filter(min_text_length(texts, "id", length)).collect()} == kept


def test_row_hash_tells_null_from_blank(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a")], "x string, y string")
    assert df.select(row_hash(["x", "y"]).alias("h")).distinct().count() == 3


def test_lookback_keeps_the_column_type(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2001-07-31 23:00:00' AS t UNION ALL SELECT TIMESTAMP_NTZ '2001-07-30 23:59:59'")
    kept = df.filter(within_lookback(df, "t", "2001-08-01", 1)).collect()
    assert [r[0] for r in kept] == [dt.datetime(2001, 7, 31, 23)]


@pytest.mark.parametrize(
    "today, first, prev, last, label",
    [
        ("2024-05-05", "2024-05-05", None, "2024-05-05", "NET NEW"),
        ("2024-05-05", "2020-01-01", "2023-05-31", "2024-05-05", "RETAINED"),  # 12 months
        ("2024-05-05", "2020-01-01", "2023-04-30", "2024-05-05", "REACTIVE"),  # 13 months
        ("2024-05-05", "2020-01-01", "2022-06-01", "2024-05-05", "REACTIVE"),  # 23 months
        ("2024-05-05", "2020-01-01", "2022-05-31", "2024-05-05", "NEW"),  # 24 months: both rules, the first wins
        ("2024-05-06", "2020-01-01", "2022-05-31", "2024-05-05", "RETAINED"),
        ("2025-05-31", "2020-01-01", None, "2024-05-05", "RETAINED"),
        ("2025-06-01", "2020-01-01", None, "2024-05-05", "LAPSED"),
        ("2026-05-31", "2020-01-01", None, "2024-05-05", "LAPSED"),
        ("2026-06-01", "2020-01-01", None, "2024-05-05", "INACTIVE"),
        ("2026-06-01", None, None, None, None),
    ],
)
def test_label(spark, today, first, prev, last, label):
    gap = month_boundaries(d(last), d(prev))
    assert one(spark, lifecycle_label(d(today), d(first), gap, d(last))) == (label,)
