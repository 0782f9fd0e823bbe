import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from tests.helpers import at, day, plan, rows

from tablejobs.operators.windows import (
    latest_and_count,
    latest_per_key,
    neighbours,
    number_rows,
    order_column,
    pick_first,
    running_range,
)

LOG = "k int, _timestamp timestamp, _operation string, v string"


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(
        [
            (1, at("2024-01-01"), "I", "a"),
            (1, at("2024-01-02"), "U", "b"),
            (2, at("2024-01-01"), "I", "c"),
            (2, at("2024-01-03"), "U", "d"),
            (2, at("2024-01-03"), "U", "e"),
            (3, None, "U", "f"),
            (3, at("2024-01-01"), "U", "g"),
            (None, at("2024-01-01"), "U", "h"),
            (None, at("2024-01-02"), "U", "i"),
        ],
        LOG,
    )


def test_row_number_keeps_one_row_of_each_key(log):
    latest = rows(latest_per_key(log, ["k"], tiebreak=["v desc"]).select("k", "v"))
    assert latest == sorted([(1, "b"), (2, "e"), (3, "g"), (None, "i")], key=repr)


def test_row_number_without_tiebreak_is_the_same_whatever_the_partitions(log):
    picks = {tuple(rows(latest_per_key(log.repartition(n), ["k"]))) for n in (1, 3, 7)}
    assert len(picks) == 1


def test_rank_keeps_ties(log):
    latest = rows(latest_per_key(log, ["k"], mode="rank").filter("k = 2").select("v"))
    assert latest == [("d",), ("e",)]


def test_no_dedup_and_unknown_mode(log):
    assert latest_per_key(log, ["k"], mode="none").count() == 9
    with pytest.raises(ValueError, match="mode"):
        latest_per_key(log, ["k"], mode="first")


@pytest.mark.parametrize("mode", ["row_number", "rank"])
def test_latest_is_cut_down_before_the_shuffle(log, capsys, mode):
    text = plan(latest_per_key(log, ["k"], mode=mode), capsys)
    if mode == "rank":
        assert "Window" not in text and "LeftSemi" in text
        assert text.count("partial_max(struct") == 1
        return
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_order_terms():
    with pytest.raises(ValueError, match="order term"):
        order_column("a sideways")


def test_pick_first_puts_null_last_and_can_keep_the_rank(spark):
    df = spark.createDataFrame([(1, None, 5), (1, 3, 1), (1, 3, 2)], "k int, a int, b int")
    assert rows(pick_first(df, ["k"], ["a desc", "b desc"])) == [(1, 3, 2)]
    assert rows(pick_first(df, ["k"], ["a desc", "b desc"], keep_rank="rnk")) == [(1, 3, 2, 1)]


def test_neighbours(spark):
    days = [("x", "2020-01-31"), ("x", "2020-02-01"), ("x", "2022-01-15"), ("y", "2021-01-01")]
    df = spark.createDataFrame([(k, day(d)) for k, d in days], "k string, d date")
    found = {(r.k, str(r.tx_date)): r for r in neighbours(df, ["k"], "d").collect()}
    first, second, last = (found[d] for d in days[:3])
    assert (first.prv_tx_date, first.months_between_txn_prv, first.months_between_txn_nxt) == (None, None, 1)
    assert (second.prv_tx_date, second.nxt_tx_dt) == (day("2020-01-31"), day("2022-01-15"))
    assert (last.nxt_tx_dt, last.months_between_txn_nxt, last.months_between_txn_prv) == (day("3499-12-31"), None, 23)
    assert {(r.first_purchase, r.last_purchase) for d, r in found.items() if d[0] == "x"} == {
        (day("2020-01-31"), day("2022-01-15"))
    }
    assert found[("y", "2021-01-01")].prv_tx_date is None


def test_running_range_counts_peers_and_null_order_first(spark):
    df = spark.createDataFrame(
        [("p", None, 5, 6), ("p", 1, 3, 4), ("p", 1, 7, 9), ("p", 2, 1, 2), ("q", 1, 8, 8)],
        "p string, o int, s int, e int",
    )
    got = rows(running_range(df, ["p"], ["o"], "s", "e").select("p", "o", "range_start", "range_end"))
    assert got == sorted([("p", None, 5, 6), ("p", 1, 3, 9), ("p", 2, 1, 9), ("q", 1, 8, 8)], key=repr)


def test_running_range_with_carry_sees_all_peers(spark):
    df = spark.createDataFrame([("p", 1, 3, 4, "a"), ("p", 1, 7, 9, "b")], "p string, o int, s int, e int, c string")
    got = rows(running_range(df, ["p"], ["o"], "s", "e", carry=["c"]).select("c", "range_start", "range_end"))
    assert got == [("a", 3, 9), ("b", 3, 9)]


@pytest.mark.parametrize("depth", [0, 1, 2, 4])
def test_number_rows_against_sorting(spark, depth):
    """One group holds a third of all rows; NULLs in keys and order."""
    random.seed(depth)
    data = []
    for i in range(400):
        key = "hot" if random.random() < 0.35 else random.choice(["a", "b", "c", None])
        text = random.choice([None, "2024-01-01", "2024-01-02", "2023-05-05", "zz"])
        moment = random.choice([None, at("2024-01-01 10:15:00"), at("2024-01-01 10:45:00"), at("2024-02-01 00:00:00")])
        data.append((key, text, moment, i))
    df = spark.createDataFrame(data, "k string, t string, m timestamp, i int")
    # Each seed of data in another number of ranges.
    spark.conf.set("spark.sql.shuffle.partitions", str(1 + 3 * depth))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.i: r.n for r in number_rows(df, ["k"], ["t", "m", "i"], "n").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = {}
    for key in {r[0] for r in data}:
        group = sorted(
            (r for r in data if r[0] == key), key=lambda r: (r[1] is None, r[1] or "", r[2] is None, str(r[2]), r[3])
        )
        expected.update({r[3]: n for n, r in enumerate(group, 1)})
    assert got == expected


def test_a_hot_group_is_dealt_out_above_a_join(spark, capsys):
    """90 % of the rows have one key; the join below has already hashed them by it. The input is read once."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(4000).select(F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("i"))
        joined = left.join(spark.range(4000).select(F.col("id").alias("k")), "k")
        numbered = number_rows(joined, ["k"], ["i"], "n")
        text = plan(numbered, capsys)
        assert "Range (" not in text and text.count("FileScan") == 2
        hot = numbered.filter("k = 0").groupBy(F.spark_partition_id()).count()
        assert hot.count() > 1
        assert numbered.filter("k = 0").agg(F.max("n"), F.countDistinct("n")).first() == (3601, 3601)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_number_rows_edges(spark):
    nothing = spark.createDataFrame([], "k string, __own int")
    assert number_rows(nothing, ["k"], ["__own"], "n").columns == ["k", "__own", "n"] and number_rows(nothing, ["k"], ["__own"], "n").isEmpty()
    same_rows = spark.createDataFrame([(None, 1)] * 50, "k string, i int")
    assert sorted(r.n for r in number_rows(same_rows, ["k"], ["i"], "n").collect()) == list(range(1, 51))


@pytest.mark.parametrize("order", [["t desc"], ["t asc"], ["t desc", "u desc"], ["t asc", "u desc"], ["t"]])
def test_ties_against_the_window(spark, order):
    """Ranks by the semi-join are those of a window, with NULLs in keys and order."""
    random.seed(len(order))
    pick = lambda *values: random.choice(values)
    data = [(pick("a", "b", None), pick(1, None), pick(None, 1, 2), pick(None, 5, 6), i) for i in range(60)]
    df = spark.createDataFrame(data, "k string, j int, t int, u int, i int")
    got = latest_per_key(df, ["k", "j"], order, mode="rank")
    window = Window.partitionBy("k", "j").orderBy(*[order_column(t) for t in order])
    expected = df.withColumn("r", F.rank().over(window)).filter("r = 1").drop("r")
    assert got.columns == df.columns and rows(got) == rows(expected)


def test_latest_and_count(spark):
    random.seed(9)
    data = [(random.choice(["a", "b", None]), random.choice([None, 1, 2, 3]), i) for i in range(40)]
    df = spark.createDataFrame(data, "k string, t int, i int")
    got = latest_and_count(df, ["k"], ["t desc"], "n")
    counts = df.groupBy("k").count()
    assert rows(got.drop("n")) == rows(latest_per_key(df, ["k"], ["t desc"]))
    assert rows(got.select("k", "n")) == rows(counts)
    with pytest.raises(ValueError, match="go down"):
        latest_and_count(df, ["k"], ["t asc"], "n")


def test_fingerprint_passes_over_nested_maps(spark):
    df = spark.sql("SELECT 1 AS k, TIMESTAMP '2024-01-01 00:00:00' AS _timestamp, array(map('a', 1)) AS m, named_struct('x', map('b', 2)) AS s")
    assert latest_per_key(df, ["k"]).count() == 1


def test_latest_and_count_keeps_some_columns(spark, capsys):
    """Ties fall as with all columns, and a join on the keys moves the rows no further."""
    df = spark.createDataFrame([(i % 3, i % 2, i, str(i)) for i in range(30)], "k int, t int, i int, s string")
    some = latest_and_count(df, ["k"], ["t desc"], "n", ["k", "s"])
    assert rows(some) == rows(latest_and_count(df, ["k"], ["t desc"], "n").select("k", "s", "n"))
    joined = some.join(df.select(F.col("k").alias("j")).distinct().hint("merge"), F.col("k") == F.col("j"))
    assert plan(joined, capsys).count("Exchange hashpartitioning") == 2
