import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from tests.helpers import day, plan, rows

from tablejobs.operators.joins import (
    Edge,
    asof_latest,
    interval_join,
    lookup_join,
    oid_join,
    require_tables,
    star_join,
)

START = dt.date(2020, 1, 1)


@pytest.fixture(scope="module")
def tables(spark):
    things = spark.createDataFrame(
        [(1, 1, 10), (2, 1, None), (3, None, 10), (4, 1, 99), (5, 2, 10)],
        "thing int, myOwner_clsno int, myOwner_instid bigint",
    )
    owners = spark.createDataFrame(
        [(1, 10, "ann"), (1, 11, "bob"), (None, 10, "nobody")], "oid_clsno int, oid_instid bigint, name string"
    )
    return {"things": things, "owners": owners}


def test_half_a_reference_matches_nothing(tables):
    joined = oid_join(tables["things"].alias("t"), tables["owners"].alias("o"), "t.myOwner", "o.oid", "left")
    assert rows(joined.select("thing", "name")) == [(1, "ann"), (2, None), (3, None), (4, None), (5, None)]
    inner = oid_join(tables["things"].alias("t"), tables["owners"].alias("o"), "t.myOwner", "o.oid", "inner")
    assert rows(inner.select("thing")) == [(1,)]


def test_star_takes_one_table_in_two_roles(spark, tables):
    pairs = spark.createDataFrame(
        [(1, 1, 10, 1, 11), (2, 1, 11, 1, 12)],
        "id int, myA_clsno int, myA_instid bigint, myB_clsno int, myB_instid bigint",
    )
    edges = [Edge("a", "owners", "p.myA", "a.oid", "inner"), Edge("b", "owners", "p.myB", "b.oid")]
    joined = star_join({**tables, "pairs": pairs}, ("p", "pairs"), edges)
    assert rows(joined.select("id", F.col("a.name"), F.col("b.name"))) == [(1, "ann", "bob"), (2, "bob", None)]


def test_missing_tables_are_all_named(tables):
    with pytest.raises(ValueError, match="x, y"):
        require_tables(tables, ["things", "x", "y"])


def test_lookup_join_runs_no_job_and_hints_nothing(spark, tables):
    things, owners = tables["things"].alias("t"), tables["owners"].alias("o")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    joined = lookup_join(things, owners, "t.myOwner", "o.oid")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == jobs
    assert "hint" not in joined._jdf.queryExecution().logical().toString().lower()
    assert joined.count() == tables["things"].count()


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("horizon", [START - dt.timedelta(400), START + dt.timedelta(100), START + dt.timedelta(4000)])
def test_interval_join_against_all_pairs(spark, how, horizon):
    """Overlapping and open intervals, an interval that ends before it starts, and any horizon."""
    random.seed(7)
    points = [
        (i, random.choice(["a", "b", None]), START + dt.timedelta(random.randrange(300)) if i % 9 else None)
        for i in range(150)
    ]
    intervals = []
    for j in range(60):
        begin = START + dt.timedelta(random.randrange(300))
        end = dt.date(3499, 12, 31) if j % 7 == 0 else begin + dt.timedelta(random.randrange(-3, 90))
        intervals.append((j, random.choice(["a", "b", None]), begin, end))
    got = interval_join(
        spark.createDataFrame(points, "p int, k string, d date"),
        spark.createDataFrame(intervals, "i int, k string, s date, e date"),
        ["k"],
        "d",
        "s",
        "e",
        horizon,
        how,
    )
    expected = []
    for p, k, d in points:
        hits = [i for i, k2, s, e in intervals if k is not None and k == k2 and d is not None and s <= d <= e]
        expected += [(p, i) for i in hits] or ([(p, None)] if how == "left" else [])
    assert rows(got.select("p", "i")) == sorted(expected, key=repr)


def test_interval_join_has_no_pairwise_plan(spark, capsys):
    start = F.date_add(F.lit(START), F.col("id").cast("int"))
    points = spark.range(3).select(F.col("id").alias("k"), start.alias("d"))
    spans = spark.range(3).select(F.col("id").alias("k"), start.alias("s"), F.date_add(start, 3).alias("e"))
    text = plan(interval_join(points, spans, ["k"], "d", "s", "e", START), capsys)
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_asof_against_scanning(spark):
    """A third of the left rows share one key and day."""
    random.seed(3)
    left = [(i, "hot" if i % 3 == 0 else random.choice(["a", "b", None]), random.randrange(40)) for i in range(200)]
    left = [(i, k, START if k == "hot" else START + dt.timedelta(n) if n else None) for i, k, n in left]
    right = [(random.choice(["hot", "a", "b", None]), START + dt.timedelta(random.randrange(-10, 40)), n) for n in range(60)]
    got = asof_latest(
        spark.createDataFrame(left, "i int, k string, d date"),
        spark.createDataFrame(right, "k string, rd date, v int"),
        ["k"],
        "d",
        "rd",
        ["v"],
    )
    expected = []
    for i, k, d in left:
        hits = [(rd, v) for rk, rd, v in right if k is not None and rk == k and d is not None and rd <= d]
        expected.append((i, *(max(hits) if hits else (None, None))))
    assert rows(got.select("i", "rd", "v")) == sorted(expected, key=repr)
    assert day("2020-01-01") == START
