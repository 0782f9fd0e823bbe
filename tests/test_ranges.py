"""Running ranges and as-of joins over moments, against the same operators over days; tables in buckets."""

import random
import uuid
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F
from tests.helpers import plan, rows, same

from tablejobs.operators.joins import Edge, asof_latest, star_join
from tablejobs.operators.windows import Ranges, running_range
from tablejobs.session import scratch_dir
from tablejobs.sources.tables import scan, write_bucketed


@contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.fixture(scope="module")
def moments(spark):
    """Half of the rows in one group, repeated moments, NULLs everywhere."""
    random.seed(5)
    pick = lambda values: random.choice([*values, None])
    data = [
        ("hot" if i % 2 else pick("abc"), pick(range(150)), pick(range(1000)), pick(range(1000)), pick("xy"))
        for i in range(600)
    ]
    return spark.createDataFrame(data, "k string, o int, s int, e int, c string")


@pytest.mark.parametrize("partitions", [1, 3, 11])
@pytest.mark.parametrize("carry", [[], ["c"]])
def test_running_range_of_ranges(spark, moments, partitions, carry):
    with settings(spark, spark__sql__shuffle__partitions=str(partitions), spark__sql__adaptive__coalescePartitions__enabled="false"):
        got = running_range(moments, ["k"], ["o"], "s", "e", carry, spread=True)
        expected = running_range(moments, ["k"], ["o"], "s", "e", carry)
        assert got.columns == expected.columns and rows(got) == rows(expected)


@pytest.mark.parametrize("partitions", [1, 3, 11])
def test_asof_of_ranges(spark, moments, partitions):
    left = moments.selectExpr("k", "o AS at", "s AS i")
    right = moments.filter("e < 100").selectExpr("k", "o AS found_at", "e", "c")
    with settings(spark, spark__sql__shuffle__partitions=str(partitions), spark__sql__adaptive__coalescePartitions__enabled="false"):
        got = asof_latest(left, right, ["k"], "at", "found_at", ["e", "c"], spread=True)
        expected = asof_latest(left, right, ["k"], "at", "found_at", ["e", "c"])
        assert got.columns == expected.columns and rows(got) == rows(expected)


def test_empty_tables(spark, moments):
    nothing = moments.limit(0)
    assert running_range(nothing, ["k"], ["o"], "s", "e", spread=True).isEmpty()
    found = asof_latest(moments.select("k", "o"), nothing.selectExpr("k", "o AS at", "s"), ["k"], "o", "at", ["s"], spread=True)
    assert found.count() == 600 and found.filter("s IS NOT NULL").isEmpty()


def test_a_group_of_many_moments_lies_in_many_tasks(spark):
    """A million moments of one key."""
    million = spark.range(1_000_000).select(F.lit(1).alias("k"), F.timestamp_seconds("id").alias("o"), F.col("id").alias("v"))
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        found = running_range(million, ["k"], ["o"], "v", "v", spread=True)
        assert found.agg(F.max("range_start"), F.sum(F.col("range_end"))).first() == (0, 999_999 * 500_000)
        sizes = Ranges(million, ["k"], [F.col("o").asc()]).rows.groupBy("__range").count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 400_000


# --- tables in buckets ---------------------------------------------------------------------------


@pytest.fixture()
def catalog(spark):
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}_objects LOCATION '{scratch_dir(spark, 'catalog')}'")
    yield name
    spark.sql(f"DROP DATABASE {name}_objects CASCADE")


def objects(spark):
    owner = "CASE WHEN id % 5 > 0 THEN id % 700 END"
    contracts = spark.range(3000).selectExpr("id", "7 AS myOwner_clsno", f"{owner} AS myOwner_instid")
    owners = spark.range(500).selectExpr("7 AS oid_clsno", "id AS oid_instid", "concat('n', id) AS name")
    return contracts, owners


def test_tables_in_buckets_are_joined_without_a_shuffle(spark, catalog, capsys):
    contracts, owners = objects(spark)
    assert write_bucketed(contracts, f"{catalog}_objects.contracts", "myOwner", buckets=6)
    assert write_bucketed(owners, f"{catalog}_objects.owners", "oid", buckets=6)
    edges = [Edge("o", "owners", "c.myOwner", "o.oid")]
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        ds = {n: scan(spark, f"{{db_env}}_objects.{n}", catalog) for n in ("contracts", "owners")}
        star = star_join(ds, ("c", "contracts"), edges)
        text = plan(star, capsys)
        assert "Exchange" not in text and "SortMergeJoin" in text and text.count("Bucketed: true") == 2
        plain = star_join({"contracts": contracts, "owners": owners}, ("c", "contracts"), edges)
        assert same(star.select("id", "name"), plain.select("id", "name"))


def test_a_hot_reference_gets_no_buckets(spark, catalog):
    hot = spark.range(3000).selectExpr("id", "7 AS my_clsno", "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS my_instid")
    assert not write_bucketed(hot, f"{catalog}_objects.hot", "my", buckets=16, task_rows=100)
    assert write_bucketed(hot, f"{catalog}_objects.small", "my", buckets=16)
    assert write_bucketed(hot.limit(0), f"{catalog}_objects.nothing", "my", buckets=2)
    read = {n: scan(spark, f"{{db_env}}_objects.{n}", catalog) for n in ("hot", "small", "nothing")}
    assert same(read["hot"], hot) and same(read["small"], hot) and read["nothing"].isEmpty()
