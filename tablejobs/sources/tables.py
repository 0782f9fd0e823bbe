"""Catalog tables, connector tables and Parquet folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def qualify(name: str, env: str | None = None) -> str:
    """Fills the `{db_env}` of a templated table name."""
    if "{db_env}" in name:
        if env is None:
            raise ValueError(f"{name} needs an environment")
        return name.replace("{db_env}", env)
    return name


def short_name(name: str) -> str:
    """Table name without its database."""
    return name.rsplit(".", 1)[-1]


def scan(spark: SparkSession, name: str, env: str | None = None) -> DataFrame:
    return spark.table(qualify(name, env))


def read_table(spark: SparkSession, fmt: str, table: str, **options: str) -> DataFrame:
    """A table of an external warehouse, read by the connector `fmt` through its `table` option."""
    return spark.read.format(fmt).options(**options).option("table", table).load()


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_hub(
    df: DataFrame,
    table: str | None = None,
    path: str | None = None,
    partitions: Sequence[str] = ("source_system_cd", "active_ym"),
) -> None:
    """Replaces the partitions that occur in `df` and leaves all others as they are.

    Rows are rebalanced by partition before the write, which splits a partition with very many rows
    over several tasks and files, and keeps the small ones in one file each.
    """
    if (table is None) == (path is None):
        raise ValueError("give either a table or a path")
    spark = df.sparkSession
    balanced = df.hint("rebalance", *[F.col(p) for p in partitions]) if partitions else df
    writer = balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if path is not None:
        writer.partitionBy(*partitions).parquet(path)
    elif spark.catalog.tableExists(table):
        order = spark.table(table).columns
        balanced.select(*order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(table)
    else:
        writer.partitionBy(*partitions).format("parquet").saveAsTable(table)


def write_bucketed(
    df: DataFrame,
    table: str,
    ref: str,
    buckets: int | None = None,
    uneven: float = 4.0,
    task_rows: int = 1_000_000,
) -> bool:
    """Writes a new catalog table in buckets of the object reference `ref`, so that joins on it move no row.

    Tables of one number of buckets (by default that of the session's shuffle partitions) are joined bucket by bucket.
    One task reads a bucket, and nothing splits it later. So rows are counted by bucket first: if one would hold more than
    `uneven` times its even share and more than `task_rows`, the table is written without buckets, and its joins are shuffled,
    where adaptive execution splits hot keys. Returns whether there are buckets. NULL references share one.
    """
    halves = [f"{ref}_clsno", f"{ref}_instid"]
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = df.groupBy(F.pmod(F.hash(*halves), F.lit(n)).alias("bucket")).count()
    largest, total = sizes.agg(F.coalesce(F.max("count"), F.lit(0)), F.coalesce(F.sum("count"), F.lit(0))).first()
    if largest > max(uneven * total / n, task_rows):
        df.write.format("parquet").saveAsTable(table)
        return False
    # The partition of a row is its bucket: one file for each.
    dealt = df.repartition(n, *halves)
    dealt.write.format("parquet").bucketBy(n, *halves).sortBy(*halves).saveAsTable(table)
    return True
