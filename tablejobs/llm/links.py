"""Connected components of a graph of links, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.session import scratch_dir


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def kept(df: DataFrame, label: str) -> DataFrame:
    """`df` written once to the shared scratch folder and read again: cuts the lineage, survives lost executors.

    The shuffle files of the write go when it ends; else they stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node with a link; `label` is the smallest node that can be reached.

    Each round takes the smallest label among a node's neighbours, then the label of that label. Both are joins and
    map-side reduced groupings, so a node with very many links is one row for each task. NULL ends are left out, loops
    and repeated links change nothing. The number of rounds grows with the logarithm of the longest path.
    """
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null")
    both = kept(pairs.union(pairs.select("v", "u")).distinct(), "links")
    labels = kept(both.groupBy("u").agg(F.least("u", F.min("v")).alias("label")).withColumnRenamed("u", "node"), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("near"))
        low = labels.join(near, labels.node == near.u).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("low")
        )
        ahead = labels.select(F.col("node").alias("low"), F.col("label").alias("jump"))
        found = kept(low.join(ahead, "low").select("node", "old", F.least("low", "jump").alias("label")), "labels")
        labels = found.select("node", "label")
        if found.filter("old <> label").isEmpty():
            return labels
