"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Timestamps are cut to dates in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Joins on skewed references are split at run time, small partitions are merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with SETTINGS; `extra` holds further settings with dots written as `__`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder that `spark.checkpoint.dir` names.

    Without that setting scratch lies below the warehouse folder. On a cluster this must be a folder of a store; one of the
    driver's disk is an error, since executors share no local one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        on_disk = urlparse(warehouse).scheme in ("", "file")
        if on_disk and not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"{warehouse.rstrip('/')}/scratch"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` written once to the scratch folder and read again: what follows is planned on a table, not on its making."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
