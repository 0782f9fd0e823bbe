"""Warehouse to Parquet to cells."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tablejobs.sources.cells import FAMILY, send_cells, to_cells, to_cells_mapped
from tablejobs.sources.tables import read_parquet, read_table, write_parquet


def extract(spark: SparkSession, fmt: str, table: str, folder: str, **options: str) -> None:
    """A warehouse table to a Parquet folder, replacing what is there. `options` go to the connector."""
    write_parquet(read_table(spark, fmt, table, **options), folder)


def load_cells(
    df: DataFrame,
    key: str,
    columns: Sequence[str] | Mapping[str, str],
    family: str = FAMILY,
    version: str | None = None,
    **sink: str,
) -> None:
    """Rows to a cell store. `columns` is a list, or a mapping of columns to addresses; `sink` goes to the client."""
    if isinstance(columns, Mapping):
        cells = to_cells_mapped(df, columns, key, version)
    else:
        cells = to_cells(df, key, columns, family, version)
    send_cells(cells, **sink)


def extract_then_load(
    spark: SparkSession,
    fmt: str,
    table: str,
    folder: str,
    key: str,
    columns: Sequence[str] | Mapping[str, str],
    connector: Mapping[str, str] | None = None,
    **sink: str,
) -> None:
    """Both steps; the load starts from the finished Parquet folder, so it can be repeated alone."""
    extract(spark, fmt, table, folder, **(connector or {}))
    load_cells(read_parquet(spark, folder), key, columns, **sink)
