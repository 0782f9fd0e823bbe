"""Cells: a table as (row_key, family, qualifier, value), and a sink that hands them to a store's client."""

from __future__ import annotations

import importlib
import json
import os
import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any, Protocol

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tablejobs.functions.text import key_bytes
from tablejobs.operators.windows import latest_per_key

# Fixed value: the column family used where none is named.
FAMILY = "cf1"
CELL = ("row_key", "family", "qualifier")
VERSION = "written_at"

# Size in memory of the cells that one file of a FolderClient holds.
FILE_BYTES = 128 * 1024 * 1024


def to_cells(
    df: DataFrame, key: str, columns: Sequence[str], family: str = FAMILY, version: str | None = None
) -> DataFrame:
    """One cell per row and column: the key's text as bytes, the column's name, the value's text as bytes.

    NULL values make no cell; a NULL key is an error. `version` names a timestamp that is kept as
    `written_at` and decides between cells of the same address.
    """
    return to_cells_mapped(df, {c: f"{family}:{c}" for c in columns}, key, version)


def to_cells_mapped(
    df: DataFrame, mapping: Mapping[str, str], row_key: str, version: str | None = None
) -> DataFrame:
    """As `to_cells`, with `{column: "family:qualifier"}` or `{column: "qualifier"}`."""
    addressed = {c: a if ":" in a else f"{FAMILY}:{a}" for c, a in mapping.items()}
    kept = [VERSION] if version else []
    wide = df.select(
        F.when(F.col(row_key).isNull(), F.raise_error(F.lit(f"{row_key} is NULL, so the row has no key")))
        .otherwise(key_bytes(F.col(row_key)))
        .alias("row_key"),
        *([F.col(version).alias(VERSION)] if version else []),
        *[F.col(c).cast("string").alias(a) for c, a in addressed.items()],
    )
    address = F.split("__address", ":", 2)
    return (
        wide.unpivot(["row_key", *kept], [F.col(f"`{a}`") for a in addressed.values()], "__address", "__text")
        .filter(F.col("__text").isNotNull())
        .select(
            "row_key",
            address[0].alias("family"),
            address[1].alias("qualifier"),
            F.encode("__text", "UTF-8").alias("value"),
            *kept,
        )
    )


def read_mapping(text: str) -> dict[str, str]:
    """A mapping from JSON: one object, column to address."""
    mapping = json.loads(text)
    if not isinstance(mapping, dict) or not all(isinstance(v, str) for v in mapping.values()):
        raise ValueError("a mapping is one JSON object of texts")
    return mapping


def latest_cells(cells: DataFrame) -> DataFrame:
    """The newest value at each address; of two written at the same time the greater value."""
    return latest_per_key(cells, CELL, (f"{VERSION} desc",), tiebreak=("value desc",))


# --- sink ----------------------------------------------------------------------------------------


class CellClient(Protocol):
    """A connection to a store. One is opened per partition, on the executor that writes it.

    Writing a batch twice must have the same outcome as writing it once: Spark repeats the batches of
    a task that failed or whose executor was lost.
    """

    def write(self, batch: pa.RecordBatch) -> None: ...

    def close(self) -> None: ...


class FolderClient:
    """Client that keeps cells as Parquet files in the shared folder `path`, a URI.

    Batches are gathered to files of FILE_BYTES, so a partition makes few files. Files stay hidden from Spark's readers until
    the job commits them, and go with a task or job that fails.
    """

    def __init__(self, options: Mapping[str, str]):
        self.files, self.folder = fs.FileSystem.from_uri(options["path"])
        self.files.create_dir(self.folder, recursive=True)
        self.waiting: list[pa.RecordBatch] = []
        self.size = 0
        self.names: list[str] = []

    def write(self, batch: pa.RecordBatch) -> None:
        self.waiting.append(batch)
        self.size += batch.nbytes
        if self.size >= FILE_BYTES:
            self._flush()

    def close(self) -> None:
        if self.waiting:
            self._flush()

    def _flush(self) -> None:
        name = f"{uuid.uuid4().hex}.parquet"
        self.names.append(name)
        pq.write_table(pa.Table.from_batches(self.waiting), f"{self.folder}/_{name}", filesystem=self.files)
        self.waiting, self.size = [], 0

    def publish(self, names: Sequence[str]) -> None:
        for name in names:
            self.files.move(f"{self.folder}/_{name}", f"{self.folder}/cells-{name}")

    def discard(self, names: Sequence[str]) -> None:
        for name in names:
            if self.files.get_file_info(f"{self.folder}/_{name}").type != fs.FileType.NotFound:
                self.files.delete_file(f"{self.folder}/_{name}")


def _open_client(options: Mapping[str, str]) -> CellClient:
    target = options.get("client")
    if not target:
        return FolderClient(options)
    module, _, factory = target.partition(":")
    return getattr(importlib.import_module(module), factory)(options)


@dataclass
class Written(WriterCommitMessage):
    cells: int
    files: tuple[str, ...] = ()


class CellWriter(DataSourceArrowWriter):
    def __init__(self, options: Mapping[str, str]):
        self.options = dict(options)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        """One client takes the partition. A task that fails writes nothing more and takes its files back."""
        client = _open_client(self.options)
        count = 0
        try:
            for batch in iterator:
                if batch.num_rows:
                    client.write(batch)
                    count += batch.num_rows
            client.close()
        except BaseException:
            if isinstance(client, FolderClient):
                client.discard(client.names)
            raise
        return Written(count, tuple(getattr(client, "names", ())))

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Files of the tasks that count get their names; those of repeated tasks stay hidden."""
        self._settle(messages, FolderClient.publish)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._settle(messages, FolderClient.discard)

    def _settle(self, messages: list[WriterCommitMessage | None], what) -> None:
        if not self.options.get("client"):
            names = [name for m in messages if m is not None for name in m.files]
            what(FolderClient(self.options), names)


class CellSource(DataSource):
    """`df.write.format("cells")`: Arrow batches of cells to a client.

    Option `client` is `module:factory`, called with the options on each executor; without it the
    cells go to the folder named by option `path`.
    """

    @classmethod
    def name(cls) -> str:
        return "cells"

    def schema(self) -> str:
        return f"row_key binary, family string, qualifier string, value binary, {VERSION} timestamp"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("cells are upserted; use mode('append')")
        return CellWriter({k: v for k, v in self.options.items()})


def shared_uri(spark: SparkSession, path: str) -> str:
    """The path with its file system: its own, or else the one that the session's warehouse is in."""
    if re.match("[A-Za-z][A-Za-z0-9+.-]*:", path):
        return re.sub("^file:/*", "file:///", path)
    base = spark.conf.get("spark.sql.warehouse.dir")
    scheme = re.match("([A-Za-z][A-Za-z0-9+.-]*)://([^/]*)", base)
    prefix = f"{scheme[1]}://{scheme[2]}" if scheme else "file://"
    return f"{prefix}{os.path.abspath(path) if prefix == 'file://' else path}"


def register_cells(spark: SparkSession) -> None:
    """Makes the format known to the session; executors need not have this package installed."""
    cloudpickle.register_pickle_by_value(importlib.import_module(__name__))
    spark.dataSource.register(CellSource)


def send_cells(cells: DataFrame, **options: Any) -> None:
    """Writes cells through the sink. Cells without a version are written as of now."""
    register_cells(cells.sparkSession)
    if VERSION not in cells.columns:
        cells = cells.withColumn(VERSION, F.current_timestamp())
    if "path" in options:
        options["path"] = shared_uri(cells.sparkSession, str(options["path"]))
    complete = cells.select(*CELL, "value", F.col(VERSION).cast("timestamp").alias(VERSION))
    complete.write.format("cells").options(**options).mode("append").save()
