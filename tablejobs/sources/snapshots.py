"""Snapshots of change-log tables: latest row per key, deleted keys removed, declared columns kept."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablejobs.operators.windows import latest_and_count, latest_per_key
from tablejobs.sources.tables import qualify, scan, short_name

# Names of the change-log columns and the code of a deleted row.
VERSION = "_timestamp"
OPERATION = "_operation"
OBJECT_ID = ("oid_clsno", "oid_instid")
NOT_DELETED = "_operation <> 'D'"


def columns_of(text: str) -> tuple[str, ...]:
    return tuple(c.strip() for c in text.split(",") if c.strip())


@dataclass(frozen=True)
class TableSpec:
    """How one change-log table becomes a snapshot. Without `keys` the rows are only filtered.

    `carried` are the columns that a job needs of a snapshot that counts versions, where they are not all of `columns`.
    """

    name: str
    columns: tuple[str, ...]
    keys: tuple[str, ...] = OBJECT_ID
    order: tuple[str, ...] = (f"{VERSION} desc",)
    condition: str | None = NOT_DELETED
    active_field: str | None = VERSION
    carried: tuple[str, ...] | None = None


def log_table(
    name: str,
    attributes: str = "",
    references: str = "",
    database: str = "{db_env}_claims",
    keys: tuple[str, ...] = OBJECT_ID,
    condition: str | None = NOT_DELETED,
    with_operation: bool = True,
) -> TableSpec:
    """Spec of a change-log table from its attributes and the names of the objects it refers to.

    A reference `X` stands for the columns `myX_clsno` and `myX_instid`.
    """
    columns = [VERSION, *OBJECT_ID]
    if with_operation:
        columns.append(OPERATION)
    columns += attributes.split()
    for reference in references.split():
        columns += [f"my{reference}_clsno", f"my{reference}_instid"]
    if not set(keys) & set(OBJECT_ID):
        columns = [c for c in columns if c not in OBJECT_ID]
    return TableSpec(f"{database}.{name}", tuple(columns), keys, condition=condition)


def read_specs(text: str) -> list[TableSpec]:
    """Specs from JSON: `{table: {part_fields, rnk_fields, sel_fields, filter_con, active_field}}`.

    Field lists are comma-separated text. A table without `part_fields` keeps all its versions.
    """
    specs = []
    for name, entry in json.loads(text).items():
        specs.append(
            TableSpec(
                name,
                columns_of(entry["sel_fields"]),
                columns_of(entry.get("part_fields", "")),
                columns_of(entry.get("rnk_fields", f"{VERSION} desc")),
                entry.get("filter_con"),
                entry.get("active_field"),
            )
        )
    return specs


def snapshot(log: DataFrame, spec: TableSpec, dedup: str = "row_number", count_as: str | None = None) -> DataFrame:
    """Rank first, filter second, project last.

    `count_as` names a further column with the number of versions of the row's key, which is found together with the latest
    row in one grouping of one scan; it needs keys and `row_number`.

    Filtering deleted rows before the ranking would bring back the version before the deletion, and
    the condition may use columns that are not among the declared ones. It is therefore evaluated to a
    flag up front, so that only declared columns, keys and order reach the ranking and its shuffle.
    """
    needed = dict.fromkeys([*spec.columns, *spec.keys, *(o.split()[0] for o in spec.order)])
    keep = F.expr(spec.condition) if spec.condition else F.lit(True)
    narrow = log.select(*needed, keep.alias("__keep"))
    if count_as is not None:
        if dedup != "row_number" or not spec.keys:
            raise ValueError(f"versions of {spec.name} can be counted only where one of each key is kept")
        kept = spec.columns if spec.carried is None else spec.carried
        latest = latest_and_count(narrow, spec.keys, spec.order, count_as, [*kept, "__keep"])
        return latest.filter("__keep").select(*kept, count_as)
    latest = latest_per_key(narrow, spec.keys, spec.order, mode=dedup if spec.keys else "none")
    return latest.filter("__keep").select(*spec.columns)


def load_snapshots(
    spark: SparkSession,
    specs: Iterable[TableSpec],
    env: str | None = None,
    dedup: str = "row_number",
    read: Callable[[str], DataFrame] | None = None,
    counted: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Snapshot of every spec, under its table name without the database.

    `read` maps a full table name to a DataFrame; the default is the session's catalog. `counted` names, for some of the
    tables, a column that counts the versions of each key.
    """
    read, counted = read or (lambda name: scan(spark, name)), counted or {}
    return {short_name(s.name): snapshot(read(qualify(s.name, env)), s, dedup, counted.get(short_name(s.name))) for s in specs}


def reader_of(tables: Mapping[str, DataFrame]) -> Callable[[str], DataFrame]:
    """A `read` function over DataFrames at hand, looked up by table name without the database."""

    def read(name: str) -> DataFrame:
        if short_name(name) not in tables:
            raise ValueError(f"missing input tables: {short_name(name)}")
        return tables[short_name(name)]

    return read
