"""What all hub tables share: target layout, audit columns, uniqueness, and the description of a job."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from inspect import signature

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.functions.dates import DateLike, as_date
from tablejobs.functions.text import row_hash
from tablejobs.session import written
from tablejobs.sources.snapshots import OBJECT_ID, VERSION, TableSpec, load_snapshots
from tablejobs.sources.tables import qualify, write_hub

# Source code, partition columns and audit columns of the hub tables.
SOURCE_SYSTEM = "PIMS"
PARTITIONS = ("source_system_cd", "active_ym")
AUDIT_TYPES = {
    "record_version_no": "bigint",
    "rec_sha": "string",
    "active_dt": "date",
    "active_ym": "string",
    "load_dt": "date",
    "source_system_cd": "string",
}
VERSION_COUNT = "record_version_no"
ROWS = "__rows__"


def conform(df: DataFrame, target: Mapping[str, str], misfits: Observation | None = None) -> DataFrame:
    """The target's columns in its order and types. Values that do not fit a type become NULL.

    `misfits` observes, by column, how many values did not fit, in the job that computes the rows; columns that have their
    type already are not observed.
    """
    missing = [c for c in target if c not in df.columns]
    if missing:
        raise ValueError(f"missing target columns: {', '.join(missing)}")
    fitted = {c: F.col(c).try_cast(t).alias(c) for c, t in target.items()}
    if misfits is not None:
        cast = [c for c, t in target.items() if df.schema[c].dataType != T._parse_datatype_string(t)]
        lost = [F.count_if(F.col(c).isNotNull() & fitted[c].isNull()).alias(c) for c in cast]
        df = df.observe(misfits, F.count(F.lit(1)).alias(ROWS), *lost)
    return df.select(*fitted.values())


def version_counts(log: DataFrame, keys: Sequence[str] = OBJECT_ID) -> DataFrame:
    """Number of versions of each key, which is the version number of its latest row."""
    return log.groupBy(*keys).agg(F.count(F.lit(1)).alias(VERSION_COUNT))


def with_audit(
    df: DataFrame,
    hashed: Sequence[str],
    active_field: str = VERSION,
    load_dt: DateLike = None,
    source_system: str = SOURCE_SYSTEM,
) -> DataFrame:
    """Adds the audit columns; the definitions are this library's own.

    `rec_sha` is a hash of the business columns, `active_dt` the day of the row's version, `active_ym`
    its month. `record_version_no` is taken from the input where it has one.
    """
    active = F.to_date(active_field)
    audited = df.withColumns(
        {
            "rec_sha": row_hash(list(hashed)),
            "active_dt": active,
            "active_ym": F.date_format(active, "yyyyMM"),
            "load_dt": as_date(load_dt),
            "source_system_cd": F.lit(source_system),
        }
    )
    if VERSION_COUNT not in df.columns:
        audited = audited.withColumn(VERSION_COUNT, F.lit(None).cast("bigint"))
    return audited


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows. Empty for a table of that granularity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


Transform = Callable[..., DataFrame]


@dataclass(frozen=True)
class HubJob:
    """A hub table: its input specs, the transform over their snapshots, and its layout.

    The transform takes the snapshots by table name. With `versioned`, the name of an input, that snapshot also has the
    number of versions of each key, as `record_version_no`.
    """

    name: str
    tables: Sequence[TableSpec]
    transform: Transform
    target: Mapping[str, str]
    target_table: str
    granularity: Sequence[str] = ()
    partitions: Sequence[str] = ()
    dedup: str = "row_number"
    versioned: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_config(
        cls, name: str, config: Mapping[str, str], tables: Iterable[TableSpec], transform: Transform, types: Mapping[str, str]
    ) -> HubJob:
        """A job from one block of a configuration file: `target_db`, `target_tbl`, `TARGET`, `granularity_keys`, `partitions`.

        `TARGET`, the keys and the partition columns are comma-separated lists; `types` gives the types, text where it has
        none.
        """

        def listed(key: str) -> tuple[str, ...]:
            return tuple(k.strip() for k in config.get(key, "").split(",") if k.strip())

        columns = [c.strip() for c in config["TARGET"].split(",")]
        return cls(
            name,
            tuple(tables),
            transform,
            {c: types.get(c, "string") for c in columns},
            f"{config['target_db']}.{config['target_tbl']}",
            listed("granularity_keys"),
            listed("partitions"),
            options=dict(config),
        )

    def located(self, databases: Mapping[str, str], target_table: str | None = None) -> HubJob:
        """The job over a site's own databases (by the neutral names) and target table."""

        def moved(name: str) -> str:
            database, _, table = name.rpartition(".")
            return f"{databases.get(database, database)}.{table}"

        tables = tuple(replace(t, name=moved(t.name)) for t in self.tables)
        return replace(self, tables=tables, target_table=target_table or moved(self.target_table))

    def build(
        self,
        spark: SparkSession,
        env: str | None = None,
        read: Callable[[str], DataFrame] | None = None,
        load_dt: DateLike = None,
        misfits: Observation | None = None,
    ) -> DataFrame:
        """The hub table's rows, in its layout, as loaded on `load_dt` (today without it); `misfits` as in `conform`."""
        counted = {self.versioned: VERSION_COUNT} if self.versioned else None
        inputs = load_snapshots(spark, self.tables, env, self.dedup, read, counted)
        dated = {"load_dt": load_dt} if "load_dt" in signature(self.transform).parameters else {}
        return conform(self.transform(inputs, **dated), self.target, misfits)

    def write(self, df: DataFrame, env: str | None = None, path: str | None = None) -> None:
        """Writes the rows after a check of the job's granularity: keys found twice are an error.

        The rows are computed once, into the scratch folder. The check and the write read them there, so what is written is
        what was checked, also if a source changes meanwhile, and nothing is replaced before the check has passed.
        """
        self._replace(written(df, self.name) if self.granularity else df, env, path)

    def _replace(self, df: DataFrame, env: str | None, path: str | None) -> None:
        if self.granularity:
            twice = duplicate_keys(df, self.granularity).count()
            if twice:
                raise ValueError(f"{self.name}: {twice} keys of ({', '.join(self.granularity)}) occur more than once")
        write_hub(df, None if path else qualify(self.target_table, env), path, self.partitions)

    def run(
        self,
        spark: SparkSession,
        env: str | None = None,
        read: Callable[[str], DataFrame] | None = None,
        load_dt: DateLike = None,
        path: str | None = None,
        strict: bool = False,
    ) -> dict[str, int]:
        """Builds and writes the table; returns the number of rows (`rows`) and of values that did not fit, by column.

        With `strict`, values that did not fit are an error and nothing is replaced.
        """
        misfits = Observation(f"{self.name} misfits")
        made = written(self.build(spark, env, read, load_dt, misfits), self.name)
        found = {c: n for c, n in misfits.get.items() if n or c == ROWS}
        if strict and len(found) > 1:
            raise ValueError(f"{self.name}: values do not fit their columns: {found}")
        self._replace(made, env, path)
        return {ROWS.strip("_"): found.pop(ROWS), **found}
