"""Run reports: JSON with one object per test case and one per run, flattened to rows and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablejobs.session import written

PARTS = ("test_case_report", "adf_run_details")
# Layout of a report, and the lines of its text form.
REPORT_SCHEMA = (
    "test_case_report map<string, struct<description: string, result: string, error: string>>, "
    "adf_run_details map<string, struct<id: string, run_status: string, message: string, run_duration: double>>"
)
CORRUPT = "_corrupt_record"
CASE_LINES = "* Test Case ID:* %s\n- **Description:** %s\n- **Result:** %s\n- **Error:** %s\n"
RUN_LINES = (
    "- **File Name:** %s\n- **Run ID:** %s\n- **Status:** %s\n- **Message:** %s\n- **Duration (min):** %s\n"
)


def read_report(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Reports from JSON files that hold one report each, over several lines, or with `lines` one on each line.

    What does not parse keeps its text in `_corrupt_record`, see `accepted_and_rejected`.
    """
    return spark.read.schema(f"{REPORT_SCHEMA}, {CORRUPT} string").option("multiLine", not lines).json(path)


def parse_report(df: DataFrame, column: str) -> DataFrame:
    """Reports from a text column; the other columns are kept. NULL and blank texts count as reports that do not parse."""
    rest = [c for c in df.columns if c != column]
    parsed = F.from_json(column, f"{REPORT_SCHEMA}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT})
    reports = df.select(*rest, parsed.alias("__report"), F.coalesce(column, F.lit("")).alias("__text"))
    blank = F.col("__report").isNull() | (F.trim("__text") == "")
    return reports.withColumn("__none", F.when(blank, F.col("__text"))).select(
        *rest, *[F.col(f"__report.{p}").alias(p) for p in PARTS], F.coalesce("__none", f"__report.{CORRUPT}").alias(CORRUPT)
    )


def accepted_and_rejected(reports: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The reports that parse, and the others: their further columns and the text as `rejected`.

    Each input row is in one of the two.
    """
    rest = [c for c in reports.columns if c not in (*PARTS, CORRUPT)]
    good = reports.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, reports.filter(F.col(CORRUPT).isNotNull()).select(*rest, F.col(CORRUPT).alias("rejected"))


def read_report_checked(spark: SparkSession, path: str, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """`accepted_and_rejected` of report files, parsed once into the scratch folder."""
    return accepted_and_rejected(written(read_report(spark, path, lines), "reports"))


def _entries(df: DataFrame, column: str) -> DataFrame:
    # The outer form keeps Spark from parsing the JSON once more to test for empty maps.
    rest = [c for c in df.columns if c not in (*PARTS, CORRUPT)]
    return df.select(*rest, F.explode_outer(column).alias("__key", "__value")).filter(
        F.col("__key").isNotNull()
    )


def _rest(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("__")]


def report_cases(reports: DataFrame, null_text: str | None = None) -> DataFrame:
    """One row per test case. `null_text` is a text that stands for a missing error; by default it is kept."""
    entries = _entries(reports, "test_case_report")
    error = F.col("__value.error")
    return entries.select(
        *_rest(entries),
        F.col("__key").alias("case_id"),
        F.col("__value.description").alias("description"),
        F.col("__value.result").alias("result"),
        (F.nullif(error, F.lit(null_text)) if null_text is not None else error).alias("error"),
    )


def report_runs(reports: DataFrame) -> DataFrame:
    """One row per run."""
    entries = _entries(reports, "adf_run_details")
    return entries.select(
        *_rest(entries),
        F.col("__key").alias("file_name"),
        F.col("__value.id").alias("run_id"),
        F.col("__value.run_status").alias("status"),
        F.col("__value.message").alias("message"),
        F.col("__value.run_duration").alias("duration_min"),
    )


def report_tables(reports: DataFrame) -> tuple[DataFrame, DataFrame]:
    return report_cases(reports), report_runs(reports)


def _lines(template: str, columns: tuple[str, ...]) -> Column:
    # A missing value is written as the word null.
    return F.format_string(template, *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])


def case_lines(cases: DataFrame) -> DataFrame:
    return cases.withColumn("line", _lines(CASE_LINES, ("case_id", "description", "result", "error")))


def run_lines(runs: DataFrame) -> DataFrame:
    return runs.withColumn("line", _lines(RUN_LINES, ("file_name", "run_id", "status", "message", "duration_min")))


def compact_json(reports: DataFrame, name: str = "report") -> DataFrame:
    """Each report as JSON text on one line."""
    rest = [c for c in reports.columns if c not in (*PARTS, CORRUPT)]
    return reports.select(*rest, F.to_json(F.struct(*PARTS), {"ignoreNullFields": "false"}).alias(name))
