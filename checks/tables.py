"""Extracts, cells, reports, writes and text expressions on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.standins import REPORTS, USER_LOG, read, sql_text, stand_in
from tablejobs.functions.dates import parse_date
from tablejobs.functions.text import key_bytes, or_blank, parse_int, prefixed
from tablejobs.plans.transfer import extract, extract_then_load
from tablejobs.session import scratch_dir
from tablejobs.sources.cells import latest_cells, read_mapping, send_cells, to_cells, to_cells_mapped
from tablejobs.sources.reports import (
    accepted_and_rejected,
    case_lines,
    compact_json,
    parse_report,
    read_report_checked,
    report_cases,
    report_runs,
    report_tables,
    run_lines,
)
from tablejobs.sources.tables import read_parquet, write_hub


def _readable(cells):
    """Bytes as hex text, so that both engines show them alike."""
    return cells.withColumns({"row_key": F.hex("row_key"), "value": F.hex("value")})


def _cells_sql(key: str, source: str, addresses: dict[str, tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT hex(encode(CAST({key} AS VARCHAR))) AS row_key, '{family}' AS family, '{qualifier}' AS qualifier,
  hex(encode(CAST({column} AS VARCHAR))) AS value FROM {source} WHERE {column} IS NOT NULL"""
        for column, (family, qualifier) in addresses.items()
    )


@query("to_cells", _cells_sql("c_custkey", "customer", {c: ("cf1", c) for c in ("c_name", "c_nationkey", "c_mktsegment")}))
def cells(spark, sf):
    return _readable(to_cells(read(spark, sf, "customer"), "c_custkey", ["c_name", "c_nationkey", "c_mktsegment"]))


MAPPING = '{"o_orderstatus": "state:status", "o_orderpriority": "priority", "o_custkey": "who:customer"}'


@query(
    "to_cells_mapped",
    _cells_sql(
        "o_orderkey",
        "orders",
        {"o_orderstatus": ("state", "status"), "o_orderpriority": ("cf1", "priority"), "o_custkey": ("who", "customer")},
    ),
)
def cells_mapped(spark, sf):
    return _readable(to_cells_mapped(read(spark, sf, "orders"), read_mapping(MAPPING), "o_orderkey"))


@query(
    "cells_upsert",
    """WITH latest AS (SELECT user_id, event_type, event_id FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)
SELECT hex(encode(CAST(user_id AS VARCHAR))) AS row_key, 'cf1' AS family, q AS qualifier, hex(encode(v)) AS value
FROM (SELECT user_id, 'aHeader' AS q, event_type AS v FROM latest
      UNION ALL SELECT user_id, 'aEventId', CAST(event_id AS VARCHAR) FROM latest)""",
)
def cells_upsert(spark, sf):
    """Every event is sent to the sink, the first half of the month a second time; the latest of each user remain."""
    folder = scratch_dir(spark, "cells")
    sent = to_cells(stand_in(spark, sf, USER_LOG), "oid_instid", ["aHeader", "aEventId"], version="_timestamp")
    send_cells(sent, path=folder)
    send_cells(sent.filter("written_at < TIMESTAMP '2024-01-16 00:00:00'"), path=folder)
    return _readable(latest_cells(read_parquet(spark, folder)).drop("written_at"))


@query("extract_round_trip", "SELECT * FROM lineitem")
def extract_round_trip(spark, sf):
    folder = scratch_dir(spark, "extract")
    extract(spark, "parquet", "lineitem", folder, path=f"{sf}/lineitem.parquet")
    return read_parquet(spark, folder)


@query(
    "extract_then_load",
    _cells_sql("s_suppkey", "supplier", {"s_name": ("cf1", "s_name"), "s_nationkey": ("cf1", "s_nationkey")}),
)
def extract_and_load(spark, sf):
    target, store = scratch_dir(spark, "extract"), scratch_dir(spark, "store")
    extract_then_load(
        spark,
        "parquet",
        "supplier",
        target,
        "s_suppkey",
        ["s_name", "s_nationkey"],
        connector={"path": f"{sf}/supplier.parquet"},
        path=store,
    )
    return _readable(latest_cells(read_parquet(spark, store)).drop("written_at"))


@query(
    "hub_write",
    """SELECT o_orderkey, o_totalprice, 'PIMS' AS source_system_cd, strftime(o_orderdate, '%Y%m') AS active_ym,
  CASE WHEN strftime(o_orderdate, '%Y%m') >= '199901' THEN 2 ELSE 1 END AS load_no FROM orders""",
)
def hub_write(spark, sf):
    """All months are written, then the months from 1999 again; the earlier ones stay."""
    folder = scratch_dir(spark, "hub")
    rows = read(spark, sf, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.lit("PIMS").alias("source_system_cd"),
        F.date_format("o_orderdate", "yyyyMM").alias("active_ym"),
    )
    write_hub(rows.withColumn("load_no", F.lit(1)), path=folder)
    write_hub(rows.filter("active_ym >= '199901'").withColumn("load_no", F.lit(2)), path=folder)
    schema = "o_orderkey bigint, o_totalprice double, load_no int, source_system_cd string, active_ym string"
    return spark.read.schema(schema).parquet(folder)


# --- reports -------------------------------------------------------------------------------------

RESULT_SQL = "CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'PASS' END"
ERROR_SQL = "CASE WHEN event_type = 'error' THEN 'bad input' ELSE 'null' END"


@query(
    "report_cases",
    f"""SELECT event_id, 'TC_' || event_id AS case_id, event_type AS description, {RESULT_SQL} AS result, {ERROR_SQL} AS error,
  '* Test Case ID:* TC_' || event_id || chr(10) || '- **Description:** ' || event_type || chr(10)
  || '- **Result:** ' || {RESULT_SQL} || chr(10) || '- **Error:** ' || {ERROR_SQL} || chr(10) AS line FROM events""",
)
def reports_cases(spark, sf):
    return case_lines(report_cases(parse_report(stand_in(spark, sf, REPORTS), "report")))


@query(
    "report_runs",
    """SELECT event_id, 'user_' || user_id || '.txt' AS file_name, 'run-' || event_id AS run_id, 'Succeeded' AS status,
  '' AS message, event_id % 100 + 0.5::DOUBLE AS duration_min,
  '- **File Name:** user_' || user_id || '.txt' || chr(10) || '- **Run ID:** run-' || event_id || chr(10)
  || '- **Status:** Succeeded' || chr(10) || '- **Message:** ' || chr(10) || '- **Duration (min):** '
  || (event_id % 100) || '.5' || chr(10) AS line FROM events""",
)
def reports_runs(spark, sf):
    return run_lines(report_runs(parse_report(stand_in(spark, sf, REPORTS), "report")))


@query(
    "report_json",
    f"""SELECT event_id, replace(replace(report, ': ', ':'), ', ', ',') AS report FROM ({sql_text(REPORTS)})""",
)
def reports_json(spark, sf):
    return compact_json(parse_report(stand_in(spark, sf, REPORTS), "report"))


# Reports of which some are cut off or missing.
MIXED_SQL = f"""SELECT event_id, CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 7 = 0 THEN substr(report, 1, 40)
  ELSE report END AS report FROM ({sql_text(REPORTS)})"""


def mixed_reports(spark, sf):
    text = "CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 7 = 0 THEN substr(report, 1, 40) ELSE report END"
    return stand_in(spark, sf, REPORTS).withColumn("report", F.expr(text))


@query(
    "report_rejects",
    f"""SELECT event_id, coalesce(report, '') AS rejected, NULL AS case_id FROM ({MIXED_SQL})
WHERE event_id % 13 = 0 OR event_id % 7 = 0
UNION ALL SELECT event_id, NULL, 'TC_' || event_id FROM events WHERE event_id % 13 <> 0 AND event_id % 7 <> 0""",
)
def report_rejects(spark, sf):
    """Every report is a test case or a reject."""
    good, bad = accepted_and_rejected(parse_report(mixed_reports(spark, sf), "report"))
    cases = report_cases(good).select("event_id", "case_id")
    return bad.unionByName(cases, allowMissingColumns=True)


@query(
    "report_files",
    f"""SELECT 'rejected' AS kind, report AS name, NULL AS result FROM ({MIXED_SQL}) WHERE event_id % 13 <> 0 AND event_id % 7 = 0
UNION ALL SELECT 'case', 'TC_' || event_id, {RESULT_SQL} FROM events WHERE event_id % 13 <> 0 AND event_id % 7 <> 0
UNION ALL SELECT 'run', 'user_' || user_id || '.txt', 'Succeeded' FROM events WHERE event_id % 13 <> 0 AND event_id % 7 <> 0""",
)
def report_files(spark, sf):
    """Reports written as lines of files and read again, rejects apart."""
    path = scratch_dir(spark, "report-files")
    mixed_reports(spark, sf).filter("report IS NOT NULL").select("report").write.text(path)
    good, bad = read_report_checked(spark, path, lines=True)
    cases, runs = report_tables(good)
    kind = lambda name: F.lit(name).alias("kind")
    return (
        bad.select(kind("rejected"), F.col("rejected").alias("name"), F.lit(None).cast("string").alias("result"))
        .union(cases.select(kind("case"), "case_id", "result"))
        .union(runs.select(kind("run"), "file_name", "status"))
    )


@query(
    "event_properties",
    """SELECT event_id, key, CAST(json_extract_string(props, '$.' || key) AS BIGINT) AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)""",
)
def event_properties(spark, sf):
    """Entries of each event's JSON object."""
    parsed = read(spark, sf, "events").select("event_id", F.from_json("props", "map<string, bigint>").alias("entries"))
    return parsed.select("event_id", F.explode("entries").alias("key", "value"))


# --- text expressions ----------------------------------------------------------------------------


@query(
    "text_expressions",
    """WITH t AS (SELECT p_partkey, CASE WHEN p_size > 40 THEN 'x' || p_size ELSE CAST(p_size AS VARCHAR) END AS code,
  CASE WHEN p_size > 45 THEN NULL ELSE p_name END AS name FROM part)
SELECT p_partkey, coalesce(name, '') AS name_or_blank, concat_ws('', 'Part - ', name) AS titled,
  TRY_CAST(code AS INT) AS number, TRY_CAST('20' || lpad(code, 2, '0') || '-01-01' AS DATE) AS day,
  hex(encode(CAST(p_partkey AS VARCHAR))) AS key_hex, CAST(length(CAST(p_partkey AS VARCHAR)) AS INTEGER) AS key_length FROM t""",
)
def text_expressions(spark, sf):
    parts = read(spark, sf, "part").select(
        "p_partkey",
        F.expr("CASE WHEN p_size > 40 THEN concat('x', p_size) ELSE CAST(p_size AS STRING) END").alias("code"),
        F.expr("CASE WHEN p_size > 45 THEN NULL ELSE p_name END").alias("name"),
    )
    return parts.select(
        "p_partkey",
        or_blank(F.col("name")).alias("name_or_blank"),
        prefixed("Part - ", F.col("name")).alias("titled"),
        parse_int(F.col("code")).alias("number"),
        parse_date(F.concat(F.lit("20"), F.lpad("code", 2, "0"), F.lit("-01-01"))).alias("day"),
        F.hex(key_bytes(F.col("p_partkey"))).alias("key_hex"),
        F.length(F.col("p_partkey").cast("string")).alias("key_length"),
    )
