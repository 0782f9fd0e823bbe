from tests.helpers import rows

from tablejobs.sources.reports import (
    accepted_and_rejected,
    case_lines,
    compact_json,
    parse_report,
    read_report,
    read_report_checked,
    report_cases,
    report_tables,
    run_lines,
)

REPORT = """{
  "test_case_report": {
    "TC_1": {"description": "several parts", "result": "PASS", "error": "null"},
    "TC_2": {"description": "empty file", "result": "FAIL"}
  },
  "adf_run_details": {
    "part_05.txt": {"id": "45b5", "run_status": "Succeeded", "message": "", "run_duration": 18.438933333333335}
  }
}"""


def test_report_from_file(spark, tmp_path):
    (tmp_path / "report.json").write_text(REPORT)
    cases, runs = report_tables(read_report(spark, str(tmp_path)))
    assert rows(cases) == [("TC_1", "several parts", "PASS", "null"), ("TC_2", "empty file", "FAIL", None)]
    assert rows(runs) == [("part_05.txt", "45b5", "Succeeded", "", 18.438933333333335)]


def test_report_from_text_column(spark):
    texts = spark.createDataFrame([(1, REPORT), (2, "{}"), (3, "no json")], "n int, report string")
    reports = parse_report(texts, "report")
    cases, runs = report_tables(reports)
    assert cases.columns == ["n", "case_id", "description", "result", "error"]
    assert {r.n for r in cases.collect()} == {r.n for r in runs.collect()} == {1}
    assert report_cases(reports, null_text="null").filter("error IS NOT NULL").isEmpty()


def test_lines(spark):
    cases, runs = report_tables(parse_report(spark.createDataFrame([(REPORT,)], "report string"), "report"))
    assert [r.line for r in case_lines(cases).orderBy("case_id").collect()] == [
        "* Test Case ID:* TC_1\n- **Description:** several parts\n- **Result:** PASS\n- **Error:** null\n",
        "* Test Case ID:* TC_2\n- **Description:** empty file\n- **Result:** FAIL\n- **Error:** null\n",
    ]
    assert run_lines(runs).first().line == (
        "- **File Name:** part_05.txt\n- **Run ID:** 45b5\n- **Status:** Succeeded\n- **Message:** \n"
        "- **Duration (min):** 18.438933333333335\n"
    )


def test_compact_json_is_one_line(spark):
    reports = parse_report(spark.createDataFrame([(REPORT,)], "report string"), "report")
    text = compact_json(reports).first().report
    assert "\n" not in text and '"result":"PASS","error":"null"' in text
    assert rows(parse_report(compact_json(reports), "report")) == rows(reports)


def test_rejected_reports(spark, tmp_path):
    texts = spark.createDataFrame([(1, REPORT), (2, "{}"), (3, "no json"), (4, None), (5, "")], "n int, report string")
    good, bad = accepted_and_rejected(parse_report(texts, "report"))
    assert sorted(r.n for r in good.collect()) == [1, 2] and good.columns == ["n", "test_case_report", "adf_run_details"]
    assert rows(bad) == [(3, "no json"), (4, ""), (5, "")]
    (tmp_path / "good.json").write_text(REPORT)
    (tmp_path / "bad.json").write_text('{"test_case_report": {"TC')
    good, bad = read_report_checked(spark, str(tmp_path))
    assert report_cases(good).count() == 2 and [r.rejected for r in bad.collect()] == ['{"test_case_report": {"TC']
