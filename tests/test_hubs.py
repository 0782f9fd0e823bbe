import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from tests.helpers import at, day, plan, rows, same

from checks.standins import logs
from tablejobs.plans import activity, claims, history, legal
from tablejobs.plans.hub import HubJob, conform, duplicate_keys, version_counts, with_audit
from tablejobs.plans.jobs import JOBS
from tablejobs.sources.snapshots import (
    TableSpec,
    load_snapshots,
    log_table,
    read_specs,
    reader_of,
    short_name,
    snapshot,
)
from tablejobs.sources.tables import qualify

TYPES = {"_timestamp": "timestamp", "_operation": "string"}


def log(spark, spec, *records):
    """A change log with the columns of a spec; records are (instid, time, operation, {column: value})."""
    columns = list(dict.fromkeys([*spec.keys, *spec.columns, "oid_clsno", "oid_instid", "_operation"]))
    types = {
        c: TYPES.get(c) or ("int" if c.endswith("_clsno") else "bigint" if c.endswith("_instid") else "string")
        for c in columns
    }
    data = []
    for instid, time, operation, values in records:
        row = {"oid_clsno": 1, "oid_instid": instid, "_timestamp": at(time), "_operation": operation, **values}
        data.append(tuple(row.get(c) for c in columns))
    return spark.createDataFrame(data, ", ".join(f"{c} {t}" for c, t in types.items()))


def ref(name, instid, clsno=1):
    return {f"my{name}_clsno": clsno, f"my{name}_instid": instid}


def live(instid, **values):
    return (instid, "2024-01-01", "U", values)


THING = log_table("things", "aName", "Owner")


def test_spec_columns():
    assert THING.name == "{db_env}_claims.things"
    assert THING.columns == (
        "_timestamp", "oid_clsno", "oid_instid", "_operation", "aName", "myOwner_clsno", "myOwner_instid"
    )
    assert qualify(THING.name, "dev") == "dev_claims.things" and short_name(THING.name) == "things"
    with pytest.raises(ValueError, match="environment"):
        qualify(THING.name)


def test_snapshot_rules(spark):
    things = log(
        spark,
        THING,
        (1, "2024-01-01", "I", {"aName": "old"}),
        (1, "2024-01-02", "U", {"aName": "new"}),
        (2, "2024-01-01", "I", {"aName": "deleted"}),
        (2, "2024-01-02", "D", {}),
        (3, "2024-01-01", "D", {}),
        (3, "2024-01-02", "I", {"aName": "back"}),
        (4, "2024-01-01", "U", {"aName": "tie a"}),
        (4, "2024-01-01", "U", {"aName": "tie b"}),
        (5, "2024-01-01", None, {"aName": "unknown operation"}),
    )
    names = lambda dedup: [r.aName for r in snapshot(things, THING, dedup).orderBy("oid_instid", "aName").collect()]
    one = names("row_number")
    assert one[:2] == ["new", "back"] and one[2] in ("tie a", "tie b") and len(one) == 3
    assert names("rank") == ["new", "back", "tie a", "tie b"]
    assert names("none") == ["new", "old", "deleted", "back", "tie a", "tie b"]


def test_condition_may_use_columns_that_are_not_kept(spark):
    spec = TableSpec("x.things", ("oid_instid", "aName"))
    got = snapshot(log(spark, THING, live(1, aName="a"), (2, "2024-01-01", "D", {})), spec)
    assert rows(got) == [(1, "a")]


def test_snapshot_reads_only_what_it_needs(spark, sf, capsys):
    spec = TableSpec("x", ("event_type",), ("user_id",), ("ts desc",), "value > 1")
    text = plan(snapshot(spark.read.parquet(f"{sf}/events.parquet"), spec), capsys)
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in text


def test_specs_from_json(spark):
    text = json.dumps(
        {
            "{db_env}_a.things": {
                "part_fields": "oid_clsno,oid_instid",
                "rnk_fields": "_timestamp desc",
                "sel_fields": "oid_instid, aName",
                "filter_con": "_operation != 'D'",
                "active_field": "_timestamp",
            },
            "{db_env}_b.others": {"sel_fields": "aName"},
        }
    )
    first, second = read_specs(text)
    assert (first.keys, first.columns, first.condition) == (
        ("oid_clsno", "oid_instid"), ("oid_instid", "aName"), "_operation != 'D'"
    )
    assert (second.keys, second.condition) == ((), None)
    things = log(spark, THING, (1, "2024-01-01", "I", {"aName": "a"}), (1, "2024-01-02", "D", {"aName": "b"}))
    loaded = load_snapshots(spark, [first, second], "dev", read=reader_of({"things": things, "others": things}))
    assert loaded["things"].isEmpty() and loaded["others"].count() == 2


def test_catalog_is_the_default_reader(spark):
    spark.sql("CREATE OR REPLACE TEMP VIEW things_here AS SELECT 1 AS oid_clsno, 2L AS oid_instid, now() AS _timestamp, 'U' AS _operation")
    spec = TableSpec("things_here", ("oid_instid",))
    assert rows(load_snapshots(spark, [spec])["things_here"]) == [(2,)]
    with pytest.raises(ValueError, match="gone"):
        load_snapshots(spark, [replace(spec, name="db.gone")], read=reader_of({}))


# --- activity ------------------------------------------------------------------------------------


def empty_inputs(spark, tables):
    return {short_name(t.name): log(spark, t, live(0)).limit(0) for t in tables}


def filled(spark, tables, records):
    specs = {short_name(t.name): t for t in tables}
    inputs = empty_inputs(spark, tables)
    inputs.update({name: log(spark, specs[name], *rs) for name, rs in records.items()})
    return inputs


def test_activity_fans_out_to_every_claim_of_the_accident(spark):
    inputs = filled(
        spark,
        activity.TABLES,
        {
            "dl_TIMContactEvent": [
                live(1, aUniqueID="E1", **ref("Accident", 7), **ref("User", 3), **ref("ContactEventType", 5)),
                live(2, aUniqueID="E2", **ref("Accident", 8)),
                live(3, aUniqueID="E3", **ref("Accident", 7, None)),
            ],
            "dl_CTPAccident": [live(7, aUniqueId="A7"), live(8, aUniqueId="A8")],
            "dl_TIMPolicyClaim": [
                live(20, aClaimNumber="C20", **ref("Accident", 7), **ref("Policy", 30)),
                live(21, aClaimNumber="C21", **ref("Accident", 7), **ref("Policy", 99)),
            ],
            "dl_TIMPolicy": [live(30, aPolicyNumber="P30")],
            "dl_TIMContactTypeUser": [live(3, aUserID="U3")],
            "dl_TIMContactEventType": [live(5, aDescription="call")],
        },
    )
    got = activity.activity_details(inputs)
    assert got.columns == list(activity.OUTPUT) and len(got.columns) == 16
    assert "void" not in dict(got.dtypes).values()
    columns = ["conev_id", "clm_no", "acc_no", "pol_no", "user_id", "conev_acc_comm_type"]
    assert rows(got.select(*columns)) == [
        ("E1", "C20", "A7", "P30", "U3", "call"),
        ("E1", "C21", "A7", None, "U3", "call"),
    ]


def test_activity_names_missing_tables(spark):
    with pytest.raises(ValueError, match="dl_TIMPolicy, dl_CTPAccident"):
        keep = [t for t in activity.TABLES if short_name(t.name) not in ("dl_TIMPolicy", "dl_CTPAccident")]
        activity.activity_details(empty_inputs(spark, keep))


# --- history -------------------------------------------------------------------------------------


def history_logs(spark):
    return filled(
        spark,
        history.LOG_TABLES,
        {
            "dl_TIMWflProcess": [live(1, aUniqueID="W1", **ref("Claim", 2)), (9, "2024-01-01", "D", {"aUniqueID": "W9", **ref("Claim", 2)})],
            "dl_TIMPolicyClaim": [live(2, aClaimNumber="C2")],
            "dl_TIMWflActivity": [live(3, aUniqueID="T3", **ref("WflProcess", 1))],
            "dl_CONWflForwardHistoryUpdate": [
                live(4, aPrevReferStatus="p", aNewReferStatus="n", **ref("HistoriedComponent", 3), **ref("CreatedBy", 5)),
                live(4, aPrevReferStatus="p2", aNewReferStatus="n2", **ref("HistoriedComponent", 3)),
            ],
            "dl_TIMContactTypeUser": [live(5, aKey="K5")],
            "dl_CONWflStateHistoryUpdate": [
                live(6, aLastModified="2024-02-02 10:00:00", **ref("HistoriedComponent", 1), **ref("PreviousState", 7), **ref("NewState", 8)),
                live(10, aLastModified="2024-02-02 10:00:00", **ref("HistoriedComponent", 9)),
            ],
            "dl_CONWflProcessState": [live(7, aName="open"), live(8, aName="closed")],
        },
    )


def test_history_branches_ties_and_deleted_processes(spark):
    columns = ["wrkflw_no", "wrkflw_hist_type", "wrkflw_hist_time_dt", "wrkflw_hist_user", "wrkflw_hist_frm_stat", "wrkflw_hist_to_stat"]
    activity_rows = [
        ("T3", "Activity History", at("2024-01-01"), "K5", "p", "n"),
        ("T3", "Activity History", at("2024-01-01"), None, "p2", "n2"),
    ]
    process_row = ("W1", "Process History", at("2024-02-02 10:00:00"), None, "open", "closed")
    deleted_process = ("W9", "Process History", at("2024-02-02 10:00:00"), None, None, None)
    of = lambda dedup: rows(history.workflow_history_of_logs(history_logs(spark), dedup).select(*columns))
    by_repr = lambda items: sorted(items, key=repr)
    assert of("rank") == by_repr([*activity_rows, process_row])
    assert of("none") == by_repr([*activity_rows, process_row, deleted_process])
    assert len(of("row_number")) == 2


def test_history_layout(spark):
    got = history.workflow_history_of_logs(history_logs(spark), "rank")
    assert dict(got.dtypes) == history.TARGET


# --- legal ---------------------------------------------------------------------------------------


def test_legal_contacts(spark):
    of_claim = {**ref("Claim", 2), **ref("ContactTypeSubCategory", 3)}
    inputs = filled(
        spark,
        legal.TABLES,
        {
            "dl_TIMClaimContactType": [
                (1, "2024-01-03", "U", {"aDateEngaged": "2023-05-05", **of_claim, **ref("ContactType", 4)}),
                (2, "2024-01-02", "U", {"aDateEngaged": None, **of_claim, **ref("ContactType", 5)}),
                (3, "2024-01-01", "U", {"aDateEngaged": "soon", **of_claim}),
                (6, "2024-01-01", "U", {"aDateEngaged": "2023-05-05", **of_claim}),
                (7, "2024-01-01", "U", {"aDateEngaged": "2023-05-05", **ref("Claim", 99), **ref("ContactTypeSubCategory", 3)}),
            ],
            "dl_TIMPolicyClaim": [live(2, aClaimNumber=None, aDateInitialConsultSolicitor="2023-02-30", **ref("LitReferralType", 6))],
            "dl_TIMContactTypeSubcategory": [live(3, aCode=None, aDescription=None)],
            "dl_TIMContactTypeClaimLink": [live(4, aKey="17"), live(5, aKey="x")],
            "dl_TIMLitigationReferralType": [live(6, aDescription="own")],
        },
    )
    got = legal.legal_contacts_of_logs(inputs)
    assert dict(got.dtypes) == legal.TARGET
    assert {tuple(r) for r in got.drop("legl_rep_date", "legl_Contact_Id", "legl_rank_first").collect()} == {
        ("", None, "", "", "ClaimLink - ", None, None, "own", "PIMS")
    }
    assert rows(got.select("legl_rank_first", "legl_rep_date", "legl_Contact_Id")) == [
        (1, day("2023-05-05"), None),
        (2, day("2023-05-05"), 17),
        (3, None, None),
        (4, None, None),
    ]
    last = got.filter("legl_rank_first = 4").first()
    assert last.legl_rep_date is None
    assert duplicate_keys(got, JOBS["legal_contacts"].granularity).isEmpty()


def test_numbers_of_contacts_do_not_depend_on_the_ranges(spark, sf):
    inputs = logs(spark, sf, [short_name(t.name) for t in legal.TABLES])
    whole = legal.legal_contacts_of_logs(inputs)
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert same(whole, legal.legal_contacts_of_logs(inputs))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# --- claims and the hub layout -------------------------------------------------------------------


def test_claims(spark):
    inputs = filled(
        spark,
        claims.TABLES,
        {
            "dl_TIMPolicyClaim": [
                (2, "2024-03-08", "U", {"aClaimNumber": "old"}),
                (2, "2024-03-09", "U", {"aClaimNumber": "C2", "aDateReopened": "2024-01-05", "aDateTimeEntered": "later", **ref("Accident", 3)}),
                (4, "2024-03-09", "D", {"aClaimNumber": "C4"}),
            ],
            "dl_CTPAccident": [live(3, aUniqueID="A3", **ref("AccidentLocation", 5))],
            "dl_TIMAddress": [live(5, **ref("State", 6))],
            "dl_TIMState": [live(6, aName="QLD")],
            "dl_TIMProfileHistoryStatus": [
                (7, "2024-01-01", "U", {**ref("Claim", 2), **ref("StatusChangeReason", 8)}),
                (9, "2024-01-02", "U", {**ref("Claim", 2), **ref("StatusChangeReason", 10)}),
            ],
            "dl_TIMClaimStatusHistoryReopen": [live(8, aCode="no"), live(10, aCode="yes")],
        },
    )
    got = claims.claims_of_logs(inputs, "2024-04-01")
    assert dict(got.dtypes) == claims.TARGET and len(got.columns) == 83
    columns = ["clm_no", "acc_no", "clm_mangng_state", "clm_reopen_rs_pir_cd", "clm_reopened_dt", "clm_entrd_dt"]
    audit = ["record_version_no", "active_dt", "active_ym", "load_dt", "source_system_cd"]
    assert rows(got.select(*columns, *audit)) == [
        ("C2", "A3", "QLD", "yes", day("2024-01-05"), None, 2, day("2024-03-09"), "202403", day("2024-04-01"), "PIMS")
    ]


def test_claims_are_unique_on_the_test_tables(spark, sf):
    got = claims.claims_of_logs(logs(spark, sf, [short_name(t.name) for t in claims.TABLES]), "2024-04-01")
    assert got.count() > 100 and duplicate_keys(got, claims.GRANULARITY).isEmpty()


def test_conform(spark):
    df = spark.createDataFrame([("1", "x", "2024-01-01")], "a string, b string, c string")
    assert rows(conform(df, {"c": "date", "b": "int", "a": "int"})) == [(day("2024-01-01"), None, 1)]
    with pytest.raises(ValueError, match="d, e"):
        conform(df, {"a": "int", "d": "int", "e": "int"})


def test_claims_scan_their_log_once(spark, sf, capsys):
    text = plan(claims.claims_of_logs(logs(spark, sf, [short_name(t.name) for t in claims.TABLES])), capsys)
    assert text.count("orders.parquet") == 1


def test_misfits_are_counted_in_the_job(spark, tmp_path):
    job = HubJob(
        "things", (TableSpec("log.things", ("oid_instid", "_timestamp", "aName"), ("oid_instid",)),),
        lambda ds: ds["things"].select(F.col("oid_instid").alias("thing"), F.col("aName").alias("size")), {"thing": "bigint", "size": "int"}, "hub.things", ("thing",),
    )
    inputs = {"things": log(spark, THING, *[(i, "2024-01-05", "U", {"aName": t}) for i, t in enumerate(["1", "x", None, "y", "4"])])}
    path = str(tmp_path / "hub")
    with pytest.raises(ValueError, match="things: values do not fit .*'size': 2"):
        job.run(spark, "dev", reader_of(inputs), path=path, strict=True)
    assert not (tmp_path / "hub").exists()
    assert job.run(spark, "dev", reader_of(inputs), path=path) == {"rows": 5, "size": 2}
    assert rows(spark.read.parquet(path)) == [(0, 1), (1, None), (2, None), (3, None), (4, 4)]


def test_audit_without_versions(spark):
    df = spark.createDataFrame([("x", at("2024-03-31 23:59:59"))], "a string, _timestamp timestamp")
    row = with_audit(df, ["a"], load_dt="2024-04-01").first()
    assert (row.active_ym, row.record_version_no, row.active_dt) == ("202403", None, day("2024-03-31"))
    assert version_counts(df, ["a"]).first().record_version_no == 1


def test_job_builds_and_writes_by_partition(spark, tmp_path):
    job = HubJob.from_config(
        "things",
        {"target_db": "{db_env}_hub", "target_tbl": "things", "TARGET": "thing,source_system_cd,active_ym", "granularity_keys": "thing", "partitions": "source_system_cd, active_ym"},
        [TableSpec("{db_env}_log.things", ("oid_instid", "_timestamp", "aName"))],
        lambda ds: with_audit(ds["things"].withColumn("thing", F.col("oid_instid")), ["thing"]),
        {"thing": "bigint"},
    )
    assert (job.granularity, job.target_table) == (("thing",), "{db_env}_hub.things")
    first = {"things": log(spark, THING, (1, "2024-01-05", "U", {}), (2, "2024-02-05", "U", {}))}
    second = {"things": log(spark, THING, (3, "2024-02-06", "U", {}))}
    path = str(tmp_path / "hub")
    for inputs in (first, second):
        job.write(job.build(spark, "dev", reader_of(inputs)), path=path)
    twice = job.build(spark, "dev", reader_of(first))
    with pytest.raises(ValueError, match="things: 2 keys of .thing. occur more than once"):
        job.write(twice.union(twice), path=path)
    moved = job.located({"{db_env}_log": "site_log", "{db_env}_hub": "site_hub"})
    assert (moved.tables[0].name, moved.target_table) == ("site_log.things", "site_hub.things")
    schema = "thing bigint, source_system_cd string, active_ym string"
    assert rows(spark.read.schema(schema).parquet(path)) == [(1, "PIMS", "202401"), (3, "PIMS", "202402")]


def test_registered_jobs_match_their_layouts(spark):
    for name, tables in (("activity_details", activity.TABLES), ("claims", claims.TABLES), ("legal_contacts", legal.TABLES)):
        inputs = empty_inputs(spark, tables)
        built = JOBS[name].build(spark, "dev", reader_of(inputs))
        assert dict(built.dtypes) == dict(JOBS[name].target), name
    inputs = empty_inputs(spark, history.LOG_TABLES)
    built = JOBS["workflow_history"].build(spark, "dev", reader_of(inputs))
    assert dict(built.dtypes) == history.TARGET


def test_changes_are_moved_last(spark, sf, capsys):
    """Each kind of change is joined to subjects that have their claims already, and nothing is joined above both kinds."""
    names = [short_name(t.name) for t in history.LOG_TABLES]
    text = plan(history.workflow_history_of_logs(logs(spark, sf, names), "none"), capsys)
    assert text.index("Union") < text.index("Join")
