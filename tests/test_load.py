"""End to end: report files -> lake + warehouse (embedded Derby) -> audit ->
alerts -> archive; a retried load replaces its window; backfill."""

import os
import shutil
import uuid

from report_files import as_older_layout, expected_rows, write_reports

from relaylens.contract import AUDIT_SCHEMA, DETAIL_TABLE, SUMMARY_TABLE
from relaylens.operators.alerts import low_rate_alerts, render_alerts
from relaylens.operators.detail import normalize_detail
from relaylens.operators.summary import daily_summary
from relaylens.plans.backfill import backfill
from relaylens.plans.load import ALERTS_RAISED, NO_NEW_FILES, LoadConfig, Warehouse, recent_audit, run_load
from relaylens.sinks.ddl import add_columns
from relaylens.sources import jdbc

SF = "/root/testdata/sf0.001"
MONTHS = ["1995-01", "1995-02", "1995-03"]
DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def _cfg(scratch, db):
    return LoadConfig(
        inbox=os.path.join(scratch, "in_box"),
        lake_root=os.path.join(scratch, "lake"),
        database=db,
        archive_dir=os.path.join(scratch, "archive"),
        alerts_dir=os.path.join(scratch, "alerts"),
        warehouse=Warehouse(
            url=f"jdbc:derby:memory:wh_{uuid.uuid4().hex[:8]};create=true",
            detail_table="PROV_DTL",
            summary_table="PROV_SUM",
            properties=DERBY,
        ),
    )


def test_full_load_and_retry(spark, scratch_dir):
    db = "lake_" + uuid.uuid4().hex[:8]
    cfg = _cfg(scratch_dir, db)
    files = write_reports(spark, SF, cfg.inbox, MONTHS)
    keep = os.path.join(scratch_dir, "copy")
    shutil.copytree(cfg.inbox, keep)

    res = run_load(spark, cfg, window_id="202101010000", run_date="2021-01-01")
    raw = as_older_layout(expected_rows(spark, SF, MONTHS))
    n = raw.count()
    n_summary = daily_summary(raw, "x").count()

    d, s = res.audits[DETAIL_TABLE], res.audits[SUMMARY_TABLE]
    assert (d["source_count"], d["window_inserts"], d["delta_count"], d["synapse_count"]) == (n, n, n, n)
    assert d["count_validation"] == "PASSED" and d["no_columns"] == 27 and d["restore_version"] == 1
    assert (s["source_count"], s["window_inserts"], s["delta_count"], s["synapse_count"]) == (n, n_summary, n_summary, n_summary)
    assert s["no_columns"] == 9

    lake_detail = spark.table(f"{db}.DetailTable")
    want_detail = normalize_detail(raw, "202101010000")
    assert lake_detail.exceptAll(want_detail.select(*lake_detail.columns)).count() == 0
    lake_summary = spark.table(f"{db}.SummaryTable")
    want_summary = daily_summary(raw, "202101010000")
    assert lake_summary.exceptAll(want_summary.select(*lake_summary.columns)).count() == 0

    # warehouse got the same rows, in its own column order
    wh = jdbc.read_table(spark, cfg.warehouse.target(SUMMARY_TABLE))
    assert wh.count() == n_summary

    # alerts and archive
    if res.status == ALERTS_RAISED:
        alerts = low_rate_alerts(raw)
        assert res.alert_count == alerts.count() > 0
        parts = sorted(f for f in os.listdir(res.alert_path) if f.endswith(".txt"))
        text = "".join(open(os.path.join(res.alert_path, f)).read() for f in parts)
        # the parts, in the order of their names, are the document
        assert text.replace("\n", "") == render_alerts(alerts, "2021-01-01").first()["html"]
    assert res.file_count == len(files) and {r["outcome"] for r in res.archived.collect()} == {"moved"}
    assert res.archived.count() == len(files)
    assert os.listdir(cfg.inbox) == []
    assert os.path.isdir(os.path.join(cfg.archive_dir, "202101010000"))

    # retry of the same window: one copy in the lake and in the warehouse
    for f in os.listdir(keep):
        shutil.copy(os.path.join(keep, f), cfg.inbox)
    res2 = run_load(spark, cfg, window_id="202101010000", run_date="2021-01-01")
    assert res2.audits[DETAIL_TABLE]["delta_count"] == n
    assert res2.audits[DETAIL_TABLE]["synapse_count"] == n
    assert res2.audits[DETAIL_TABLE]["restore_version"] == 1
    assert spark.table(f"{db}.DATA_LOAD").count() == 2  # the retry replaced its audit rows
    recent = recent_audit(spark, cfg, 10).collect()
    assert len(recent) == 2 and list(recent[0].asDict()) == AUDIT_SCHEMA.fieldNames() and recent[0]["WindowID"] == "202101010000"

    # nothing left to do
    assert run_load(spark, cfg, window_id="202101010001").status == NO_NEW_FILES

    # backfill the warehouse detail into a fresh lake table (idempotent)
    spark.sql(f"CREATE TABLE {db}.DetailCopy LIKE {db}.DetailTable")
    copied = backfill(spark, cfg.warehouse.target(DETAIL_TABLE), f"{db}.DetailCopy")
    assert copied == n
    backfill(spark, cfg.warehouse.target(DETAIL_TABLE), f"{db}.DetailCopy")
    assert spark.table(f"{db}.DetailCopy").count() == n

    # schema evolution on the lake side
    added = add_columns(spark, f"{db}.DetailCopy", [("FAX_NUM", "BIGINT"), ("NEW_COL", "STRING")])
    assert added == ["NEW_COL"]
    assert spark.table(f"{db}.DetailCopy").where("NEW_COL IS NOT NULL").count() == 0


def test_jdbc_probe_count_and_catalog(spark):
    url = f"jdbc:derby:memory:probe_{uuid.uuid4().hex[:8]};create=true"
    target = jdbc.JdbcTarget(url, "T1", dict(DERBY))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "ID int, NAME string")
    jdbc.append(df, target, column_order=["NAME", "ID"], create_column_types=jdbc.key_column_types(["NAME"]))
    assert jdbc.probe_columns(spark, target) == ["NAME", "ID"]
    assert jdbc.remote_count(spark, target) == 3
    part = jdbc.read_table(spark, target, partition_column="ID", lower_bound=1, upper_bound=4, num_partitions=2)
    assert part.rdd.getNumPartitions() == 2 and part.count() == 3
    tables = jdbc.remote_catalog(spark, target, "SELECT CAST(TABLENAME AS VARCHAR(128)) AS TABLENAME FROM SYS.SYSTABLES")
    assert "T1" in [r[0] for r in tables.collect()]


def test_window_count_scope(spark, scratch_dir):
    db = "lake_" + uuid.uuid4().hex[:8]
    cfg = _cfg(scratch_dir, db)
    cfg.count_scope = "window"
    cfg.archive_dir = None
    write_reports(spark, SF, cfg.inbox, ["1995-05"])
    first = run_load(spark, cfg, window_id="202101010000", run_date="2021-01-01")
    n = first.audits[DETAIL_TABLE]["window_inserts"]
    second = run_load(spark, cfg, window_id="202101010100", run_date="2021-01-01")
    d = second.audits[DETAIL_TABLE]
    # only the loaded window is counted, in both sinks
    assert (d["delta_count"], d["synapse_count"], d["count_validation"]) == (n, n, "PASSED")
    assert spark.table(f"{db}.DetailTable").count() == 2 * n


def test_quality_counters(spark, scratch_dir):
    db = "lake_" + uuid.uuid4().hex[:8]
    cfg = _cfg(scratch_dir, db)
    cfg.warehouse = None
    cfg.archive_dir = None
    os.makedirs(cfg.inbox)
    header = "IDENTIFIER,PRESCRIBER_NPI,NPI Match Status,Provider_Directaddress,Direct Status,Date Message Sent,Date Failed/Confirmed"
    lines = [
        "a,1234567890,Found,dm1,Confirmed,01/02/2021 03:04:05 PM,01/02/2021 03:05:05 PM",
        "b,2345678901,Found,dm1,Confirmed,01/02/2021 03:04:05 pm,junk",
        "c,,Found,dm2,Failed,garbage,",
    ]
    with open(os.path.join(cfg.inbox, "ACME_L1_daily_01022021_1_report.csv"), "w") as fh:
        fh.write(header + "\n" + "\n".join(lines) + "\n")
    res = run_load(spark, cfg, window_id="202101020000", run_date="2021-01-02")
    q = res.quality
    assert q["rows"] == 3
    assert q["sent_unparseable"] == 1 and q["confirmed_unparseable"] == 1
    assert q["lowercase_meridiem"] == 1 and q["npi_beyond_int"] == 1
    assert q["null_lob"] == 0 and q["null_file_date"] == 0


def test_optimize_write_keeps_rows(spark, scratch_dir):
    db = "lake_" + uuid.uuid4().hex[:8]
    cfg = _cfg(scratch_dir, db)
    cfg.warehouse = None
    cfg.archive_dir = None
    cfg.optimize_write = True
    write_reports(spark, SF, cfg.inbox, ["1995-07"])
    res = run_load(spark, cfg, window_id="202101070000", run_date="2021-01-07")
    want = expected_rows(spark, SF, ["1995-07"])
    assert res.audits[DETAIL_TABLE]["window_inserts"] == want.count()
    lake = spark.table(f"{db}.DetailTable")
    expected = normalize_detail(as_older_layout(want), "202101070000").select(*lake.columns)
    assert lake.exceptAll(expected).count() == 0 and expected.exceptAll(lake).count() == 0
