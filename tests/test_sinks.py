"""Archive, quarantine, alert parts, warehouse reads."""

import os
import uuid

from helpers import msg, raw_rows
from report_files import write_reports

from relaylens.contract import DETAIL_TABLE, REJECT_TABLE, SUMMARY_TABLE
from relaylens.operators.alerts import alert_lines, low_rate_alerts, render_alerts
from relaylens.plans.load import CatalogWarehouse, LoadConfig, Quarantine, run_load
from relaylens.sinks.archive import ALREADY, CHANGED, MISSING, MOVED, archive_files
from relaylens.sinks.lake import stage, write_alert_parts
from relaylens.sources import jdbc
from relaylens.sources.messages import messages

SF = "/root/testdata/sf0.001"


def archive(spark, files, root, window):
    df = spark.createDataFrame(files, "path string, file_size long")
    out = stage(archive_files(df, root, window), "archive-test", uuid.uuid4().hex)
    return {r["path"].rsplit("/", 1)[1]: (None if r["target"] is None else os.path.basename(r["target"]), r["outcome"]) for r in out.collect()}


def test_archive_never_replaces_a_file_and_can_run_again(spark, scratch_dir):
    inbox, root = os.path.join(scratch_dir, "in box"), os.path.join(scratch_dir, "archive")
    os.makedirs(inbox)
    text = {"a%20b.csv": "1", "b c.csv": "22", "grown.csv": "333"}
    for name, body in text.items():
        open(os.path.join(inbox, name), "w").write(body)
    files = [(os.path.join(inbox, n), len(b)) for n, b in text.items()] + [(os.path.join(inbox, "gone.csv"), 5)]
    files = [("file://" + p if k % 2 else p, n) for k, (p, n) in enumerate(files)]
    open(os.path.join(inbox, "grown.csv"), "a").write("more")
    assert archive(spark, files, root, "w1") == {"a%20b.csv": ("a%20b.csv", MOVED), "b c.csv": ("b c.csv", MOVED), "grown.csv": (None, CHANGED), "gone.csv": (None, MISSING)}
    assert archive(spark, files[:2], root, "w1") == {"a%20b.csv": ("a%20b.csv", ALREADY), "b c.csv": ("b c.csv", ALREADY)}
    # a new file of an archived name: both are kept
    open(os.path.join(inbox, "b c.csv"), "w").write("new")
    assert archive(spark, [(os.path.join(inbox, "b c.csv"), 3)], root, "w1") == {"b c.csv": ("b c.csv.1", MOVED)}
    kept = {f: open(os.path.join(root, "w1", f)).read() for f in os.listdir(os.path.join(root, "w1"))}
    assert kept == {"a%20b.csv": "1", "b c.csv": "22", "b c.csv.1": "new"}
    assert os.listdir(inbox) == ["grown.csv"]


def test_quarantine_accounts_for_every_row(spark, scratch_dir):
    inbox = os.path.join(scratch_dir, "in_box")
    paths = write_reports(spark, SF, inbox, ["1995-02"])
    with open(os.path.join(inbox, "ACME_X_daily_02011995_1_report.csv"), "w") as fh:
        fh.write("IDENTIFIER,CITY\n1,a\n2,b\n")
    with open(paths[0], "a") as fh:
        fh.write(",1,no identifier\n")
    db = "lake_" + uuid.uuid4().hex[:8]
    cfg = LoadConfig(inbox, os.path.join(scratch_dir, "lake"), db, quarantine=Quarantine())
    res = run_load(spark, cfg, "w1", "2021-01-01")
    audit = res.audits[DETAIL_TABLE]
    rejects = spark.table(f"{db}.{REJECT_TABLE}").collect()
    assert res.reject_count == len(rejects) == 3
    assert audit["source_count"] == audit["window_inserts"] + 3 == spark.table(f"{db}.{DETAIL_TABLE}").count() + 3
    by_line = {r["line"]: r for r in rejects}
    assert by_line[",1,no identifier"]["reason"] == "IDENTIFIER is missing" and by_line[",1,no identifier"]["file"].endswith(os.path.basename(paths[0]))
    assert by_line["1,a"]["reason"].startswith("the file has no column ROW_NUMBER; ") and by_line["2,b"]["WINDOW_ID"] == "w1"
    # without it every row is accepted, as in the original
    plain = run_load(spark, LoadConfig(inbox, os.path.join(scratch_dir, "lake2"), db + "b"), "w1", "2021-01-01")
    assert plain.reject_count == 0 and plain.audits[DETAIL_TABLE]["window_inserts"] == audit["source_count"]


def test_alert_parts_in_order_are_the_document(spark, scratch_dir):
    alerts = low_rate_alerts(messages(spark, SF))
    lines = alert_lines(alerts, "2021-01-01")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")  # else so few lines are one part
    try:
        path, n = write_alert_parts(lines, scratch_dir, "2021-01-01", "w1")
    finally:
        spark.conf.set(key, before)
    parts = sorted(f for f in os.listdir(path) if f.endswith(".txt"))
    text = "".join(open(os.path.join(path, f)).read() for f in parts)
    assert len(parts) > 1 and n == alerts.count() > 0
    assert text.replace("\n", "") == render_alerts(alerts, "2021-01-01").first()["html"]
    plan = lines.repartitionByRange("section", "line").sortWithinPartitions("section", "line")._jdf.queryExecution().executedPlan().toString()
    rows = plan.split("Union", 1)[1]
    assert "rangepartitioning" in plan and "collect_list" not in plan and "ObjectHashAggregate" not in rows
    none = alert_lines(alerts.where("false"), "2021-01-01")
    assert none.count() == 0


def test_loads_into_a_catalog_warehouse(spark, scratch_dir):
    inbox = os.path.join(scratch_dir, "in_box")
    write_reports(spark, SF, inbox, ["1995-02"])
    db = "lake_" + uuid.uuid4().hex[:8]
    warehouse = CatalogWarehouse(db + "_wh", os.path.join(scratch_dir, "wh"))
    cfg = LoadConfig(inbox, os.path.join(scratch_dir, "lake"), db, warehouse=warehouse)
    for _ in range(2):  # a retry replaces the window in both
        res = run_load(spark, cfg, "w1", "2021-01-01")
    for name in (DETAIL_TABLE, SUMMARY_TABLE):
        a = res.audits[name]
        assert a["delta_count"] == a["synapse_count"] == a["window_inserts"] and a["count_validation"] == "PASSED" and a["restore_version"] == 1
    assert spark.table(f"{db}.DATA_LOAD").count() == 2


def test_reading_a_window_of_the_warehouse_binds_the_value(spark):
    url = f"jdbc:derby:memory:win_{uuid.uuid4().hex[:8]};create=true"
    target = jdbc.JdbcTarget(url, "T1", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    df = spark.createDataFrame([("w1", 1), ("w2", 2), ("it's", 3)], "WINDOW_ID string, N int")
    jdbc.append(df, target, column_order=["WINDOW_ID", "N"], create_column_types=jdbc.key_column_types())
    one = jdbc.read_window(spark, target, "it's")
    assert [r["N"] for r in one.collect()] == [3]
    assert "PushedFilters: [*IsNotNull(WINDOW_ID), *EqualTo(WINDOW_ID,it's)]" in one._jdf.queryExecution().executedPlan().toString()


def test_counts_beyond_int_do_not_end_a_load(spark):
    from relaylens.operators.summary import daily_stats, summary_from_stats

    stats = daily_stats(raw_rows(spark, [msg()])).selectExpr("SRC_LOB", "Sent_Date", "rows", "3000000000L AS attempts", "reached", "matched", "successful", "elig_count", "elig_failed", "elig_secs")
    row = summary_from_stats(stats, "w").first()
    assert row["NBR_OF_MSG_ATMPT"] is None and row["NBR_OF_MSG_SND"] == 1
