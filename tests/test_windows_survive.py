"""Loads keep each other's windows in any session, and a retry leaves one copy."""

import datetime as dt
import threading
import uuid

import pytest
from helpers import msg, raw_rows

from relaylens.contract import AUDIT_TABLE, DETAIL_TABLE
from relaylens.functions.casts import text_to_int
from relaylens.operators.detail import normalize_detail
from relaylens.operators.audit import audit_row, write_audit
from relaylens.plans.backfill import write_windows
from relaylens.plans.load import new_window_id
from relaylens.sinks.ddl import create_lake_tables
from relaylens.sinks.lake import read_window, write_window
from relaylens.sources.catalog import table_version

KEY = "spark.sql.sources.partitionOverwriteMode"


def test_windows_survive_in_a_plain_session(spark, scratch_dir):
    plain = spark.newSession()
    plain.conf.set(KEY, "static")
    tables = create_lake_tables(plain, "plain_windows", scratch_dir)
    name = tables.qualified(DETAIL_TABLE)
    for window, n in (("w1", 5), ("w2", 3), ("w1", 5)):
        rows = normalize_detail(raw_rows(plain, [msg() for _ in range(n)]), window)
        assert write_window(rows, name, window) == n
    got = {r["WINDOW_ID"]: r["count"] for r in plain.table(name).groupBy("WINDOW_ID").count().collect()}
    assert got == {"w1": 5, "w2": 3}
    assert plain.conf.get(KEY).lower() == "static"  # the caller's setting is back


def test_default_window_ids_of_one_minute_differ():
    now = dt.datetime(2021, 1, 1, 12, 30, tzinfo=dt.timezone.utc)
    a, b = new_window_id(now), new_window_id(now)
    assert a != b and a.startswith("202101011230-")


def test_fraction_only_texts_count_as_zero(spark):
    df = spark.createDataFrame([(x,) for x in (".5", "+.5", ".", "-.7", "", "+", "1.9", "x")], "t string")
    assert [r[0] for r in df.select(text_to_int("t")).collect()] == [0, 0, 0, 0, None, None, 1, None]


def _lake(spark, scratch_dir):
    return create_lake_tables(spark, "lake_" + uuid.uuid4().hex[:8], scratch_dir)


def test_threads_of_one_static_session_keep_each_others_windows(spark, scratch_dir):
    plain = spark.newSession()
    plain.conf.set(KEY, "static")
    name = _lake(plain, scratch_dir).qualified(DETAIL_TABLE)
    failed = []

    def load(k):
        try:
            for again in range(3):  # each window is written three times, the last one counts
                rows = normalize_detail(raw_rows(plain, [msg() for _ in range(k + again)]), f"w{k}")
                assert write_window(rows, name, f"w{k}") == k + again
        except Exception as e:  # noqa: BLE001 - told by the main thread
            failed.append(e)

    threads = [threading.Thread(target=load, args=(k,)) for k in range(1, 5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    got = {r["WINDOW_ID"]: r["count"] for r in plain.table(name).groupBy("WINDOW_ID").count().collect()}
    assert got == {f"w{k}": k + 2 for k in range(1, 5)}
    assert plain.conf.get(KEY).lower() == "static" and table_version(plain, name) == 4


def test_backfill_replaces_its_windows_only(spark, scratch_dir):
    plain = spark.newSession()
    plain.conf.set(KEY, "static")
    name = _lake(plain, scratch_dir).qualified(DETAIL_TABLE)
    one = lambda w, n: normalize_detail(raw_rows(plain, [msg() for _ in range(n)]), w)
    write_window(one("w1", 1), name, "w1")
    write_window(one("w2", 2), name, "w2")
    assert write_windows(one("w2", 5).unionByName(one("w'3 é", 3)), name) == 8
    got = {r["WINDOW_ID"]: r["count"] for r in plain.table(name).groupBy("WINDOW_ID").count().collect()}
    assert got == {"w1": 1, "w2": 5, "w'3 é": 3}
    assert read_window(plain, name, "w'3 é").count() == 3
    with pytest.raises(Exception, match="may not be null"):
        write_windows(one(None, 1).unionByName(one("w1", 4)), name)
    assert plain.table(name).count() == 9


def test_a_window_without_an_id_is_refused(spark, scratch_dir):
    tables = _lake(spark, scratch_dir)
    rows = normalize_detail(raw_rows(spark, [msg()]), "w1")
    for bad in (None, ""):
        with pytest.raises(ValueError, match="may not be null"):
            write_window(rows, tables.detail, bad)
        now = dt.datetime(2021, 1, 1)
        with pytest.raises(ValueError):
            audit_row(spark, DETAIL_TABLE, bad, 1, 1, 1, 27, 1, now, now, now, 1)
        row = audit_row(spark, DETAIL_TABLE, "w1", 1, 1, 1, 27, 1, now, now, now, 1)
        with pytest.raises(ValueError, match="may not be null"):
            write_audit(row, tables.qualified(AUDIT_TABLE), DETAIL_TABLE, bad)
    assert spark.table(tables.detail).count() == 0 and spark.table(tables.audit).count() == 0


def test_a_window_written_empty_is_emptied(spark, scratch_dir):
    name = _lake(spark, scratch_dir).qualified(DETAIL_TABLE)
    rows = normalize_detail(raw_rows(spark, [msg(), msg()]), "w1")
    assert write_window(rows, name, "w1") == 2
    assert write_window(rows.where("false"), name, "w1") == 0
    assert spark.table(name).count() == 0


def test_reading_a_window_lists_only_its_partition(spark, scratch_dir):
    name = _lake(spark, scratch_dir).qualified(DETAIL_TABLE)
    for w in ("w1", "w2", "w3"):
        write_window(normalize_detail(raw_rows(spark, [msg()] * 2), w), name, w)
    one = read_window(spark, name, "w2")
    assert one.count() == 2 and {r["WINDOW_ID"] for r in one.collect()} == {"w2"}
    plan = one._jdf.queryExecution().executedPlan()
    scans = plan.collectLeaves()
    assert [scans.apply(i).metrics().apply("numPartitions").value() for i in range(scans.size())] in ([1], [0])
    assert "PartitionFilters: [isnotnull(WINDOW_ID" in plan.toString() and "(WINDOW_ID" in plan.toString()
    assert [f.split("/")[-2] for f in one.inputFiles()] and all("WINDOW_ID=w2" in f for f in one.inputFiles())
    assert read_window(spark, name, "w1' OR '1'='1").count() == 0  # a value, not SQL text
