"""What loads keep on disk: no text in the shuffle of the report files, and nothing that is spent."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from relaylens.contract import RAW_COLUMNS
from relaylens.plans import load_queries as Q
from relaylens.plans.load import LoadConfig, run_load
from relaylens.session import checkpoint_dir
from relaylens.sinks.lake import shuffles_dropped, stage
from relaylens.sources.messages import file_digest, messages, messages_from
from tests.report_files import write_reports

SF = "/root/testdata/sf0.001"
SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def small_tables(spark):
    """(lineitem, orders): a null and several lines of business, rows that come twice, two months."""
    lines = [(k, 10 + k, k % 7, 1 + k % 3, 10.0 + k, "FO"[k % 2]) for k in range(1, 41)]
    orders = [(k, f"199{k % 2}-0{1 + k % 3}-05", None if k % 11 == 0 else f"{k % 3}-LOB") for k in range(1, 41)]
    lineitem = spark.createDataFrame(lines * 2, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_linestatus string")
    return lineitem, spark.createDataFrame(orders, "o_orderkey long, day string, o_orderpriority string").withColumn("o_orderdate", F.to_date("day"))


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_rows_by_file_are_the_same_rows_in_one_task_side_by_side(spark):
    tables = small_tables(spark)
    dealt = messages_from(*tables, by_file=True)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, messages_from(*tables).collect()))
    placed = dealt.select(F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("at"), "SRC_LOB", "Sent_Date", file_digest(F.col("SRC_LOB"), F.col("Sent_Date")).alias("digest"))
    files, last = {}, {}
    for r in sorted(placed.collect(), key=lambda r: r["at"]):
        assert files.setdefault((r["SRC_LOB"], r["Sent_Date"]), r["task"]) == r["task"]
        assert last.get(r["task"], -(2**63)) <= r["digest"]
        last[r["task"]] = r["digest"]


def test_no_text_of_a_report_is_shuffled(spark):
    lines = Q.report_lines(messages(spark, SF, by_file=True))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 3  # the join's two sides, then its rows by file
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RepartitionByExpression")
    assert "Main St" in above and "Main St" not in below and not set(RAW_COLUMNS) & set(below.replace("#", " ").split())


def test_rows_of_a_file_that_do_not_come_together_are_an_error(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a_report.csv", "h", "x"), (2, "b_report.csv", "h", "y"), (3, "a_report.csv", "h", "z")], "digest long, name string, header string, line string")
    with pytest.raises(Exception, match="do not come together"):
        Q.write_report_files(rows.coalesce(1), str(tmp_path))


def test_a_write_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(SETTING, None)
    staged = stage(spark.range(1000).repartition(F.col("id") % 5), "spent-shuffle", "disk-test")
    assert not shuffle_files(spark) - before
    assert staged.count() == 1000 and spark.conf.get(SETTING, None) == setting
    with shuffles_dropped(spark):
        with shuffles_dropped(spark):
            pass
        assert spark.conf.get(SETTING) == "true"
    assert spark.conf.get(SETTING, None) == setting


def test_a_load_leaves_neither_lines_nor_rows_staged(spark, tmp_path):
    write_reports(spark, SF, str(tmp_path / "in"), ["1995-01", "1995-02"])
    result = run_load(spark, LoadConfig(str(tmp_path / "in"), str(tmp_path / "lake"), "disk_db"), "disk-window", "2021-01-01")
    staged = f"{checkpoint_dir(spark).removeprefix('file://')}/staging/disk-window"
    assert result.file_count and not glob.glob(f"{staged}/**/lines", recursive=True) + glob.glob(f"{staged}/rows")
    assert os.listdir(tmp_path / "in")  # the caller's files stay


def test_queries_remove_the_files_they_wrote_and_read(spark):
    top = f"{checkpoint_dir(spark).removeprefix('file://')}"
    held = lambda: set(glob.glob(f"{top}/queries/*/**/*report.csv", recursive=True))
    rows = lambda: set(glob.glob(f"{top}/staging/slice-*/lines") + glob.glob(f"{top}/staging/slice-*/rows"))
    before, staged = held(), rows()
    assert Q.q_inbox_rows(spark, SF).count() and Q.q_slices_summary(spark, SF).count()
    assert all(f.endswith("ACME_NONE_daily_01011999_120000_report.csv") for f in held() - before)
    assert rows() == staged
