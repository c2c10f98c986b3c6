"""File listing, folder registration, table provider, command line."""

import json
import os
import uuid

from report_files import write_reports

from relaylens.sources.catalog import register_folders, table_provider
from relaylens.sources.reports import list_report_files

SF = "/root/testdata/sf0.001"


def test_list_report_files_reads_only_the_listing(spark, scratch_dir):
    inbox = os.path.join(scratch_dir, "in_box")
    files = write_reports(spark, SF, inbox, ["1995-02"])
    open(os.path.join(inbox, "other.csv"), "w").write("x\n")
    listed = list_report_files(spark, inbox)
    assert "content" not in listed.columns
    names = sorted(r["file_name"] for r in listed.collect())
    assert names == sorted(os.path.basename(f) for f in files)


def test_register_folders(spark, scratch_dir):
    root = os.path.join(scratch_dir, "tables")
    spark.range(5).write.parquet(os.path.join(root, "t_a"))
    spark.range(3).write.parquet(os.path.join(root, "t_b"))
    db = "reg_" + uuid.uuid4().hex[:6]
    created = register_folders(spark, db, root)
    assert len(created) == 2
    assert spark.table(f"{db}.t_a").count() == 5 and spark.table(f"{db}.t_b").count() == 3
    assert table_provider(spark, f"{db}.t_a") == "parquet"


def test_cli_load(spark, scratch_dir, capsys):
    from relaylens.__main__ import main

    inbox = os.path.join(scratch_dir, "in_box")
    write_reports(spark, SF, inbox, ["1995-04"])
    db = "cli_" + uuid.uuid4().hex[:6]
    rc = main(["load", "--inbox", inbox, "--lake-root", os.path.join(scratch_dir, "lake"), "--database", db,
               "--window-id", "202102030405", "--run-date", "2021-02-03"])
    assert rc == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["window_id"] == "202102030405" and out["files"] > 0
    assert spark.table(f"{db}.DetailTable").where("WINDOW_ID = '202102030405'").count() > 0


def test_cli_stream(spark, scratch_dir, capsys):
    from relaylens.__main__ import main

    inbox = os.path.join(scratch_dir, "in_box")
    write_reports(spark, SF, inbox, ["1995-06"])
    db = "clis_" + uuid.uuid4().hex[:6]
    rc = main(["stream", "--inbox", inbox, "--lake-root", os.path.join(scratch_dir, "lake"), "--database", db,
               "--checkpoint", os.path.join(scratch_dir, "ckpt"), "--run-date", "2021-02-03"])
    assert rc == 0
    batches = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert len(batches) == 1 and batches[0]["files"] > 0
    assert spark.table(f"{db}.DetailTable").count() > 0
