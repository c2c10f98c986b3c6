"""Incremental ingest: a file is loaded once; new files are picked up by the
next run from the same checkpoint; other names are ignored."""

import os
import shutil
import uuid

from report_files import write_reports

from relaylens.plans.load import LoadConfig
from relaylens.streaming.ingest import start_ingest, start_load_stream

SF = "/root/testdata/sf0.001"


def test_stream_picks_up_new_files_once(spark, scratch_dir):
    staging = os.path.join(scratch_dir, "staging")
    files = write_reports(spark, SF, staging, ["1995-01", "1995-02"])
    inbox = os.path.join(scratch_dir, "in_box")
    os.makedirs(inbox)
    first, rest = files[:2], files[2:]
    for f in first:
        shutil.copy(f, inbox)
    open(os.path.join(inbox, "ignore_me.txt"), "w").write("x")
    ckpt = os.path.join(scratch_dir, "ckpt")
    seen = []

    def record(sess, batch, window_id, batch_id):
        seen.append((batch_id, window_id, [os.path.basename(r["path"]) for r in batch.files.collect()]))

    q = start_ingest(spark, inbox, ckpt, record)
    q.awaitTermination(120)
    assert sorted(n for _, _, names in seen for n in names) == sorted(os.path.basename(f) for f in first)

    for f in rest:
        shutil.copy(f, inbox)
    q = start_ingest(spark, inbox, ckpt, record)
    q.awaitTermination(120)
    names = [n for _, _, ns in seen for n in ns]
    assert sorted(names) == sorted(os.path.basename(f) for f in files)  # each file exactly once
    assert len({w for _, w, _ in seen}) == len(seen)  # one window per batch


def test_stream_runs_full_load(spark, scratch_dir):
    inbox = os.path.join(scratch_dir, "in_box")
    write_reports(spark, SF, inbox, ["1995-03"])
    db = "stream_" + uuid.uuid4().hex[:8]
    cfg = LoadConfig(inbox=inbox, lake_root=os.path.join(scratch_dir, "lake"), database=db)
    q = start_load_stream(spark, cfg, os.path.join(scratch_dir, "ckpt"), run_date="2021-01-01")
    q.awaitTermination(180)
    results = q.load_results
    assert len(results) == 1
    n = results[0].audits["DetailTable"]["window_inserts"]
    assert n > 0 and spark.table(f"{db}.DetailTable").count() == n


def test_stream_archives_consumed_files(spark, scratch_dir):
    staging = os.path.join(scratch_dir, "staging")
    files = write_reports(spark, SF, staging, ["1995-01"])
    inbox = os.path.join(scratch_dir, "in_box")
    archive = os.path.join(scratch_dir, "archive")
    os.makedirs(inbox)
    shutil.copy(files[0], inbox)
    ckpt = os.path.join(scratch_dir, "ckpt")
    seen = []

    def record(sess, batch, window_id, batch_id):
        seen.append([os.path.basename(r["path"]) for r in batch.files.collect()])

    start_ingest(spark, inbox, ckpt, record, archive_dir=archive).awaitTermination(120)
    shutil.copy(files[1], inbox)
    start_ingest(spark, inbox, ckpt, record, archive_dir=archive).awaitTermination(120)
    # the first batch's file was moved when the second batch was planned
    assert os.path.basename(files[0]) not in os.listdir(inbox)
    archived = [f for _, _, fs in os.walk(archive) for f in fs]
    assert os.path.basename(files[0]) in archived
    assert [n for b in seen for n in b] == [os.path.basename(files[0]), os.path.basename(files[1])]
