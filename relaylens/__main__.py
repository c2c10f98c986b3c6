"""Command line: run one load, or drain the inbox as a stream.

    python -m relaylens load --inbox DIR --lake-root DIR [--database NAME]
        [--archive-dir DIR] [--alerts-dir DIR] [--jdbc-url URL --detail-table T
        --summary-table T [--jdbc-prop key=value ...]] [--window-id ID] [--run-date D]
    python -m relaylens stream --checkpoint DIR (same options)

Prints the load result as JSON. The session comes from the environment
(``spark-submit`` settings); ``spark.checkpoint.dir`` must name shared storage
on a cluster.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from relaylens.plans.load import LoadConfig, Warehouse, run_load
from relaylens.session import apply_semantic_conf


def _config(a) -> LoadConfig:
    warehouse = None
    if a.jdbc_url:
        props = dict(kv.split("=", 1) for kv in a.jdbc_prop)
        warehouse = Warehouse(a.jdbc_url, a.detail_table, a.summary_table, props)
    return LoadConfig(
        inbox=a.inbox,
        lake_root=a.lake_root,
        database=a.database,
        fmt=a.format,
        archive_dir=a.archive_dir,
        alerts_dir=a.alerts_dir,
        warehouse=warehouse,
        strict_columns=a.strict,
    )


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="relaylens")
    p.add_argument("mode", choices=["load", "stream"])
    p.add_argument("--inbox", required=True)
    p.add_argument("--lake-root", required=True)
    p.add_argument("--database", default="message_reports")
    p.add_argument("--format", default="parquet")
    p.add_argument("--archive-dir")
    p.add_argument("--alerts-dir")
    p.add_argument("--jdbc-url")
    p.add_argument("--detail-table")
    p.add_argument("--summary-table")
    p.add_argument("--jdbc-prop", action="append", default=[])
    p.add_argument("--window-id")
    p.add_argument("--run-date")
    p.add_argument("--checkpoint")
    p.add_argument("--strict", action="store_true")
    a = p.parse_args(argv)

    spark = SparkSession.builder.appName("relaylens").getOrCreate()
    apply_semantic_conf(spark)
    cfg = _config(a)
    if a.mode == "load":
        r = run_load(spark, cfg, window_id=a.window_id, run_date=a.run_date)
        out = {"status": r.status, "window_id": r.window_id, "files": r.file_count, "alerts": r.alert_count,
               "audits": {k: {kk: str(vv) for kk, vv in v.items()} for k, v in r.audits.items()}}
        print(json.dumps(out))
        return 0
    if not a.checkpoint:
        p.error("stream needs --checkpoint")
    from relaylens.streaming.ingest import start_load_stream

    q = start_load_stream(spark, cfg, a.checkpoint, run_date=a.run_date, archive_dir=a.archive_dir)
    q.awaitTermination()
    print(json.dumps([{"status": r.status, "window_id": r.window_id, "files": r.file_count} for r in q.load_results]))
    return 0


if __name__ == "__main__":
    sys.exit(main())
