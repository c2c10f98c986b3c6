"""Write an inbox of report CSV files derived from the driver tables.

Spark writes the ``messages`` rows partitioned by (line of business, file
month), one file per partition; the files are then renamed (metadata only) to
report names ``ACME_<LOB>_daily_<MMddyyyy>_120000_report.csv``. Even months use
the current 24-column layout, odd months the older 17-column one. Rows with a
null line of business cannot be named and are left out.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from relaylens.contract import GEN1_COLUMNS, REPORT_COLUMNS
from relaylens.sources.messages import messages


def write_inbox(spark: SparkSession, sf_dir: str, work_dir: str, inbox: str) -> int:
    m = messages(spark, sf_dir).where(F.col("SRC_LOB").isNotNull())
    newer = (F.month("Sent_Date") % 2) == 0
    layouts = [("gen2", m.where(newer), REPORT_COLUMNS), ("gen1", m.where(~newer), GEN1_COLUMNS)]
    for name, df, cols in layouts:
        (
            df.select(*[F.col(f"`{c}`") for c in cols], "SRC_LOB", "Sent_Date")
            .repartition("SRC_LOB", "Sent_Date")
            .write.mode("overwrite")
            .option("header", "true")
            .partitionBy("SRC_LOB", "Sent_Date")
            .csv(f"{work_dir}/{name}")
        )
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    target = Path(inbox)
    fs = target.getFileSystem(conf)
    fs.mkdirs(target)
    moved = 0
    for name, _, _ in layouts:
        it = fs.listFiles(Path(f"{work_dir}/{name}"), True)
        while it.hasNext():
            p = it.next().getPath()
            if not p.getName().endswith(".csv"):
                continue
            date_dir = p.getParent().getName().split("=", 1)[1]
            lob_dir = p.getParent().getParent().getName().split("=", 1)[1]
            lob = jvm.java.net.URLDecoder.decode(lob_dir.replace("+", "%2B"), "UTF-8")
            day = dt.date.fromisoformat(date_dir)
            fname = f"ACME_{lob}_daily_{day.strftime('%m%d%Y')}_12{moved % 10000:04d}_report.csv"
            fs.rename(p, Path(target, fname))
            moved += 1
    return moved
