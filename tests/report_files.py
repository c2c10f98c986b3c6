"""Report CSV files derived from the driver tables (through the adapter).

Rows of one (line of business, file month) go to one file named
``ACME_<LOB>_daily_<MMddyyyy>_120000_report.csv``. Even months are written in
the current 24-column layout, odd months in the older 17-column layout with an
unnamed trailing column. Rows with a null line of business cannot be named
and are left out.
"""

import csv
import os

from pyspark.sql import functions as F

from relaylens.contract import GEN1_COLUMNS, REPORT_COLUMNS
from relaylens.sources.messages import messages


def expected_rows(spark, sf_dir, months):
    m = messages(spark, sf_dir)
    return m.where(F.col("SRC_LOB").isNotNull() & F.date_format("Sent_Date", "yyyy-MM").isin(months))


def file_name(lob, month_date):
    return f"ACME_{lob}_daily_{month_date.strftime('%m%d%Y')}_120000_report.csv"


def write_reports(spark, sf_dir, inbox, months, shuffle_columns=False):
    os.makedirs(inbox, exist_ok=True)
    rows = expected_rows(spark, sf_dir, months).collect()
    groups = {}
    for r in rows:
        groups.setdefault((r["SRC_LOB"], r["Sent_Date"]), []).append(r)
    paths = []
    for (lob, month_date), members in sorted(groups.items()):
        newer = month_date.month % 2 == 0
        cols = list(REPORT_COLUMNS) if newer else list(GEN1_COLUMNS)
        if shuffle_columns and newer:
            cols = cols[::-1]
        path = os.path.join(inbox, file_name(lob, month_date))
        with open(path, "w", newline="") as fh:
            w = csv.writer(fh)
            w.writerow(cols + ([] if newer else [""]))
            for r in members:
                w.writerow([("" if r[c] is None else r[c]) for c in cols] + ([] if newer else [""]))
        paths.append(path)
    return paths


def as_older_layout(df):
    """What the union yields for rows read from older-layout files."""
    newer = F.month("Sent_Date") % 2 == 0
    out = df
    from relaylens.contract import GEN2_ONLY_COLUMNS

    for c in GEN2_ONLY_COLUMNS:
        out = out.withColumn(c, F.when(newer, F.col(f"`{c}`")).otherwise(F.lit(None).cast("string")))
    return out
