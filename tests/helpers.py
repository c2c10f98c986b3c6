"""Small builders for hand-written report rows (unit tests only)."""

import datetime as dt

from relaylens.contract import RAW_COLUMNS, RAW_TEXT_SCHEMA


def raw_rows(spark, rows):
    """rows: list of dicts keyed by report column names; missing -> null."""
    data = [tuple(r.get(c) for c in RAW_COLUMNS) for r in rows]
    return spark.createDataFrame(data, RAW_TEXT_SCHEMA)


def msg(lob="L1", sent="01/02/2021 03:04:05 PM", conf=None, match="Found", addr="dm1", direct="Confirmed", file_date=dt.date(2021, 1, 1), **extra):
    row = {
        "SRC_LOB": lob,
        "Date Message Sent": sent,
        "Date Failed/Confirmed": conf,
        "NPI Match Status": match,
        "Provider_Directaddress": addr,
        "Direct Status": direct,
        "Sent_Date": file_date,
    }
    row.update(extra)
    return row
