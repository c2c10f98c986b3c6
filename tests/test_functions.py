"""Scalar functions on the edge cases of the report texts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from relaylens.functions.casts import percent, text_to_bigint, text_to_int
from relaylens.functions.filename import decode_file_name, file_date_from_file_name, is_report_file, lob_from_file_name
from relaylens.functions.text import html_escape
from relaylens.functions.timeparse import (
    confirm_seconds,
    effective_send_date,
    elapsed_minutes,
    parse_report_timestamp,
    report_date_part,
)

D = dt.datetime

# (text, expected timestamp, expected date part)
TEXT_CASES = [
    ("01/02/2021 03:04:05 PM", D(2021, 1, 2, 15, 4, 5), dt.date(2021, 1, 2)),
    ("1/2/2021 3:04:05 PM", D(2021, 1, 2, 15, 4, 5), dt.date(2021, 1, 2)),
    ("01/02/2021 13:04:05", D(2021, 1, 2, 13, 4, 5), dt.date(2021, 1, 2)),
    ("01/02/2021 03:04:05 pm", D(2021, 1, 2, 3, 4, 5), dt.date(2021, 1, 2)),
    ("01/02/2021", None, dt.date(2021, 1, 2)),
    ("12/31/2021 11:59:59 PM trailing", D(2021, 12, 31, 23, 59, 59), dt.date(2021, 12, 31)),
    ("13/40/2021 01:02:03", None, None),
    ("junk", None, None),
    ("", None, None),
    (None, None, None),
    ("01/02/2021 25:00:00", None, dt.date(2021, 1, 2)),
    ("01/02/2021 13:04:05 PM", None, dt.date(2021, 1, 2)),
    ("01/02/2021 00:10:00 AM", None, dt.date(2021, 1, 2)),
    ("01/02/2021 3:04 PM", None, dt.date(2021, 1, 2)),
    ("1/2/21 3:04:05 PM", D(21, 1, 2, 15, 4, 5), dt.date(21, 1, 2)),
    (" 01/02/2021 03:04:05", D(2021, 1, 2, 3, 4, 5), None),
    ("01/02/2021abc", None, dt.date(2021, 1, 2)),
    ("01/02/2021  03:04:05", D(2021, 1, 2, 3, 4, 5), dt.date(2021, 1, 2)),
    ("01/02/2021 12:00:00 AM", D(2021, 1, 2, 0, 0, 0), dt.date(2021, 1, 2)),
    ("01/02/2021 12:30:00 PM", D(2021, 1, 2, 12, 30, 0), dt.date(2021, 1, 2)),
    ("02/29/2021 01:02:03", None, None),
]


def test_parse_report_timestamp_and_date(spark):
    df = spark.createDataFrame([(c[0],) for c in TEXT_CASES], "t string")
    got = df.select("t", parse_report_timestamp("t").alias("ts"), report_date_part("t").alias("d")).collect()
    for (text, want_ts, want_d), row in zip(TEXT_CASES, got):
        assert row["ts"] == want_ts, text
        assert row["d"] == want_d, text


def test_effective_date_falls_back_to_file_date(spark):
    df = spark.createDataFrame(
        [("01/02/2021 03:04:05", dt.date(2020, 5, 1)), (" 01/02/2021 03:04:05", dt.date(2020, 5, 1)), (None, dt.date(2020, 5, 1))],
        "t string, f date",
    )
    got = [r[0] for r in df.select(effective_send_date("t", "f")).collect()]
    assert got == [dt.date(2021, 1, 2), dt.date(2020, 5, 1), dt.date(2020, 5, 1)]


def test_confirm_seconds(spark):
    df = spark.createDataFrame(
        [
            ("01/02/2021 03:04:05", "01/02/2021 03:05:05"),  # 60 s
            ("01/02/2021 03:05:05", "01/02/2021 03:04:05"),  # confirmed before sent: positive
            ("01/02/2021 03:04:05", None),  # missing confirmation: 0
            ("01/02/2021 03:04:05", "01/02/2021 03:04:05"),  # equal: 0
        ],
        "s string, c string",
    )
    got = [r[0] for r in df.select(confirm_seconds(parse_report_timestamp("s"), parse_report_timestamp("c"))).collect()]
    assert got == [60, 60, 0, 0]


def test_elapsed_minutes_truncates(spark):
    df = spark.createDataFrame([(D(2021, 1, 1, 0, 0, 0), D(2021, 1, 1, 0, 2, 59))], "a timestamp, b timestamp")
    assert df.select(elapsed_minutes("a", "b")).first()[0] == 2


@pytest.mark.parametrize(
    "name,lob,fdate",
    [
        ("ACME_LOBX_daily_01022021_120000_report.csv", "LOBX", dt.date(2021, 1, 2)),
        ("file:/in_box/ACME_LOBX_daily_01022021_120000_report.csv", "LOBX", dt.date(2021, 1, 2)),
        ("ACME_4-NOT%20SPECIFIED_daily_02032021_1_report.csv", "4-NOT SPECIFIED", dt.date(2021, 2, 3)),
        ("ACME_X_13022021_1_report.csv", "X", None),
        ("report.csv", None, None),
    ],
)
def test_file_name_fields(spark, name, lob, fdate):
    df = spark.createDataFrame([(name,)], "n string")
    decoded = decode_file_name("n")
    row = df.select(lob_from_file_name(decoded).alias("l"), file_date_from_file_name(decoded).alias("d")).first()
    assert row["l"] == lob
    assert row["d"] == fdate


def test_suffix_filter(spark):
    df = spark.createDataFrame([("a_report.csv",), ("a_report.csv.bak",), ("REPORT.CSV",)], "n string")
    assert [r[0] for r in df.where(is_report_file("n")).collect()] == ["a_report.csv"]


def test_integer_casts(spark):
    df = spark.createDataFrame([(x,) for x in ["12", "12.7", " 7 ", "-3", "2345678901", "abc", "01234", None]], "s string")
    rows = df.select(text_to_int("s").alias("i"), text_to_bigint("s").alias("b")).collect()
    assert [r["i"] for r in rows] == [12, 12, 7, -3, None, None, 1234, None]
    assert [r["b"] for r in rows] == [12, 12, 7, -3, 2345678901, None, 1234, None]


def test_percent_rounding_and_overflow(spark):
    row = spark.range(1).select(
        percent(F.lit(23), F.lit(160)).alias("a"),
        percent(F.lit(1), F.lit(0)).alias("z"),
        percent(F.lit(20), F.lit(1), 5, 2).alias("ov"),
        percent(F.lit(1), F.lit(8)).alias("h"),
    ).first()
    assert str(row["a"]) == "14.37"
    assert row["z"] is None
    assert row["ov"] is None  # 2000 % does not fit DECIMAL(5,2)
    assert str(row["h"]) == "12.50"


def test_html_escape(spark):
    row = spark.range(1).select(html_escape(F.lit("a<b>&c")).alias("e")).first()
    assert row["e"] == "a&lt;b&gt;&amp;c"
