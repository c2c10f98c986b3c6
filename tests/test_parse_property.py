"""Property test: the Spark timestamp parser against a Python model of the
lenient report semantics (prefix match, one-digit fields, blanks, trailing
text ignored, 12-hour only when upper-case AM/PM appears)."""

import calendar
import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from relaylens.functions.timeparse import parse_report_timestamp, report_date_part

_D = r"(\d{1,2})/(\d{1,2})/(\d{1,5})"
_T = r"(\d{1,2}):(\d{1,2}):(\d{1,2})"
RE12 = re.compile(rf"^[ \t]*{_D} [ \t]*{_T}[ \t]+([AaPp][Mm])")
RE24 = re.compile(rf"^[ \t]*{_D} [ \t]*{_T}")
RED = re.compile(rf"^[ \t]*{_D}")


def _valid(y, mo, d):
    return 1 <= y <= 9999 and 1 <= mo <= 12 and 1 <= d <= calendar.monthrange(y, mo)[1]


def model_ts(text):
    if text is None:
        return None
    if "AM" in text or "PM" in text:
        m = RE12.match(text)
        if not m:
            return None
        mo, d, y, h, mi, s = (int(g) for g in m.groups()[:6])
        if not 1 <= h <= 12:
            return None
        h = h % 12 + (12 if m.group(7).upper() == "PM" else 0)
    else:
        m = RE24.match(text)
        if not m:
            return None
        mo, d, y, h, mi, s = (int(g) for g in m.groups())
        if h > 23:
            return None
    if mi > 59 or s > 59 or not _valid(y, mo, d):
        return None
    return dt.datetime(y, mo, d, h, mi, s)


def model_date(text):
    if text is None:
        return None
    first = text.split(" ")[0]
    m = RED.match(first)
    if not m:
        return None
    mo, d, y = (int(g) for g in m.groups())
    return dt.date(y, mo, d) if _valid(y, mo, d) else None


def _num(lo, hi, pad):
    return st.integers(lo, hi).map(lambda v: str(v).zfill(pad) if pad else str(v))


@st.composite
def report_text(draw):
    mo = draw(st.one_of(_num(1, 12, 2), _num(1, 12, 0), _num(0, 13, 0)))
    d = draw(st.one_of(_num(1, 28, 2), _num(1, 31, 0), _num(29, 32, 0)))
    y = draw(st.one_of(_num(1990, 2030, 4), _num(1, 99, 0), _num(1000, 9999, 0)))
    h = draw(st.one_of(_num(0, 23, 2), _num(1, 12, 0), _num(0, 25, 0)))
    mi = draw(st.one_of(_num(0, 59, 2), _num(0, 61, 0)))
    s = draw(st.one_of(_num(0, 59, 2), _num(0, 61, 0)))
    lead = draw(st.sampled_from(["", "", " ", "\t"]))
    gap = draw(st.sampled_from([" ", " ", "  ", " \t"]))
    marker = draw(st.sampled_from(["", "", " AM", " PM", " pm", " am", "AM", "  PM", " Pm"]))
    tail = draw(st.sampled_from(["", "", " trailing", "x", " PM"]))
    date_only = draw(st.booleans()) and draw(st.booleans())
    text = f"{lead}{mo}/{d}/{y}" + ("" if date_only else f"{gap}{h}:{mi}:{s}{marker}") + tail
    return draw(st.one_of(st.just(text), st.just(text), st.sampled_from(["", "junk", "1/2", None])))


@settings(max_examples=6, deadline=None)
@given(st.lists(report_text(), min_size=100, max_size=200))
def test_parser_matches_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", parse_report_timestamp("t").alias("ts"), report_date_part("t").alias("d")).collect()
    for r in rows:
        assert r["ts"] == model_ts(r["t"]), repr(r["t"])
        assert r["d"] == model_date(r["t"]), repr(r["t"])
