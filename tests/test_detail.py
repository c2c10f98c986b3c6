"""Detail normalization and contract conformance on hand-written rows."""

import datetime as dt

from helpers import msg, raw_rows

from relaylens.contract import DETAIL_SCHEMA, RAW_COLUMNS
from relaylens.operators.detail import conform_to_contract, normalize_detail, project_to_target, status_flags


def test_detail_types_and_values(spark):
    row = msg(
        IDENTIFIER="A-1",
        ROW_NUMBER="7",
        ZIPCODE="01234",
        PRESCRIBER_NPI="2345678901",
        FAX_NUMBER="5551234567",
        NUMBER_FAX_PAGES="2.0",
        sent="01/02/2021 03:04:05 PM",
        conf="1/2/2021 15:05:05",
    )
    d = normalize_detail(raw_rows(spark, [row]), "202101020304")
    assert [(f.name, f.dataType) for f in d.schema] == [(f.name, f.dataType) for f in DETAIL_SCHEMA]
    r = d.first()
    assert r.PROV_CMNCT_DTL_ID == "A-1" and r.FL_REF_NBR == 7
    assert r.ZIPCD == "01234"  # text: leading zero kept
    assert r.PRSCr_NPI is None  # beyond INT
    assert r.FAX_NUM == 5551234567 and r.NBR_Fax_PG == 2
    assert r.DT_MSG_SND == dt.datetime(2021, 1, 2, 15, 4, 5)
    assert r.DT_ACPT == dt.datetime(2021, 1, 2, 15, 5, 5)
    assert (r.Fax_STS, r.Fax_ERR_MSG, r.OVALL_STS) == ("", "", "")  # null -> ''
    assert r.FL_RECV_DT == dt.date(2021, 1, 1) and r.WINDOW_ID == "202101020304"


def test_conform_resolves_names_case_insensitively(spark):
    df = spark.createDataFrame([("x", "123", "junk", "L")], "identifier string, Fax_NUMBER string, _c17 string, SRC_LOB string")
    out = conform_to_contract(df)
    assert out.columns == RAW_COLUMNS
    r = out.first()
    assert r["IDENTIFIER"] == "x" and r["FAX_NUMBER"] == "123" and r["SRC_LOB"] == "L"
    assert r["PROGRAM"] is None and r["Sent_Date"] is None


def test_status_flags_and_target_order(spark):
    raw = raw_rows(spark, [msg(direct="Confirmed"), msg(direct="Failed", match="Not Found"), msg(direct=None)])
    flags = [tuple(r) for r in status_flags(raw, keep=["Direct Status"]).collect()]
    assert flags == [
        ("Confirmed", "Successful", None, 1, 1),
        ("Failed", "Failed", 1, 0, 0),
        (None, "Failed", None, 1, 0),
    ]
    d = normalize_detail(raw, "w")
    target = list(reversed(d.columns))
    assert project_to_target(d, target).columns == target


def test_wide_npi_column_keeps_values_beyond_int(spark):
    raw = raw_rows(spark, [msg(PRESCRIBER_NPI="2345678901"), msg(PRESCRIBER_NPI="1234567890")])
    rows = normalize_detail(raw, "w", wide_npi_column="PRSCr_NPI_BIG").select("PRSCr_NPI", "PRSCr_NPI_BIG").collect()
    assert [tuple(r) for r in rows] == [(None, 2345678901), (1234567890, 1234567890)]
