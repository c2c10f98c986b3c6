"""Data contract: input layout, output tables, fixed names.

Everything in this module is a fixed value that a user switching from the
original pipeline relies on (column names of the report files and of the lake
tables, status words, table names). They are listed in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES -- must equal the original pipeline for equal results.
# ---------------------------------------------------------------------------

# Columns of a delivery report file, current (second) generation, in order.
# The first generation has the first 17 plus an unnamed trailing column.
REPORT_COLUMNS = [
    "IDENTIFIER",
    "ROW_NUMBER",
    "PROGRAM",
    "PROVIDER_FIRST_NAME",
    "PROVIDER_LAST_NAME",
    "ADDRESS1",
    "ADDRESS2",
    "CITY",
    "STATE",
    "ZIPCODE",
    "PRESCRIBER_NPI",
    "NPI Match Status",
    "Provider_Directaddress",
    "Direct Status",
    "Failure Reason",
    "Date Message Sent",
    "Date Failed/Confirmed",
    "FAX_NUMBER",
    "FAX_STATUS",
    "FAX_ERROR_MESSAGES",
    "NUMBER_FAX_PAGES",
    "FAX_Date Message Sent",
    "FAX_Date_Failed/Confirmed",
    "OVERALL_STATUS",
]

# The seven columns only the second generation carries.
GEN2_ONLY_COLUMNS = REPORT_COLUMNS[17:]
GEN1_COLUMNS = REPORT_COLUMNS[:17]
# Name Spark gives the unnamed trailing column of a first-generation file.
GEN1_TRAILING_COLUMN = "_c17"

# Columns derived from the file name.
LOB_COLUMN = "SRC_LOB"
FILE_DATE_COLUMN = "Sent_Date"
RAW_COLUMNS = REPORT_COLUMNS + [LOB_COLUMN, FILE_DATE_COLUMN]

# Report file names end with this text.
REPORT_SUFFIX = "report.csv"
REPORT_GLOB = "*report.csv"
# File name tokens are separated by "_": token 2 is the line of business,
# token 3 from the end is the file date in this pattern.
FILE_NAME_SEPARATOR = "_"
FILE_DATE_PATTERN = "MMddyyyy"

# Status words the pipeline tests for (case-sensitive).
MATCH_FOUND = "Found"
STATUS_CONFIRMED = "Confirmed"
STATUS_FAILED = "Failed"
OVERALL_SUCCESSFUL = "Successful"
OVERALL_FAILED = "Failed"

# Batch id format (minute resolution).
WINDOW_ID_PATTERN = "yyyyMMddHHmm"
WINDOW_ID_COLUMN = "WINDOW_ID"

# Report column -> detail column, in detail-table order (first 26 columns;
# WINDOW_ID is the 27th).
DETAIL_COLUMN_MAP = [
    ("IDENTIFIER", "PROV_CMNCT_DTL_ID"),
    ("ROW_NUMBER", "FL_REF_NBR"),
    ("PROGRAM", "PGM_DRG_NM"),
    ("PROVIDER_FIRST_NAME", "PROV_FST_NM"),
    ("PROVIDER_LAST_NAME", "PROV_LST_NM"),
    ("ADDRESS1", "ADR1"),
    ("ADDRESS2", "ADR2"),
    ("CITY", "CTY"),
    ("STATE", "ST"),
    ("ZIPCODE", "ZIPCD"),
    ("PRESCRIBER_NPI", "PRSCr_NPI"),
    ("NPI Match Status", "NPI_MTCH_STS"),
    ("Provider_Directaddress", "PROV_DIR_ADR"),
    ("Direct Status", "DIR_STS"),
    ("Failure Reason", "FAIL_RSN"),
    ("Date Message Sent", "DT_MSG_SND"),
    ("Date Failed/Confirmed", "DT_ACPT"),
    ("FAX_NUMBER", "FAX_NUM"),
    ("FAX_STATUS", "Fax_STS"),
    ("FAX_ERROR_MESSAGES", "Fax_ERR_MSG"),
    ("NUMBER_FAX_PAGES", "NBR_Fax_PG"),
    ("FAX_Date Message Sent", "Fax_DT_MSG_SND"),
    ("FAX_Date_Failed/Confirmed", "FAX_DT_ACPT"),
    ("OVERALL_STATUS", "OVALL_STS"),
    ("SRC_LOB", "SRC_LOB"),
    ("Sent_Date", "FL_RECV_DT"),
]

# Detail columns whose null becomes an empty string.
DETAIL_FILL_EMPTY = ["Fax_STS", "Fax_ERR_MSG", "OVALL_STS"]

DETAIL_SCHEMA = T.StructType(
    [
        T.StructField("PROV_CMNCT_DTL_ID", T.StringType()),
        T.StructField("FL_REF_NBR", T.IntegerType()),
        T.StructField("PGM_DRG_NM", T.StringType()),
        T.StructField("PROV_FST_NM", T.StringType()),
        T.StructField("PROV_LST_NM", T.StringType()),
        T.StructField("ADR1", T.StringType()),
        T.StructField("ADR2", T.StringType()),
        T.StructField("CTY", T.StringType()),
        T.StructField("ST", T.StringType()),
        T.StructField("ZIPCD", T.StringType()),
        T.StructField("PRSCr_NPI", T.IntegerType()),
        T.StructField("NPI_MTCH_STS", T.StringType()),
        T.StructField("PROV_DIR_ADR", T.StringType()),
        T.StructField("DIR_STS", T.StringType()),
        T.StructField("FAIL_RSN", T.StringType()),
        T.StructField("DT_MSG_SND", T.TimestampType()),
        T.StructField("DT_ACPT", T.TimestampType()),
        T.StructField("FAX_NUM", T.LongType()),
        T.StructField("Fax_STS", T.StringType()),
        T.StructField("Fax_ERR_MSG", T.StringType()),
        T.StructField("NBR_Fax_PG", T.IntegerType()),
        T.StructField("Fax_DT_MSG_SND", T.TimestampType()),
        T.StructField("FAX_DT_ACPT", T.TimestampType()),
        T.StructField("OVALL_STS", T.StringType()),
        T.StructField("SRC_LOB", T.StringType()),
        T.StructField("FL_RECV_DT", T.DateType()),
        T.StructField("WINDOW_ID", T.StringType()),
    ]
)

SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("SRC_LOB", T.StringType()),
        T.StructField("DT_MSG_SND", T.DateType()),
        T.StructField("NBR_OF_MSG_ATMPT", T.IntegerType()),
        T.StructField("NBR_OF_MSG_WTH_NPI", T.IntegerType()),
        T.StructField("NBR_OF_PROV_RCH", T.IntegerType()),
        T.StructField("NBR_OF_MSG_SND", T.IntegerType()),
        T.StructField("SUC_RT", T.DecimalType(22, 2)),
        T.StructField("AVG_TM_TO_CNFM", T.DecimalType(22, 2)),
        T.StructField("WINDOW_ID", T.StringType()),
    ]
)

# Rows that a load refused (our own table): where they stood and why.
REJECT_TABLE = "RejectTable"
REJECT_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("line_no", T.LongType()),
        T.StructField("reason", T.StringType()),
        T.StructField("line", T.StringType()),
        T.StructField("WINDOW_ID", T.StringType()),
    ]
)

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("TableName", T.StringType(), False),
        T.StructField("WindowID", T.StringType(), False),
        T.StructField("source_count", T.LongType()),
        T.StructField("delta_count", T.LongType()),
        T.StructField("synapse_count", T.LongType()),
        T.StructField("count_validation", T.StringType()),
        T.StructField("no_columns", T.LongType()),
        T.StructField("window_inserts", T.LongType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("elapsed", T.LongType()),
        T.StructField("src_to_delta", T.LongType()),
        T.StructField("src_to_synapse", T.LongType()),
        T.StructField("restore_version", T.LongType()),
    ]
)

# Owner reference table: created, never read or written by the pipeline.
REFERENCE_SCHEMA = T.StructType(
    [
        T.StructField("SRC_LOB", T.StringType()),
        T.StructField("BUS_OWNR_NM", T.StringType()),
        T.StructField("BUS_OWNR_EMAIL", T.StringType()),
        T.StructField("NM_OF_LOB", T.StringType()),
        T.StructField("TECH_OWNR_NM", T.StringType()),
        T.StructField("TECH_OWNR_EMAIL", T.StringType()),
        T.StructField("RMRK", T.StringType()),
    ]
)

# Lake table names and the audit values that name them.
DETAIL_TABLE = "DetailTable"
SUMMARY_TABLE = "SummaryTable"
AUDIT_TABLE = "DATA_LOAD"
REFERENCE_TABLE = "ReferenceTable"
COUNT_PASSED = "PASSED"
COUNT_FAILED = "FAILED"

# Alert thresholds: attempts must exceed the floor, and the match rate or the
# success rate must fall below its cutoff.
ALERT_MIN_ATTEMPTS = 10
ALERT_MIN_MATCH_PCT = 50
ALERT_MIN_SUCCESS_PCT = 80

# Alert table column titles, in order.
ALERT_TITLES = [
    "SRC_LOB",
    "Sent_Date",
    "Messages Attempted",
    "Messages with NPI-DM address match",
    "Messages Successful",
    "Match %",
    "Success % of NPI-matches",
]

# ---------------------------------------------------------------------------
# End of fixed values.
# ---------------------------------------------------------------------------

# Snake-case names of the alert columns (what our DataFrames carry).
ALERT_COLUMNS = [
    "SRC_LOB",
    "Sent_Date",
    "messages_attempted",
    "messages_matched",
    "messages_successful",
    "match_pct",
    "success_pct",
]

# The report contract as read: every field is text (the reader does not infer
# types; casts happen once, in the detail step).
RAW_TEXT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in REPORT_COLUMNS]
    + [
        T.StructField(LOB_COLUMN, T.StringType()),
        T.StructField(FILE_DATE_COLUMN, T.DateType()),
    ]
)

def schema_ddl(schema: T.StructType) -> str:
    parts = []
    for f in schema.fields:
        null = "" if f.nullable else " NOT NULL"
        parts.append(f"`{f.name}` {f.dataType.simpleString()}{null}")
    return ", ".join(parts)
