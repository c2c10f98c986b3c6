"""Registered queries over the driver tables and their SQL oracles.

Every query reads ``lineitem``/``orders`` through the ``messages`` adapter (or
``orders`` directly) in full -- no sampling, no row caps -- and returns a
DataFrame. Each has an ANSI SQL twin (DuckDB dialect) that computes the same
rows independently; column names and types are aligned so results can be
compared by value.

Conventions the SQL twins follow so both engines produce identical values:

* a DOUBLE is turned into a DECIMAL through its shortest text form, which is
  how Spark's cast rounds (half up on the decimal digits), see ``_dec``;
* sums are cast back to BIGINT (DuckDB widens them to HUGEINT).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaylens.contract import (
    DETAIL_COLUMN_MAP,
    DETAIL_SCHEMA,
    GEN2_ONLY_COLUMNS,
    GEN1_TRAILING_COLUMN,
    RAW_COLUMNS,
    REPORT_SUFFIX,
)
from relaylens.functions.filename import file_date_from_file_name, is_report_file, lob_from_file_name
from relaylens.functions.timeparse import (
    confirm_seconds,
    effective_send_date,
    elapsed_minutes,
    epoch_seconds,
    parse_report_timestamp,
    report_date_part,
)
from relaylens.operators.alerts import alert_rates, low_rate_alerts, render_alerts
from relaylens.operators.audit import audit_counts
from relaylens.operators.detail import conform_to_contract, normalize_detail, project_to_target, status_flags
from relaylens.operators.summary import (
    daily_attempts,
    daily_stats,
    daily_summary,
    daily_summary_two_branch,
    eligible_messages,
    full_outer_merge,
    phase_metrics,
    summary_from_stats,
)
from relaylens.plans.load_queries import LOADS, MESSY
from relaylens.session import apply_semantic_conf
from relaylens.sources.events import EVENT_MESSAGES_SQL, event_messages
from relaylens.sources.messages import MESSAGES_SQL, load_table, messages
from relaylens.sources.reports import union_report_frames

# Batch id and run date the registered queries stamp on their output.
QUERY_WINDOW_ID = "202101010000"
QUERY_RUN_DATE = "2021-01-01"

# Warehouse column order of the detail table: the three fax columns were added
# later by ALTER TABLE ... ADD, which appends at the end.
WAREHOUSE_LATE_COLUMNS = ["FAX_DT_ACPT", "Fax_DT_MSG_SND", "FAX_NUM"]
WAREHOUSE_DETAIL_ORDER = [
    f.name for f in DETAIL_SCHEMA.fields if f.name not in WAREHOUSE_LATE_COLUMNS
] + WAREHOUSE_LATE_COLUMNS


def _msgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_semantic_conf(spark)
    return messages(spark, sf_dir)


def _c(name: str):
    return F.col(f"`{name}`")


# ---------------------------------------------------------------------------
# Spark queries
# ---------------------------------------------------------------------------


def q_ingest_contract(spark, sf_dir):
    """A report frame with a case-variant name, a trailing unnamed column and a
    column outside the contract, conformed to the 26-column contract."""
    m = _msgs(spark, sf_dir)
    shaped = m.withColumnRenamed("FAX_NUMBER", "Fax_NUMBER").select(
        "*", F.lit("").alias(GEN1_TRAILING_COLUMN), F.lit("x").alias("EXTRA_COLUMN")
    )
    return conform_to_contract(shaped)


def q_union_by_name(spark, sf_dir):
    """Two file generations (the older one lacks the seven fax/overall columns
    and carries an unnamed trailing column), united by name."""
    m = _msgs(spark, sf_dir)
    found = _c("NPI Match Status") == "Found"
    newer = m.where(found)
    older_cols = [c for c in RAW_COLUMNS if c not in GEN2_ONLY_COLUMNS]
    older = m.where(~found).select(*[_c(c) for c in older_cols], F.lit("").alias(GEN1_TRAILING_COLUMN))
    return union_report_frames(spark, [newer, older])


def _file_names(spark, sf_dir) -> DataFrame:
    apply_semantic_conf(spark)
    o = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    key = F.col("o_orderkey")
    dated = F.concat(
        F.lit("RPT_"),
        F.col("o_orderpriority"),
        F.lit("_batch_"),
        F.date_format("o_orderdate", "MMddyyyy"),
        F.lit("_"),
        key.cast("string"),
        F.when(key % 7 == 0, F.lit("_summary.csv")).otherwise(F.lit("_report.csv")),
    )
    undated = F.concat(F.lit("RPT_"), F.col("o_orderpriority"), F.lit("_"), key.cast("string"), F.lit("_report.csv"))
    name = F.when(key % 13 == 0, F.lit("RPT.csv")).when(key % 11 == 0, undated).otherwise(dated)
    return o.select("o_orderkey", name.alias("file_name"))


def q_filename_fields(spark, sf_dir):
    f = _file_names(spark, sf_dir)
    return f.select(
        "o_orderkey",
        "file_name",
        lob_from_file_name("file_name").alias("SRC_LOB"),
        file_date_from_file_name("file_name").alias("Sent_Date"),
    )


def q_filter_suffix(spark, sf_dir):
    f = _file_names(spark, sf_dir)
    return f.where(is_report_file("file_name", REPORT_SUFFIX))


def q_parse_timestamps(spark, sf_dir):
    m = _msgs(spark, sf_dir)
    return m.select(
        "IDENTIFIER",
        parse_report_timestamp(_c("Date Message Sent")).alias("sent_ts"),
        parse_report_timestamp(_c("Date Failed/Confirmed")).alias("confirmed_ts"),
        parse_report_timestamp(_c("FAX_Date Message Sent")).alias("fax_sent_ts"),
        parse_report_timestamp(_c("FAX_Date_Failed/Confirmed")).alias("fax_confirmed_ts"),
    )


def q_effective_date(spark, sf_dir):
    m = _msgs(spark, sf_dir)
    return m.select(
        "IDENTIFIER",
        report_date_part(_c("Date Message Sent")).alias("message_date"),
        effective_send_date(_c("Date Message Sent"), _c("Sent_Date")).alias("Sent_Date"),
    )


def q_confirm_seconds(spark, sf_dir):
    m = _msgs(spark, sf_dir)
    sent = parse_report_timestamp(_c("Date Message Sent"))
    conf = parse_report_timestamp(_c("Date Failed/Confirmed"))
    return m.select(
        "IDENTIFIER",
        epoch_seconds(sent).alias("sent_epoch"),
        epoch_seconds(conf).alias("confirmed_epoch"),
        confirm_seconds(sent, conf).alias("DiffInSeconds"),
    )


def q_status_flags(spark, sf_dir):
    return status_flags(_msgs(spark, sf_dir), keep=["IDENTIFIER", "Direct Status"])


def q_fill_nulls(spark, sf_dir):
    d = normalize_detail(_msgs(spark, sf_dir), QUERY_WINDOW_ID)
    return d.select("PROV_CMNCT_DTL_ID", "Fax_STS", "Fax_ERR_MSG", "OVALL_STS")


def q_detail_normalize(spark, sf_dir):
    return normalize_detail(_msgs(spark, sf_dir), QUERY_WINDOW_ID)


def q_project_to_target(spark, sf_dir):
    detail = normalize_detail(_msgs(spark, sf_dir), QUERY_WINDOW_ID)
    target_schema = T.StructType([DETAIL_SCHEMA[n] for n in WAREHOUSE_DETAIL_ORDER])
    target = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in target_schema.fields])
    return project_to_target(detail, target)


def q_eligible_messages(spark, sf_dir):
    return eligible_messages(_msgs(spark, sf_dir))


def q_daily_attempts(spark, sf_dir):
    return daily_attempts(_msgs(spark, sf_dir))


def q_phase_metrics(spark, sf_dir):
    return phase_metrics(_msgs(spark, sf_dir))


def q_full_outer_merge(spark, sf_dir):
    return full_outer_merge(_msgs(spark, sf_dir))


def q_summary_defaults(spark, sf_dir):
    return summary_from_stats(daily_stats(_msgs(spark, sf_dir)), QUERY_WINDOW_ID, with_default_flag=True)


def q_daily_summary(spark, sf_dir):
    return daily_summary(_msgs(spark, sf_dir), QUERY_WINDOW_ID)


def q_daily_summary_two_branch(spark, sf_dir):
    return daily_summary_two_branch(_msgs(spark, sf_dir), QUERY_WINDOW_ID)


def q_daily_stats(spark, sf_dir):
    return daily_stats(_msgs(spark, sf_dir))


def q_alert_rates(spark, sf_dir):
    return alert_rates(_msgs(spark, sf_dir))


def q_low_rate_alerts(spark, sf_dir):
    return low_rate_alerts(_msgs(spark, sf_dir))


def q_alert_html(spark, sf_dir):
    return render_alerts(low_rate_alerts(_msgs(spark, sf_dir)), QUERY_RUN_DATE)


def q_audit_counts(spark, sf_dir):
    m = _msgs(spark, sf_dir)
    return audit_counts(m, normalize_detail(m, QUERY_WINDOW_ID), daily_summary(m, QUERY_WINDOW_ID), QUERY_WINDOW_ID)


def q_load_elapsed(spark, sf_dir):
    m = _msgs(spark, sf_dir)
    sent = parse_report_timestamp(_c("Date Message Sent"))
    conf = parse_report_timestamp(_c("Date Failed/Confirmed"))
    return m.select(
        "IDENTIFIER",
        elapsed_minutes(sent, conf).alias("elapsed_minutes"),
        (epoch_seconds(conf) - epoch_seconds(sent)).alias("elapsed_seconds"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_semantic_conf(spark)
    return event_messages(spark, sf_dir)


def q_daily_summary_events(spark, sf_dir):
    """The flagship summary over the second input (``events``; no join)."""
    return daily_summary(_events(spark, sf_dir), QUERY_WINDOW_ID)


def q_low_rate_alerts_events(spark, sf_dir):
    return low_rate_alerts(_events(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ingest_contract": q_ingest_contract,
    "union_by_name": q_union_by_name,
    "filename_fields": q_filename_fields,
    "filter_suffix": q_filter_suffix,
    "parse_timestamps": q_parse_timestamps,
    "effective_date": q_effective_date,
    "confirm_seconds": q_confirm_seconds,
    "status_flags": q_status_flags,
    "fill_nulls": q_fill_nulls,
    "detail_normalize": q_detail_normalize,
    "project_to_target": q_project_to_target,
    "eligible_messages": q_eligible_messages,
    "daily_attempts": q_daily_attempts,
    "phase_metrics": q_phase_metrics,
    "full_outer_merge": q_full_outer_merge,
    "summary_defaults": q_summary_defaults,
    "daily_summary": q_daily_summary,
    "daily_summary_two_branch": q_daily_summary_two_branch,
    "daily_stats": q_daily_stats,
    "alert_rates": q_alert_rates,
    "low_rate_alerts": q_low_rate_alerts,
    "alert_html": q_alert_html,
    "audit_counts": q_audit_counts,
    "load_elapsed": q_load_elapsed,
    "daily_summary_events": q_daily_summary_events,
    "low_rate_alerts_events": q_low_rate_alerts_events,
    **MESSY,
    **LOADS,
}
#: Queries that run several jobs over files and tables of their own.
LOAD_QUERIES = set(LOADS)


# ---------------------------------------------------------------------------
# SQL twins (DuckDB dialect)
# ---------------------------------------------------------------------------


def _dec(expr: str, p: int, s: int) -> str:
    """DOUBLE -> DECIMAL(p, s) rounding as Spark does (via the shortest text)."""
    return f"TRY_CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL({p},{s}))"


def _ratio(n: str, d: str) -> str:
    return f"(CAST({n} AS DOUBLE) / CAST(NULLIF({d}, 0) AS DOUBLE))"


def _pct(n: str, d: str, p: int = 22, s: int = 2) -> str:
    return _dec(f"{_ratio(n, d)} * 100", p, s)


def _ts(x: str) -> str:
    return (
        f"(CASE WHEN contains({x}, 'AM') OR contains({x}, 'PM') "
        f"THEN try_strptime({x}, '%m/%d/%Y %I:%M:%S %p') "
        f"ELSE try_strptime({x}, '%m/%d/%Y %H:%M:%S') END)"
    )


def _datepart(x: str) -> str:
    return f"CAST(try_strptime(split_part({x}, ' ', 1), '%m/%d/%Y') AS DATE)"


def _epoch(x: str) -> str:
    return f"CAST(epoch({x}) AS BIGINT)"


def _secs(sent: str, conf: str) -> str:
    diff = f"abs({_epoch(_ts(conf))} - {_epoch(_ts(sent))})"
    return f"(CASE WHEN {diff} > 0 THEN {diff} ELSE CAST(0 AS BIGINT) END)"


SENT = '"Date Message Sent"'
CONF = '"Date Failed/Confirmed"'
ADDR = '"Provider_Directaddress"'
MATCH = '"NPI Match Status"'
DIRECT = '"Direct Status"'
WID = f"'{QUERY_WINDOW_ID}'"

_WITH_M = f"WITH m AS ({MESSAGES_SQL})"
# The same fragments read the second input when ``m`` is the events adapter.
_WITH_E = f"WITH m AS ({EVENT_MESSAGES_SQL})"
_EFF = f"coalesce({_datepart(SENT)}, \"Sent_Date\")"


def _detail_select() -> str:
    conv = {
        "ROW_NUMBER": 'TRY_CAST("ROW_NUMBER" AS INTEGER)',
        "PRESCRIBER_NPI": 'TRY_CAST("PRESCRIBER_NPI" AS INTEGER)',
        "NUMBER_FAX_PAGES": 'TRY_CAST("NUMBER_FAX_PAGES" AS INTEGER)',
        "FAX_NUMBER": 'TRY_CAST("FAX_NUMBER" AS BIGINT)',
        "Date Message Sent": _ts('"Date Message Sent"'),
        "Date Failed/Confirmed": _ts('"Date Failed/Confirmed"'),
        "FAX_Date Message Sent": _ts('"FAX_Date Message Sent"'),
        "FAX_Date_Failed/Confirmed": _ts('"FAX_Date_Failed/Confirmed"'),
        "FAX_STATUS": "coalesce(\"FAX_STATUS\", '')",
        "FAX_ERROR_MESSAGES": "coalesce(\"FAX_ERROR_MESSAGES\", '')",
        "OVERALL_STATUS": "coalesce(\"OVERALL_STATUS\", '')",
    }
    parts = [f'{conv.get(src, chr(34) + src + chr(34))} AS "{dst}"' for src, dst in DETAIL_COLUMN_MAP]
    parts.append(f'{WID} AS "WINDOW_ID"')
    return ",\n  ".join(parts)


_DETAIL_CTE = f"d AS (SELECT {_detail_select()} FROM m)"

_TOTALS_CTE = f"""t AS (
  SELECT "SRC_LOB" AS lob_t, {_EFF} AS d_t,
         count(DISTINCT {ADDR}) AS reached, count("SRC_LOB") AS attempts
  FROM m GROUP BY 1, 2)"""

_PHASE_CTE = f"""ph AS (
  SELECT "SRC_LOB" AS lob, {_datepart(SENT)} AS d,
         CAST(sum({_secs(SENT, CONF)}) AS BIGINT) AS total_diff,
         count("SRC_LOB") AS total_count,
         CAST(coalesce(sum(CASE WHEN {DIRECT} = 'Failed' THEN 1 END), 0) AS BIGINT) AS failed
  FROM m
  WHERE {MATCH} = 'Found' AND {ADDR} IS NOT NULL AND {SENT} IS NOT NULL
  GROUP BY 1, 2)"""

_MERGE_CTE = f"""p2 AS (
  SELECT lob, d, CAST(total_count AS INTEGER) AS wth,
         CAST(total_count - failed AS INTEGER) AS snd,
         {_pct('CAST(total_count - failed AS INTEGER)', 'CAST(total_count AS INTEGER)')} AS suc,
         {_dec(_ratio('total_diff', 'total_count'), 22, 2)} AS avg_t
  FROM ph),
j AS (
  SELECT coalesce(p2.lob, t.lob_t) AS "SRC_LOB", coalesce(p2.d, t.d_t) AS "DT_MSG_SND",
         CAST(t.attempts AS INTEGER) AS "NBR_OF_MSG_ATMPT", p2.wth AS "NBR_OF_MSG_WTH_NPI",
         CAST(t.reached AS INTEGER) AS "NBR_OF_PROV_RCH", p2.snd AS "NBR_OF_MSG_SND",
         p2.suc AS "SUC_RT", p2.avg_t AS "AVG_TM_TO_CNFM"
  FROM p2 FULL OUTER JOIN t ON p2.lob = t.lob_t AND p2.d = t.d_t)"""

_SUMMARY_CTE = f"""s AS (
  SELECT "SRC_LOB", "DT_MSG_SND", "NBR_OF_MSG_ATMPT",
         coalesce("NBR_OF_MSG_WTH_NPI", "NBR_OF_PROV_RCH") AS "NBR_OF_MSG_WTH_NPI",
         "NBR_OF_PROV_RCH",
         coalesce("NBR_OF_MSG_SND", 0) AS "NBR_OF_MSG_SND",
         coalesce("SUC_RT", {_pct('coalesce("NBR_OF_MSG_WTH_NPI", "NBR_OF_PROV_RCH")', '"NBR_OF_MSG_ATMPT"')}) AS "SUC_RT",
         coalesce("AVG_TM_TO_CNFM", CAST(0 AS DECIMAL(22,2))) AS "AVG_TM_TO_CNFM",
         {WID} AS "WINDOW_ID",
         ("NBR_OF_MSG_SND" IS NULL) AS default_path
  FROM j WHERE "SRC_LOB" IS NOT NULL AND "DT_MSG_SND" IS NOT NULL)"""

_SUMMARY_COLS = (
    '"SRC_LOB", "DT_MSG_SND", "NBR_OF_MSG_ATMPT", "NBR_OF_MSG_WTH_NPI", "NBR_OF_PROV_RCH", '
    '"NBR_OF_MSG_SND", "SUC_RT", "AVG_TM_TO_CNFM", "WINDOW_ID"'
)

_RATES_CTE = f"""r AS (
  SELECT "SRC_LOB", "Sent_Date", messages_attempted, messages_matched, messages_successful,
         {_pct('messages_matched', 'messages_attempted', 5, 2)} AS match_pct,
         {_pct('messages_successful', 'messages_matched', 5, 2)} AS success_pct
  FROM (
    SELECT "SRC_LOB", {_EFF} AS "Sent_Date",
           count(*) AS messages_attempted,
           count(*) FILTER (WHERE {MATCH} = 'Found') AS messages_matched,
           count(*) FILTER (WHERE {DIRECT} = 'Confirmed') AS messages_successful
    FROM m GROUP BY 1, 2))"""

_ALERTS_CTE = """a AS (
  SELECT "SRC_LOB", "Sent_Date", messages_attempted, messages_matched, messages_successful,
         match_pct, coalesce(success_pct, CAST(0 AS DECIMAL(5,2))) AS success_pct
  FROM r WHERE messages_attempted > 10 AND (match_pct < 50 OR success_pct < 80))"""


def _html_cell(x: str) -> str:
    esc = f"replace(replace(replace(CAST({x} AS VARCHAR), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    return f"'<td align=''center''>' || coalesce({esc}, 'null') || '</td>'"


def _alert_html_sql() -> str:
    from relaylens.contract import ALERT_COLUMNS, ALERT_TITLES
    from relaylens.functions.text import html_header
    from relaylens.operators.alerts import ALERT_CLOSING, ALERT_INTRO, ALERT_OPENING

    row = "'<tr>' || " + " || ".join(_html_cell(f'"{c}"') for c in ALERT_COLUMNS) + " || '</tr>'"
    opening = (ALERT_OPENING + ALERT_INTRO.format(run_date=QUERY_RUN_DATE)).replace("'", "''")
    header = html_header(ALERT_TITLES).replace("'", "''")
    return f"""{_WITH_M}, {_RATES_CTE}, {_ALERTS_CTE},
rows AS (SELECT {row} AS tr FROM a)
SELECT '{QUERY_RUN_DATE}' AS run_date, count(*) AS alert_count,
       '{opening}' || '{header}' || coalesce(string_agg(tr, '' ORDER BY tr), '') || '</table>' || '{ALERT_CLOSING}' AS html
FROM rows HAVING count(*) > 0"""


def _file_names_sql() -> str:
    dated = (
        "'RPT_' || o_orderpriority || '_batch_' || strftime(o_orderdate, '%m%d%Y') || '_' || CAST(o_orderkey AS VARCHAR)"
        " || CASE WHEN o_orderkey % 7 = 0 THEN '_summary.csv' ELSE '_report.csv' END"
    )
    undated = "'RPT_' || o_orderpriority || '_' || CAST(o_orderkey AS VARCHAR) || '_report.csv'"
    return (
        "f AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'RPT.csv' "
        f"WHEN o_orderkey % 11 = 0 THEN {undated} ELSE {dated} END AS file_name FROM orders)"
    )


def _raw_cols_sql(cols: list[str]) -> str:
    return ", ".join(f'"{c}"' for c in cols)


def oracle_sql() -> dict[str, str]:
    raw_all = _raw_cols_sql(RAW_COLUMNS)
    older = [c for c in RAW_COLUMNS if c not in GEN2_ONLY_COLUMNS]
    warehouse_cols = ", ".join(f'"{c}"' for c in WAREHOUSE_DETAIL_ORDER)
    sql = {
        "ingest_contract": f"{_WITH_M} SELECT {raw_all} FROM m",
        "union_by_name": (
            f"{_WITH_M} SELECT {raw_all} FROM m WHERE {MATCH} = 'Found' "
            f"UNION ALL BY NAME SELECT {_raw_cols_sql(older)} FROM m WHERE NOT ({MATCH} = 'Found')"
        ),
        "filename_fields": (
            f"WITH {_file_names_sql()} SELECT o_orderkey, file_name, "
            "string_split(file_name, '_')[2] AS \"SRC_LOB\", "
            "CAST(try_strptime(string_split(file_name, '_')[-3], '%m%d%Y') AS DATE) AS \"Sent_Date\" FROM f"
        ),
        "filter_suffix": f"WITH {_file_names_sql()} SELECT o_orderkey, file_name FROM f WHERE ends_with(file_name, 'report.csv')",
        "parse_timestamps": (
            f"{_WITH_M} SELECT \"IDENTIFIER\", {_ts(SENT)} AS sent_ts, {_ts(CONF)} AS confirmed_ts, "
            f"{_ts(chr(34) + 'FAX_Date Message Sent' + chr(34))} AS fax_sent_ts, "
            f"{_ts(chr(34) + 'FAX_Date_Failed/Confirmed' + chr(34))} AS fax_confirmed_ts FROM m"
        ),
        "effective_date": f"{_WITH_M} SELECT \"IDENTIFIER\", {_datepart(SENT)} AS message_date, {_EFF} AS \"Sent_Date\" FROM m",
        "confirm_seconds": (
            f"{_WITH_M} SELECT \"IDENTIFIER\", {_epoch(_ts(SENT))} AS sent_epoch, "
            f"{_epoch(_ts(CONF))} AS confirmed_epoch, {_secs(SENT, CONF)} AS \"DiffInSeconds\" FROM m"
        ),
        "status_flags": (
            f"{_WITH_M} SELECT \"IDENTIFIER\", {DIRECT}, "
            f"CASE WHEN {DIRECT} = 'Confirmed' THEN 'Successful' ELSE 'Failed' END AS \"OverallStatus\", "
            f"CASE WHEN {DIRECT} = 'Failed' THEN 1 END AS failed_flag, "
            f"CASE WHEN {MATCH} = 'Found' THEN 1 ELSE 0 END AS matched_flag, "
            f"CASE WHEN {DIRECT} = 'Confirmed' THEN 1 ELSE 0 END AS success_flag FROM m"
        ),
        "fill_nulls": f"{_WITH_M}, {_DETAIL_CTE} SELECT \"PROV_CMNCT_DTL_ID\", \"Fax_STS\", \"Fax_ERR_MSG\", \"OVALL_STS\" FROM d",
        "detail_normalize": f"{_WITH_M}, {_DETAIL_CTE} SELECT * FROM d",
        "project_to_target": f"{_WITH_M}, {_DETAIL_CTE} SELECT {warehouse_cols} FROM d",
        "eligible_messages": (
            f"{_WITH_M} SELECT \"SRC_LOB\", {_datepart(SENT)} AS \"Sent_Date\", {SENT}, {CONF}, {DIRECT}, \"Failure Reason\" "
            f"FROM m WHERE {MATCH} = 'Found' AND {ADDR} IS NOT NULL AND {SENT} IS NOT NULL"
        ),
        "daily_attempts": (
            f"{_WITH_M}, {_TOTALS_CTE} SELECT lob_t AS \"SRC_LOB\", d_t AS \"Sent_Date\", "
            "reached AS \"NBR_OF_PROV_RCH\", attempts AS \"NBR_OF_MSG_ATMPT\" FROM t"
        ),
        "phase_metrics": (
            f"{_WITH_M}, {_PHASE_CTE} SELECT lob AS \"SRC_LOB\", d AS \"Sent_Date\", total_diff AS \"Total_diff\", "
            f"total_count AS \"Total_count\", failed AS \"Failed\", "
            f"{_dec(_ratio('total_diff', 'total_count'), 22, 2)} AS \"AVG_TM_TO_CNFM\" FROM ph"
        ),
        "full_outer_merge": f"{_WITH_M}, {_TOTALS_CTE}, {_PHASE_CTE}, {_MERGE_CTE} SELECT * FROM j",
        "summary_defaults": f"{_WITH_M}, {_TOTALS_CTE}, {_PHASE_CTE}, {_MERGE_CTE}, {_SUMMARY_CTE} SELECT * FROM s",
        "daily_summary": f"{_WITH_M}, {_TOTALS_CTE}, {_PHASE_CTE}, {_MERGE_CTE}, {_SUMMARY_CTE} SELECT {_SUMMARY_COLS} FROM s",
        "daily_summary_two_branch": f"{_WITH_M}, {_TOTALS_CTE}, {_PHASE_CTE}, {_MERGE_CTE}, {_SUMMARY_CTE} SELECT {_SUMMARY_COLS} FROM s",
        "daily_stats": _daily_stats_sql(),
        "alert_rates": f"{_WITH_M}, {_RATES_CTE} SELECT * FROM r",
        "low_rate_alerts": f"{_WITH_M}, {_RATES_CTE}, {_ALERTS_CTE} SELECT * FROM a",
        "alert_html": _alert_html_sql(),
        "audit_counts": _audit_counts_sql(),
        "load_elapsed": (
            f"{_WITH_M} SELECT \"IDENTIFIER\", "
            f"({_epoch(_ts(CONF))} - {_epoch(_ts(SENT))}) // 60 AS elapsed_minutes, "
            f"({_epoch(_ts(CONF))} - {_epoch(_ts(SENT))}) AS elapsed_seconds FROM m"
        ),
        "daily_summary_events": (
            f"{_WITH_E}, {_TOTALS_CTE}, {_PHASE_CTE}, {_MERGE_CTE}, {_SUMMARY_CTE} SELECT {_SUMMARY_COLS} FROM s"
        ),
        "low_rate_alerts_events": f"{_WITH_E}, {_RATES_CTE}, {_ALERTS_CTE} SELECT * FROM a",
    }
    from relaylens.plans import load_sql

    return sql | load_sql.oracle_sql()


def _daily_stats_sql() -> str:
    dp = _datepart(SENT)
    elig = f"({MATCH} = 'Found' AND {ADDR} IS NOT NULL AND {SENT} IS NOT NULL AND {dp} IS NOT NULL)"
    return f"""{_WITH_M}
SELECT "SRC_LOB", {_EFF} AS "Sent_Date",
       count(*) AS "rows",
       count("SRC_LOB") AS attempts,
       count(DISTINCT {ADDR}) AS reached,
       count(*) FILTER (WHERE {MATCH} = 'Found') AS matched,
       count(*) FILTER (WHERE {DIRECT} = 'Confirmed') AS successful,
       count(*) FILTER (WHERE {elig}) AS elig_count,
       count(*) FILTER (WHERE {elig} AND {DIRECT} = 'Failed') AS elig_failed,
       CAST(sum(CASE WHEN {elig} THEN {_secs(SENT, CONF)} END) AS BIGINT) AS elig_secs
FROM m GROUP BY 1, 2"""


def _audit_counts_sql() -> str:
    return f"""{_WITH_M}, {_TOTALS_CTE}, {_PHASE_CTE}, {_MERGE_CTE}, {_SUMMARY_CTE},
c AS (SELECT (SELECT count(*) FROM m) AS src, (SELECT count(*) FROM s) AS summ)
SELECT 'DetailTable' AS "TableName", {WID} AS "WindowID", src AS source_count, src AS delta_count,
       src AS synapse_count, 'PASSED' AS count_validation, CAST(27 AS BIGINT) AS no_columns, src AS window_inserts FROM c
UNION ALL
SELECT 'SummaryTable', {WID}, src, summ, summ, 'PASSED', CAST(9 AS BIGINT), summ FROM c"""
