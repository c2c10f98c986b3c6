"""SQL twins (DuckDB dialect) of ``plans.load_queries``.

``m`` is what the files hold: the messages with a line of business, without the
newer columns where the file is of the older generation; or the messages with messy
texts, each brought to one canonical text by an independent reading (regular
expressions, then a cast of an ISO text).
"""

from __future__ import annotations

from relaylens.contract import GEN2_ONLY_COLUMNS, RAW_COLUMNS
from relaylens.plans import registry as R
from relaylens.sources.messages import MESSAGES_SQL

FILE_NO = "(year(\"Sent_Date\") * 12 + month(\"Sent_Date\") + length(\"SRC_LOB\") * 7)"
NAME = "('ACME_' || \"SRC_LOB\" || '_daily_' || strftime(\"Sent_Date\", '%m%d%Y') || '_120000_report.csv')"
EMPTY = "'ACME_NONE_daily_01011999_120000_report.csv'"


def _from_files() -> str:
    cols = ", ".join(f'CASE WHEN {FILE_NO} % 5 = 0 THEN NULL ELSE "{c}" END AS "{c}"' for c in GEN2_ONLY_COLUMNS)
    return f"WITH m0 AS ({MESSAGES_SQL}), m AS (SELECT * REPLACE ({cols}) FROM m0 WHERE \"SRC_LOB\" IS NOT NULL)"


def _audit() -> str:
    def part(rest: int) -> str:
        return f"""SELECT count(*) AS n, count(*) FILTER (WHERE "Direct Status" = 'Failed') AS failed,
       count(DISTINCT ("SRC_LOB", {R._EFF})) FILTER (WHERE {R._EFF} IS NOT NULL) AS s FROM m WHERE {FILE_NO} % 2 = {rest}"""

    def row(table: str, window: str, source: str, lake: str, wh: str, columns: int, inserts: str, version: int) -> str:
        return f"""SELECT '{table}' AS "TableName", '{window}' AS "WindowID", {source} AS source_count, {lake} AS delta_count, {wh} AS synapse_count,
       CASE WHEN {lake} = {wh} THEN 'PASSED' ELSE 'FAILED' END AS count_validation, CAST({columns} AS BIGINT) AS no_columns,
       {inserts} AS window_inserts, CAST({version} AS BIGINT) AS restore_version FROM c"""

    rows = [
        row("DetailTable", "202101010000", "n0", "n0", "n0", 27, "n0", 1),
        row("SummaryTable", "202101010000", "n0", "s0", "s0", 9, "s0", 1),
        row("DetailTable", "202101020000", "n1", "n0 + n1", "n0 + n1 + failed0", 27, "n1", 2),
        row("SummaryTable", "202101020000", "n1", "s0 + s1", "s0 + s1", 9, "s1", 2),
    ]
    return f"""{_from_files()}, a AS ({part(0)}), b AS ({part(1)}),
c AS (SELECT a.n AS n0, a.s AS s0, a.failed AS failed0, b.n AS n1, b.s AS s1 FROM a, b)
{" UNION ALL ".join(rows)}"""


def _recent() -> str:
    return f"""{R._WITH_M},
l AS (
  SELECT CAST(month("Sent_Date") % 6 AS BIGINT) AS k, count(*) AS n,
         count(DISTINCT ("SRC_LOB", {R._EFF})) FILTER (WHERE "SRC_LOB" IS NOT NULL AND {R._EFF} IS NOT NULL) AS s
  FROM m GROUP BY 1),
w AS (
  SELECT k, '2021010' || (k + 1) || '0000' AS "WindowID", n, s, CAST(sum(n) OVER (ORDER BY k) AS BIGINT) AS all_n, CAST(sum(s) OVER (ORDER BY k) AS BIGINT) AS all_s FROM l),
a AS (
  SELECT 'DetailTable' AS "TableName", "WindowID", n AS source_count, all_n AS delta_count, CAST(NULL AS BIGINT) AS synapse_count,
         CAST(NULL AS VARCHAR) AS count_validation, CAST(27 AS BIGINT) AS no_columns, n AS window_inserts, k + 1 AS restore_version FROM w
  UNION ALL SELECT 'SummaryTable', "WindowID", n, all_s, NULL, NULL, 9, s, k + 1 FROM w)
SELECT * FROM a ORDER BY "WindowID" DESC, "TableName" LIMIT 10"""


def _overlaps() -> str:
    loads = ['CAST("ROW_NUMBER" AS INT) % 2 = 0', 'CAST("ROW_NUMBER" AS INT) % 3 = 0', "true"]
    union = " UNION ALL ".join(f"SELECT * FROM m0 WHERE {w}" for w in loads)
    return R._daily_stats_sql().replace(R._WITH_M, f"WITH m0 AS ({MESSAGES_SQL}), m AS ({union})")


def _quarantine() -> str:
    checks = [
        f"CASE WHEN {FILE_NO} % 7 = 3 THEN 'the file has no column CITY' END",
        "CASE WHEN \"Provider_Directaddress\" IS NULL THEN 'Provider_Directaddress is missing' END",
        "CASE WHEN \"Date Message Sent\" IS NULL THEN 'Date Message Sent is missing' END",
    ]
    return f"""{_from_files()}, v AS (SELECT "SRC_LOB", concat_ws('; ', {', '.join(checks)}) AS why FROM m)
SELECT CASE WHEN why = '' THEN 'accepted' ELSE why END AS verdict, "SRC_LOB", count(*) AS n_rows FROM v GROUP BY ALL"""


def _alert_parts() -> str:
    from relaylens.contract import ALERT_COLUMNS, ALERT_TITLES
    from relaylens.functions.text import html_header
    from relaylens.operators.alerts import ALERT_CLOSING, ALERT_INTRO, ALERT_OPENING

    row = "'<tr>' || " + " || ".join(R._html_cell(f'"{c}"') for c in ALERT_COLUMNS) + " || '</tr>'"
    first = (ALERT_OPENING + ALERT_INTRO.format(run_date=R.QUERY_RUN_DATE) + html_header(ALERT_TITLES)).replace("'", "''")
    return f"""{R._WITH_M}, {R._RATES_CTE}, {R._ALERTS_CTE}
SELECT {row} AS line FROM a
UNION ALL SELECT '{first}' FROM (SELECT 1 FROM a LIMIT 1)
UNION ALL SELECT '</table>{ALERT_CLOSING}' FROM (SELECT 1 FROM a LIMIT 1)"""


def _archive() -> str:
    return f"""{_from_files()}, f AS (SELECT DISTINCT {NAME} AS file_name FROM m UNION ALL SELECT {EMPTY})
SELECT CAST(run AS INTEGER) AS run, file_name, file_name AS archived_as, CASE WHEN run = 1 THEN 'moved' ELSE 'moved before' END AS outcome
FROM f, range(1, 3) AS r(run)"""


# ---- messy texts -------------------------------------------------------------

KIND = """((CAST(split_part("IDENTIFIER", '-', 3) AS BIGINT) // 2 + CAST("ROW_NUMBER" AS BIGINT)) % 16)"""


def _messy_text(t: str) -> str:
    made = [
        f"lower({t})",
        f"regexp_replace({t}, '\\b0', '', 'g')",
        f"' ' || {t}",
        f"replace({t}, ' ', '  ')",
        f"{t} || ' trailing'",
        f"split_part({t}, ' ', 1)",
        f"replace({t}, '/', '-')",
        f"'13/40' || substr({t}, 6)",
        f"substr({t}, 1, 11) || '25:61:61 PM'",
        f"substr({t}, 1, 10) || 'abc'",
        "'junk'",
        f"substr({t}, 1, 11) || '00:10:00 AM'",
    ]
    cases = " ".join(f"WHEN {KIND} = {i} THEN {e}" for i, e in enumerate(made))
    return f"(CASE {cases} ELSE {t} END)"


def _canonical(x: str) -> str:
    """One text for each reading: a 24-hour time (after a blank if the text starts with one), a date, or junk."""
    date = r"^\s*(\d{1,2})/(\d{1,2})/(\d{1,5})"
    time = date + r" \s*(\d{1,2}):(\d{1,2}):(\d{1,2})"

    def group(pattern: str, i: int) -> str:
        return f"regexp_extract({x}, '{pattern}', {i})"

    def iso_date(pattern: str) -> str:
        return f"lpad({group(pattern, 3)}, 4, '0') || '-' || lpad({group(pattern, 1)}, 2, '0') || '-' || lpad({group(pattern, 2)}, 2, '0')"

    def iso(pattern: str, hour: str) -> str:
        return f"TRY_CAST({iso_date(pattern)} || ' ' || lpad({hour}, 2, '0') || ':' || lpad({group(pattern, 5)}, 2, '0') || ':' || lpad({group(pattern, 6)}, 2, '0') AS TIMESTAMP)"

    half = time + r"\s+([AaPp][Mm])"
    hour = f"TRY_CAST({group(half, 4)} AS INTEGER)"
    twelve = f"(CASE WHEN {hour} BETWEEN 1 AND 12 THEN {iso(half, f'CAST({hour} % 12 + CASE WHEN upper({group(half, 7)}) = {chr(39)}PM{chr(39)} THEN 12 ELSE 0 END AS VARCHAR)')} END)"
    ts = f"(CASE WHEN contains({x}, 'AM') OR contains({x}, 'PM') THEN {twelve} ELSE {iso(time, group(time, 4))} END)"
    day = f"TRY_CAST({iso_date(date)} AS DATE)"
    return (
        f"(CASE WHEN {x} IS NULL THEN NULL WHEN {ts} IS NOT NULL THEN (CASE WHEN starts_with({x}, ' ') THEN ' ' ELSE '' END) || strftime({ts}, '%m/%d/%Y %H:%M:%S') "
        f"WHEN {day} IS NOT NULL AND NOT starts_with({x}, ' ') THEN strftime({day}, '%m/%d/%Y') ELSE 'junk' END)"
    )


def _from_messy() -> str:
    times = ["Date Message Sent", "Date Failed/Confirmed", "FAX_Date Message Sent", "FAX_Date_Failed/Confirmed"]
    dirty = ", ".join(f'{_messy_text(chr(34) + c + chr(34))} AS "{c}"' for c in times)
    number = f"CASE {KIND} WHEN 1 THEN 'x' WHEN 3 THEN 'x' ELSE \"ROW_NUMBER\" END AS \"ROW_NUMBER\""
    day = f'CASE WHEN {KIND} = 12 THEN NULL ELSE "Sent_Date" END AS "Sent_Date"'
    clean = ", ".join(f'{_canonical(chr(34) + c + chr(34))} AS "{c}"' for c in times)
    return f"WITH m0 AS ({MESSAGES_SQL}), m1 AS (SELECT * REPLACE ({dirty}, {number}, {day}) FROM m0), m AS (SELECT * REPLACE ({clean}) FROM m1)"


def oracle_sql() -> dict[str, str]:
    raw = ", ".join(f'"{c}"' for c in RAW_COLUMNS)
    files, dirty = _from_files(), _from_messy()
    merged = f"{R._TOTALS_CTE}, {R._PHASE_CTE}, {R._MERGE_CTE}, {R._SUMMARY_CTE} SELECT {R._SUMMARY_COLS} FROM s"
    return {
        "inbox_rows": f"{files} SELECT {raw} FROM m",
        "load_detail": f"{files}, {R._DETAIL_CTE} SELECT * FROM d",
        "load_audit": _audit(),
        "audit_recent": _recent(),
        "slices_summary": f"{files}, {merged}",
        "slices_alerts": f"{files}, {R._RATES_CTE}, {R._ALERTS_CTE} SELECT * FROM a",
        "distinct_across_loads": _overlaps(),
        "quarantine_rows": _quarantine(),
        "alert_parts": _alert_parts(),
        "archive_moves": _archive(),
        "parse_timestamps_messy": (
            f"{dirty} SELECT \"IDENTIFIER\", {R._ts(R.SENT)} AS sent_ts, {R._ts(R.CONF)} AS confirmed_ts, {R._datepart(R.SENT)} AS message_date FROM m"
        ),
        "detail_messy": f"{dirty}, {R._DETAIL_CTE} SELECT * FROM d",
        "daily_summary_messy": f"{dirty}, {merged}",
        "alerts_messy": f"{dirty}, {R._RATES_CTE}, {R._ALERTS_CTE} SELECT * FROM a",
    }
