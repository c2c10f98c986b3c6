"""``messages``: report rows derived from the driver's ``lineitem`` and ``orders``.

The real input of the pipeline is a folder of CSV delivery reports; the test
and bench data are TPC-H-style Parquet tables. This adapter states, as plain
deterministic Spark expressions, one report row per line item, so every
operator runs over the whole of ``lineitem`` joined with ``orders`` and an
independent SQL engine can rebuild the same rows.

``m`` is the first day of the order's month. Rules (one line per column):

* SRC_LOB: null when ``l_orderkey % 97 = 0``, else ``o_orderpriority``
* Sent_Date (file date): ``m``
* sent time: ``m`` + 1 day + ``l_linenumber`` hours + ``l_suppkey % 3600`` s
* Date Message Sent: null when ``l_partkey % 17 = 0``; else the sent time as
  12-hour text when ``l_partkey`` is even, 24-hour text when odd
* Direct Status: Confirmed when quantity <= 20, Failed when > 45, else Dispatched
* Date Failed/Confirmed: null when Dispatched or no sent text; else sent time +
  ``l_partkey % 7200`` s, same text form
* NPI Match Status: Found when ``l_linestatus = 'F'``, else Not Found
* Provider_Directaddress: null when ``l_suppkey % 10 = 0``, else ``'dm' || l_suppkey``
* Failure Reason: 'undeliverable' when Failed
* IDENTIFIER: ``l_orderkey-l_linenumber-l_partkey``; ROW_NUMBER: ``l_linenumber``
* PRESCRIBER_NPI: ``1000000000 + l_suppkey``, or ``3000000000 + l_suppkey`` when
  ``l_suppkey % 10 = 9`` (beyond INT)
* ZIPCODE: ``l_suppkey`` left-padded with zeros to 5
* fax columns: set only when Failed (fax sent one hour after the message,
  confirmed ``l_partkey % 600`` s later)
* OVERALL_STATUS: null when ``l_partkey % 5 = 0``, else Successful/Failed
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaylens.contract import RAW_COLUMNS

TEXT_12H = "MM/dd/yyyy hh:mm:ss a"
TEXT_24H = "MM/dd/yyyy HH:mm:ss"

LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_linestatus"]
ORDERS_COLUMNS = ["o_orderkey", "o_orderdate", "o_orderpriority"]


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _as_text(ts: Column, twelve_hour: Column) -> Column:
    return F.when(twelve_hour, F.date_format(ts, TEXT_12H)).otherwise(F.date_format(ts, TEXT_24H))


def _after(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts)


def messages_from(lineitem: DataFrame, orders: DataFrame, sort_by: dict[str, Column] | None = None, by_file: bool = False) -> DataFrame:
    """Report rows (24 report columns + SRC_LOB + Sent_Date) from the two tables.

    Plan shape, chosen for scale:

    * both sides are pruned to the columns the rules need (6 of ``lineitem``,
      3 of ``orders``) at the Parquet scan, and the join runs on these narrow
      rows -- the 26 text columns are computed AFTER the join, so the shuffle
      moves a few numbers per row instead of ~400 bytes of text;
    * the join is pinned to a sort-merge join on the order key. ``orders`` has
      a quarter of the rows of ``lineitem`` and grows with it, so it has no
      size bound that would make broadcasting it safe at scale; a shuffle join
      is what the planner must pick there anyway, and AQE still coalesces or
      splits (skew) the shuffle partitions at run time;
    * the text work then runs in parallel over the join's partitions.

    ``sort_by`` adds columns, made of ``month`` (the file date), by which each
    partition is sorted: the join's rows are sorted, before they have texts, and a
    write that needs this order has no rows of text to sort.

    ``by_file`` brings the rows of a (line of business, file date) to one task, in
    order of ``file_digest``: again the join's rows are dealt and sorted, so neither
    shuffle nor sort holds texts (some ten times the bytes).
    """
    li = lineitem.select(*LINEITEM_COLUMNS)
    od = orders.select(*ORDERS_COLUMNS).hint("merge")
    j = li.join(od, li["l_orderkey"] == od["o_orderkey"], "inner")

    none = F.lit(None).cast("string")
    k_part, k_supp, k_line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    supp_text = k_supp.cast("string")
    direct = (
        F.when(F.col("l_quantity") <= 20, F.lit("Confirmed"))
        .when(F.col("l_quantity") > 45, F.lit("Failed"))
        .otherwise(F.lit("Dispatched"))
    )
    failed = direct == "Failed"
    twelve = (k_part % 2) == 0
    no_sent_text = (k_part % 17) == 0
    fax_busy = (k_part % 3) == 0
    month = F.trunc(F.to_date(F.col("o_orderdate")), "month")
    sent_ts = _after(month.cast("timestamp_ntz"), F.lit(86400) + k_line * 3600 + k_supp % 3600)
    fax_sent_ts = _after(sent_ts, F.lit(3600))
    npi = F.when((k_supp % 10) == 9, k_supp + F.lit(3000000000)).otherwise(k_supp + F.lit(1000000000))

    cols = {
        "IDENTIFIER": F.concat_ws("-", F.col("l_orderkey"), k_line, k_part),
        "ROW_NUMBER": k_line.cast("string"),
        "PROGRAM": F.concat(F.lit("program "), (k_part % 4).cast("string")),
        "PROVIDER_FIRST_NAME": F.concat(F.lit("First"), supp_text),
        "PROVIDER_LAST_NAME": F.concat(F.lit("Last"), supp_text),
        "ADDRESS1": F.concat(supp_text, F.lit(" Main St")),
        "ADDRESS2": F.when((k_line % 2) == 0, F.concat(F.lit("Suite "), k_line.cast("string"))).otherwise(none),
        "CITY": F.concat(F.lit("City "), (k_supp % 20).cast("string")),
        "STATE": F.lit("NY"),
        "ZIPCODE": F.lpad(supp_text, 5, "0"),
        "PRESCRIBER_NPI": npi.cast("string"),
        "NPI Match Status": F.when(F.col("l_linestatus") == "F", F.lit("Found")).otherwise(F.lit("Not Found")),
        "Provider_Directaddress": F.when((k_supp % 10) == 0, none).otherwise(F.concat(F.lit("dm"), supp_text)),
        "Direct Status": direct,
        "Failure Reason": F.when(failed, F.lit("undeliverable")).otherwise(none),
        "Date Message Sent": F.when(no_sent_text, none).otherwise(_as_text(sent_ts, twelve)),
        "Date Failed/Confirmed": F.when((direct == "Dispatched") | no_sent_text, none).otherwise(
            _as_text(_after(sent_ts, k_part % 7200), twelve)
        ),
        "FAX_NUMBER": F.when(failed, (k_supp + F.lit(5550000000)).cast("string")).otherwise(none),
        "FAX_STATUS": F.when(failed, F.when(fax_busy, F.lit("Failed")).otherwise(F.lit("Delivered"))).otherwise(none),
        "FAX_ERROR_MESSAGES": F.when(failed & fax_busy, F.lit("line busy")).otherwise(none),
        "NUMBER_FAX_PAGES": F.when(failed, ((k_line % 4) + 1).cast("string")).otherwise(none),
        "FAX_Date Message Sent": F.when(failed, _as_text(fax_sent_ts, twelve)).otherwise(none),
        "FAX_Date_Failed/Confirmed": F.when(failed, _as_text(_after(fax_sent_ts, k_part % 600), twelve)).otherwise(none),
        "OVERALL_STATUS": F.when((k_part % 5) == 0, none)
        .when(direct == "Confirmed", F.lit("Successful"))
        .otherwise(F.lit("Failed")),
        "SRC_LOB": F.when((F.col("l_orderkey") % 97) == 0, none).otherwise(F.col("o_orderpriority")),
        "Sent_Date": month,
    }
    if by_file:
        j = j.repartition(cols["SRC_LOB"], month).sortWithinPartitions(file_digest(cols["SRC_LOB"], month))
    if not sort_by:
        return j.select(*[cols[n].alias(n) for n in RAW_COLUMNS])
    j = j.withColumn("month", month).withColumns(sort_by).drop("month").sortWithinPartitions(*sort_by)
    return j.select(*[cols[n].alias(n) for n in RAW_COLUMNS], *sort_by)


def file_digest(lob: Column, file_date: Column) -> Column:
    """A number for the file of a row: one number sorts fastest. Files that share one may have their rows mixed."""
    return F.xxhash64(lob, file_date)


def messages(spark: SparkSession, sf_dir: str, sort_by: dict[str, Column] | None = None, by_file: bool = False) -> DataFrame:
    """The adapter over ``{sf_dir}/lineitem.parquet`` and ``{sf_dir}/orders.parquet``."""
    return messages_from(load_table(spark, sf_dir, "lineitem"), load_table(spark, sf_dir, "orders"), sort_by, by_file)


# The same rows as ANSI SQL (DuckDB dialect), for the oracle; views ``lineitem``
# and ``orders`` must exist.
_SENT_TS = (
    "(CAST(date_trunc('month', o.o_orderdate) AS DATE)::TIMESTAMP + INTERVAL 1 DAY"
    " + to_hours(l.l_linenumber) + to_seconds(l.l_suppkey % 3600))"
)
_TWELVE = "(l.l_partkey % 2 = 0)"
_DIRECT = "(CASE WHEN l.l_quantity <= 20 THEN 'Confirmed' WHEN l.l_quantity > 45 THEN 'Failed' ELSE 'Dispatched' END)"


def _text_sql(ts: str) -> str:
    return f"(CASE WHEN {_TWELVE} THEN strftime({ts}, '%m/%d/%Y %I:%M:%S %p') ELSE strftime({ts}, '%m/%d/%Y %H:%M:%S') END)"


_CONF_TS = f"({_SENT_TS} + to_seconds(l.l_partkey % 7200))"
_FAX_SENT_TS = f"({_SENT_TS} + INTERVAL 1 HOUR)"
_FAX_CONF_TS = f"({_FAX_SENT_TS} + to_seconds(l.l_partkey % 600))"
_SENT_TEXT = f"(CASE WHEN l.l_partkey % 17 = 0 THEN NULL ELSE {_text_sql(_SENT_TS)} END)"

MESSAGES_SQL = f"""
SELECT
  CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) || '-' || CAST(l.l_partkey AS VARCHAR) AS "IDENTIFIER",
  CAST(l.l_linenumber AS VARCHAR) AS "ROW_NUMBER",
  'program ' || CAST(l.l_partkey % 4 AS VARCHAR) AS "PROGRAM",
  'First' || CAST(l.l_suppkey AS VARCHAR) AS "PROVIDER_FIRST_NAME",
  'Last' || CAST(l.l_suppkey AS VARCHAR) AS "PROVIDER_LAST_NAME",
  CAST(l.l_suppkey AS VARCHAR) || ' Main St' AS "ADDRESS1",
  CASE WHEN l.l_linenumber % 2 = 0 THEN 'Suite ' || CAST(l.l_linenumber AS VARCHAR) END AS "ADDRESS2",
  'City ' || CAST(l.l_suppkey % 20 AS VARCHAR) AS "CITY",
  'NY' AS "STATE",
  lpad(CAST(l.l_suppkey AS VARCHAR), 5, '0') AS "ZIPCODE",
  CAST(CASE WHEN l.l_suppkey % 10 = 9 THEN l.l_suppkey + 3000000000 ELSE l.l_suppkey + 1000000000 END AS VARCHAR) AS "PRESCRIBER_NPI",
  CASE WHEN l.l_linestatus = 'F' THEN 'Found' ELSE 'Not Found' END AS "NPI Match Status",
  CASE WHEN l.l_suppkey % 10 = 0 THEN NULL ELSE 'dm' || CAST(l.l_suppkey AS VARCHAR) END AS "Provider_Directaddress",
  {_DIRECT} AS "Direct Status",
  CASE WHEN {_DIRECT} = 'Failed' THEN 'undeliverable' END AS "Failure Reason",
  {_SENT_TEXT} AS "Date Message Sent",
  CASE WHEN {_DIRECT} = 'Dispatched' OR {_SENT_TEXT} IS NULL THEN NULL ELSE {_text_sql(_CONF_TS)} END AS "Date Failed/Confirmed",
  CASE WHEN {_DIRECT} = 'Failed' THEN CAST(l.l_suppkey + 5550000000 AS VARCHAR) END AS "FAX_NUMBER",
  CASE WHEN {_DIRECT} = 'Failed' THEN (CASE WHEN l.l_partkey % 3 = 0 THEN 'Failed' ELSE 'Delivered' END) END AS "FAX_STATUS",
  CASE WHEN {_DIRECT} = 'Failed' AND l.l_partkey % 3 = 0 THEN 'line busy' END AS "FAX_ERROR_MESSAGES",
  CASE WHEN {_DIRECT} = 'Failed' THEN CAST(l.l_linenumber % 4 + 1 AS VARCHAR) END AS "NUMBER_FAX_PAGES",
  CASE WHEN {_DIRECT} = 'Failed' THEN {_text_sql(_FAX_SENT_TS)} END AS "FAX_Date Message Sent",
  CASE WHEN {_DIRECT} = 'Failed' THEN {_text_sql(_FAX_CONF_TS)} END AS "FAX_Date_Failed/Confirmed",
  CASE WHEN l.l_partkey % 5 = 0 THEN NULL WHEN {_DIRECT} = 'Confirmed' THEN 'Successful' ELSE 'Failed' END AS "OVERALL_STATUS",
  CASE WHEN l.l_orderkey % 97 = 0 THEN NULL ELSE o.o_orderpriority END AS "SRC_LOB",
  CAST(date_trunc('month', o.o_orderdate) AS DATE) AS "Sent_Date"
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""
