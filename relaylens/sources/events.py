"""``event_messages``: report rows derived from the driver's ``events`` table.

A second input for the same operators, one report row per event and no join:
the line of business is the event type and the file date is the event's day.
Rules (one line per column; other report columns are null):

* IDENTIFIER: ``'ev-' || event_id``
* SRC_LOB: ``event_type``; Sent_Date (file date): the day of ``ts``
* Date Message Sent: null when ``event_id % 17 = 0``; else ``ts`` (to the
  second) as 12-hour text when ``event_id`` is even, 24-hour text when odd
* Direct Status: Confirmed when ``value < 60``, Failed when ``value >= 120``,
  else Dispatched
* Date Failed/Confirmed: null when Dispatched or no sent text; else ``ts`` +
  ``event_id % 7200`` s, same text form
* NPI Match Status: Found unless ``user_id % 4 = 0``
* Provider_Directaddress: null when ``user_id % 10 = 0``, else ``'dm' || user_id``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaylens.operators.detail import conform_to_contract
from relaylens.sources.messages import TEXT_12H, TEXT_24H, load_table


def event_messages_from(events: DataFrame) -> DataFrame:
    e = events.select("event_id", "ts", "user_id", "event_type", "value")
    none = F.lit(None).cast("string")
    twelve = (F.col("event_id") % 2) == 0
    no_text = (F.col("event_id") % 17) == 0
    direct = (
        F.when(F.col("value") < 60, F.lit("Confirmed"))
        .when(F.col("value") >= 120, F.lit("Failed"))
        .otherwise(F.lit("Dispatched"))
    )

    def as_text(ts):
        return F.when(twelve, F.date_format(ts, TEXT_12H)).otherwise(F.date_format(ts, TEXT_24H))

    confirmed_ts = F.timestamp_add("SECOND", F.col("event_id") % 7200, F.col("ts"))
    rows = e.select(
        F.concat(F.lit("ev-"), F.col("event_id").cast("string")).alias("IDENTIFIER"),
        F.col("event_type").alias("SRC_LOB"),
        F.to_date(F.col("ts")).alias("Sent_Date"),
        F.when(no_text, none).otherwise(as_text(F.col("ts"))).alias("Date Message Sent"),
        direct.alias("Direct Status"),
        F.when((direct == "Dispatched") | no_text, none).otherwise(as_text(confirmed_ts)).alias("Date Failed/Confirmed"),
        F.when((F.col("user_id") % 4) == 0, F.lit("Not Found")).otherwise(F.lit("Found")).alias("NPI Match Status"),
        F.when((F.col("user_id") % 10) == 0, none)
        .otherwise(F.concat(F.lit("dm"), F.col("user_id").cast("string")))
        .alias("Provider_Directaddress"),
    )
    return conform_to_contract(rows)


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapter over ``{sf_dir}/events.parquet``."""
    return event_messages_from(load_table(spark, sf_dir, "events"))


def _text_sql(ts: str) -> str:
    return (
        f"(CASE WHEN event_id % 2 = 0 THEN strftime({ts}, '%m/%d/%Y %I:%M:%S %p') "
        f"ELSE strftime({ts}, '%m/%d/%Y %H:%M:%S') END)"
    )


_DIRECT = "(CASE WHEN value < 60 THEN 'Confirmed' WHEN value >= 120 THEN 'Failed' ELSE 'Dispatched' END)"
_SENT = f"(CASE WHEN event_id % 17 = 0 THEN NULL ELSE {_text_sql('ts')} END)"

# The same rows as ANSI SQL (DuckDB dialect), for the oracle; view ``events``
# must exist. Report columns the rules do not set are null.
EVENT_MESSAGES_SQL = f"""
SELECT
  'ev-' || CAST(event_id AS VARCHAR) AS "IDENTIFIER",
  event_type AS "SRC_LOB",
  CAST(ts AS DATE) AS "Sent_Date",
  {_SENT} AS "Date Message Sent",
  {_DIRECT} AS "Direct Status",
  CASE WHEN {_DIRECT} = 'Dispatched' OR {_SENT} IS NULL THEN NULL
       ELSE {_text_sql("(ts + to_seconds(event_id % 7200))")} END AS "Date Failed/Confirmed",
  CASE WHEN user_id % 4 = 0 THEN 'Not Found' ELSE 'Found' END AS "NPI Match Status",
  CASE WHEN user_id % 10 = 0 THEN NULL ELSE 'dm' || CAST(user_id AS VARCHAR) END AS "Provider_Directaddress"
FROM events
"""
