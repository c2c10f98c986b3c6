"""Daily summary per (line of business, send date).

Two forms are offered and produce the same rows:

* ``daily_summary`` -- the production plan: ONE conditional aggregation
  (``daily_stats``) grouped by (SRC_LOB, effective date), in two levels (per
  address, then per day, which turns the distinct count of addresses into a
  count of keys). Two exchanges, no join, one scan of the input.
  Partial aggregation runs before every shuffle, so a (LOB, day) group holding
  a third of all rows costs one row per map task, not a third of the data in
  one task.
* ``daily_summary_two_branch`` -- the original's shape: a totals aggregate, an
  eligible-rows aggregate, a full outer join on both keys, then null-key
  removal. Three exchanges, a sort-merge join and two scans. Kept as the
  reference form for tests and for the ``full_outer_merge`` operator.

Definitions (``d`` = message date, else file date):

* totals over all rows of (SRC_LOB, d): ``NBR_OF_PROV_RCH`` = distinct
  addresses, ``NBR_OF_MSG_ATMPT`` = count of SRC_LOB (0 for the null LOB);
* eligible rows -- match status Found, address and sent text present, grouped
  by the date of the sent text with no file-date fallback:
  ``NBR_OF_MSG_WTH_NPI`` = count, ``NBR_OF_MSG_SND`` = count minus Failed,
  ``SUC_RT`` = SND / WTH_NPI * 100, ``AVG_TM_TO_CNFM`` = mean seconds from sent
  to confirmed with a missing confirmation counted as 0;
* counts beyond INT are null in the summary's INT columns (they don't end the load);
* rows with a null LOB or date are dropped;
* defaults for days without an eligible row, applied in this order:
  WTH_NPI := PROV_RCH, SND := 0, SUC_RT := (new) WTH_NPI / ATMPT * 100,
  AVG := 0. Because the rate sees the value just replaced, a day where nothing
  matched can report 100.00 -- kept for parity with the original.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaylens.contract import MATCH_FOUND, STATUS_CONFIRMED, STATUS_FAILED, SUMMARY_SCHEMA, WINDOW_ID_COLUMN
from relaylens.functions.casts import percent, ratio, to_decimal
from relaylens.operators.detail import PARSED_DAY, PARSED_TIMES
from relaylens.functions.timeparse import confirm_seconds, effective_send_date, parse_report_timestamp, report_date_part

LOB = "SRC_LOB"
DATE = "Sent_Date"
SENT = "Date Message Sent"
CONFIRMED = "Date Failed/Confirmed"
ADDRESS = "Provider_Directaddress"
MATCH = "NPI Match Status"
DIRECT = "Direct Status"
FAILURE = "Failure Reason"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


# ---------------------------------------------------------------------------
# Building blocks (also public operators)
# ---------------------------------------------------------------------------


def with_effective_date(raw: DataFrame) -> DataFrame:
    """Replace ``Sent_Date`` (file date) by the message date when it parses."""
    return raw.withColumn(DATE, effective_send_date(_c(SENT), _c(DATE)))


def eligible_condition() -> Column:
    """Found, with an address and a sent text (the original's filter)."""
    return (_c(MATCH) == MATCH_FOUND) & _c(ADDRESS).isNotNull() & _c(SENT).isNotNull()


def eligible_messages(raw: DataFrame) -> DataFrame:
    """Eligible rows with the date of their sent text (null when unparseable)."""
    return raw.where(eligible_condition()).select(
        _c(LOB),
        report_date_part(_c(SENT)).alias(DATE),
        _c(SENT),
        _c(CONFIRMED),
        _c(DIRECT),
        _c(FAILURE),
    )


def daily_attempts(raw: DataFrame) -> DataFrame:
    """Totals branch: distinct addresses and attempts per (SRC_LOB, d).

    A null LOB forms its own group; it reports 0 attempts because the count is
    of the key itself.
    """
    return (
        with_effective_date(raw)
        .groupBy(LOB, DATE)
        .agg(
            F.count_distinct(_c(ADDRESS)).alias("NBR_OF_PROV_RCH"),
            F.count(_c(LOB)).alias("NBR_OF_MSG_ATMPT"),
        )
    )


def phase_metrics(raw: DataFrame) -> DataFrame:
    """Eligible branch: seconds, counts and failures per (SRC_LOB, message date).

    ``Total_count`` counts the LOB (0 for the null LOB, whose average is then
    null); ``Failed`` is 0 when nothing failed; the average is over all
    eligible rows, an unconfirmed one counting 0 seconds.
    """
    el = eligible_messages(raw).select(
        _c(LOB),
        _c(DATE),
        confirm_seconds(parse_report_timestamp(_c(SENT)), parse_report_timestamp(_c(CONFIRMED))).alias("secs"),
        F.when(_c(DIRECT) == STATUS_FAILED, F.lit(1)).alias("failed_flag"),
    )
    agg = el.groupBy(LOB, DATE).agg(
        F.sum("secs").alias("Total_diff"),
        F.count(_c(LOB)).alias("Total_count"),
        F.sum("failed_flag").alias("Failed"),
    )
    return agg.select(
        LOB,
        DATE,
        "Total_diff",
        "Total_count",
        F.coalesce(F.col("Failed"), F.lit(0).cast("bigint")).alias("Failed"),
        to_decimal(ratio("Total_diff", "Total_count"), 22, 2).alias("AVG_TM_TO_CNFM"),
    )


def full_outer_merge(raw: DataFrame) -> DataFrame:
    """The original merge: eligible metrics FULL OUTER JOIN totals on both keys.

    Null keys never match; the two key copies are merged with coalesce. Rows
    with a null key are still present (they are removed by the summary).
    """
    p = phase_metrics(raw).select(
        _c(LOB),
        _c(DATE),
        F.col("Total_count").try_cast("int").alias("NBR_OF_MSG_WTH_NPI"),
        (F.col("Total_count") - F.col("Failed")).try_cast("int").alias("NBR_OF_MSG_SND"),
        "AVG_TM_TO_CNFM",
    )
    p = p.withColumn("SUC_RT", percent("NBR_OF_MSG_SND", "NBR_OF_MSG_WTH_NPI"))
    t = daily_attempts(raw).select(
        F.col(LOB).alias("SRC_LOB_temp"),
        F.col(DATE).alias("Sent_Date_temp"),
        "NBR_OF_PROV_RCH",
        "NBR_OF_MSG_ATMPT",
    )
    cond = (p[LOB] == t["SRC_LOB_temp"]) & (p[DATE] == t["Sent_Date_temp"])
    j = p.join(t, cond, "full_outer")
    return j.select(
        F.coalesce(p[LOB], t["SRC_LOB_temp"]).alias("SRC_LOB"),
        F.coalesce(p[DATE], t["Sent_Date_temp"]).alias("DT_MSG_SND"),
        t["NBR_OF_MSG_ATMPT"].try_cast("int").alias("NBR_OF_MSG_ATMPT"),
        p["NBR_OF_MSG_WTH_NPI"],
        t["NBR_OF_PROV_RCH"].try_cast("int").alias("NBR_OF_MSG_WTH_NPI_RCH"),
        p["NBR_OF_MSG_SND"],
        p["SUC_RT"],
        p["AVG_TM_TO_CNFM"],
    ).withColumnRenamed("NBR_OF_MSG_WTH_NPI_RCH", "NBR_OF_PROV_RCH")


def apply_summary_defaults(summary: DataFrame) -> DataFrame:
    """Fill the metrics of days without an eligible message, in order.

    WTH_NPI := PROV_RCH; SND := 0; SUC_RT := WTH_NPI (just replaced) / ATMPT *
    100; AVG_TM_TO_CNFM := 0. Rows that had an eligible message are unchanged.
    """
    out = summary.withColumn(
        "NBR_OF_MSG_WTH_NPI", F.coalesce(F.col("NBR_OF_MSG_WTH_NPI"), F.col("NBR_OF_PROV_RCH"))
    )
    out = out.withColumn("NBR_OF_MSG_SND", F.coalesce(F.col("NBR_OF_MSG_SND"), F.lit(0)))
    out = out.withColumn(
        "SUC_RT", F.coalesce(F.col("SUC_RT"), percent("NBR_OF_MSG_WTH_NPI", "NBR_OF_MSG_ATMPT"))
    )
    out = out.withColumn(
        "AVG_TM_TO_CNFM", F.coalesce(F.col("AVG_TM_TO_CNFM"), F.lit(0).cast("decimal(22,2)"))
    )
    return out


def _finish(summary: DataFrame) -> DataFrame:
    return summary.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in SUMMARY_SCHEMA])


def daily_summary_two_branch(raw: DataFrame, window_id: str) -> DataFrame:
    """The summary in the original's two-aggregate + full-outer-join shape."""
    merged = full_outer_merge(raw).where(F.col("SRC_LOB").isNotNull() & F.col("DT_MSG_SND").isNotNull())
    merged = merged.withColumn(WINDOW_ID_COLUMN, F.lit(window_id).cast("string"))
    return _finish(apply_summary_defaults(merged))


# ---------------------------------------------------------------------------
# Production plan: one aggregation for summary and alerts
# ---------------------------------------------------------------------------


#: Columns of ``daily_stats``: the group and its counters.
STATS_COLUMNS = [LOB, DATE, "rows", "attempts", "reached", "matched", "successful", "elig_count", "elig_failed", "elig_secs"]


def message_day(raw: DataFrame) -> Column:
    """The day of the sent text: the parsed column where ``with_parsed_times`` has added it."""
    return F.col(PARSED_DAY) if PARSED_DAY in raw.columns else report_date_part(_c(SENT))


def _message_time(raw: DataFrame, source: str) -> Column:
    return F.col(PARSED_TIMES[source]) if PARSED_TIMES[source] in raw.columns else _c(source)


def daily_parts(raw: DataFrame) -> DataFrame:
    """The first level of ``daily_stats``: its counters per (SRC_LOB, effective date, address), null keys kept."""
    msg_date = message_day(raw)
    parsed = PARSED_TIMES[SENT] in raw.columns
    pre = raw.select(
        _c(LOB),
        F.coalesce(msg_date, _c(DATE)).alias(DATE),
        _c(ADDRESS).alias("address"),
        (_c(MATCH) == MATCH_FOUND).alias("is_found"),
        (_c(DIRECT) == STATUS_CONFIRMED).alias("is_confirmed"),
        (_c(DIRECT) == STATUS_FAILED).alias("is_failed"),
        (eligible_condition() & msg_date.isNotNull()).alias("eligible"),
        _message_time(raw, SENT).alias("sent"),
        _message_time(raw, CONFIRMED).alias("confirmed"),
    )
    times = [F.col(c) if parsed else parse_report_timestamp(F.col(c)) for c in ("sent", "confirmed")]
    secs = F.when(F.col("eligible"), confirm_seconds(*times))
    # Level 1: per (LOB, day, address) -- the distinct count of addresses
    # becomes a count of non-null keys at level 2. Both levels aggregate
    # partially before their shuffle, so a hot (LOB, day) group is first split
    # by address and then arrives at level 2 as one partial row per task.
    return pre.groupBy(LOB, DATE, "address").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(_c(LOB)).alias("attempts"),
        F.count_if(F.col("is_found")).alias("matched"),
        F.count_if(F.col("is_confirmed")).alias("successful"),
        F.count_if(F.col("eligible")).alias("elig_count"),
        F.count_if(F.col("eligible") & F.col("is_failed")).alias("elig_failed"),
        F.sum(secs).alias("elig_secs"),
    )


def daily_stats(raw: DataFrame) -> DataFrame:
    """Every counter the summary and the alerts need, in one aggregation.

    Grouped by (SRC_LOB, effective date) with null keys kept (the alerts keep
    them, the summary drops them). An eligible row must also have a parseable
    message date: in the original such a row lands in a (LOB, null) group of
    the eligible branch, which the join never matches and the null filter
    drops, while the row still counts in the totals under its file date.

    Output columns: SRC_LOB, Sent_Date, rows, attempts, reached, matched,
    successful, elig_count, elig_failed, elig_secs.
    """
    return stats_from_parts(daily_parts(raw))


def stats_from_parts(per_address: DataFrame) -> DataFrame:
    """``daily_stats`` from its first level."""
    return per_address.groupBy(LOB, DATE).agg(
        F.sum("rows").alias("rows"),
        F.sum("attempts").alias("attempts"),
        F.count("address").alias("reached"),
        F.sum("matched").alias("matched"),
        F.sum("successful").alias("successful"),
        F.sum("elig_count").alias("elig_count"),
        F.sum("elig_failed").alias("elig_failed"),
        F.sum("elig_secs").alias("elig_secs"),
    )


def summary_from_stats(stats: DataFrame, window_id: str, with_default_flag: bool = False) -> DataFrame:
    """The 9-column summary from ``daily_stats`` (null keys dropped, defaults applied).

    ``with_default_flag`` appends ``default_path``: true on days that had no
    eligible message, whose metrics therefore come from the defaults.
    """
    kept = stats.where(F.col(LOB).isNotNull() & F.col(DATE).isNotNull())
    has = F.col("elig_count") > 0
    sent = (F.col("elig_count") - F.col("elig_failed")).try_cast("int")
    out = kept.select(
        F.col(LOB).alias("SRC_LOB"),
        F.col(DATE).alias("DT_MSG_SND"),
        F.col("attempts").try_cast("int").alias("NBR_OF_MSG_ATMPT"),
        F.when(has, F.col("elig_count")).otherwise(F.col("reached")).try_cast("int").alias("NBR_OF_MSG_WTH_NPI"),
        F.col("reached").try_cast("int").alias("NBR_OF_PROV_RCH"),
        F.when(has, sent).otherwise(F.lit(0)).alias("NBR_OF_MSG_SND"),
        F.when(has, percent(sent, F.col("elig_count").try_cast("int")))
        .otherwise(percent(F.col("reached").try_cast("int"), F.col("attempts").try_cast("int")))
        .alias("SUC_RT"),
        F.when(has, to_decimal(ratio("elig_secs", "elig_count"), 22, 2))
        .otherwise(F.lit(0).cast("decimal(22,2)"))
        .alias("AVG_TM_TO_CNFM"),
        F.lit(window_id).cast("string").alias(WINDOW_ID_COLUMN),
        (~has).alias("default_path"),
    )
    finished = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in SUMMARY_SCHEMA]
    if with_default_flag:
        finished.append(F.col("default_path"))
    return out.select(*finished)


def daily_summary(raw: DataFrame, window_id: str) -> DataFrame:
    """The daily summary in one aggregation (see module docstring)."""
    return summary_from_stats(daily_stats(raw), window_id)
