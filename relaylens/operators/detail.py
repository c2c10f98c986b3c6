"""Raw report rows -> the typed 27-column detail table.

All work is per row (projections only): no shuffle, one whole-stage-codegen
span from the scan to the write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaylens.contract import (
    DETAIL_COLUMN_MAP,
    DETAIL_FILL_EMPTY,
    DETAIL_SCHEMA,
    GEN1_TRAILING_COLUMN,
    OVERALL_FAILED,
    OVERALL_SUCCESSFUL,
    RAW_COLUMNS,
    STATUS_CONFIRMED,
    STATUS_FAILED,
    MATCH_FOUND,
    WINDOW_ID_COLUMN,
)
from relaylens.functions.casts import INT_LIMIT, fill_empty, text_to_bigint, text_to_int
from relaylens.functions.timeparse import even_text, parse_report_timestamp, read_even_text

_TIMESTAMP_SOURCES = {
    "Date Message Sent",
    "Date Failed/Confirmed",
    "FAX_Date Message Sent",
    "FAX_Date_Failed/Confirmed",
}
# Columns that ``with_parsed_times`` adds: one per timestamp text, and the day of the sent text.
PARSED_TIMES = {
    "Date Message Sent": "_sent_ts",
    "Date Failed/Confirmed": "_confirmed_ts",
    "FAX_Date Message Sent": "_fax_sent_ts",
    "FAX_Date_Failed/Confirmed": "_fax_confirmed_ts",
}
PARSED_DAY = "_sent_day"
_INT_SOURCES = {"ROW_NUMBER", "PRESCRIBER_NPI", "NUMBER_FAX_PAGES"}
_BIGINT_SOURCES = {"FAX_NUMBER"}


def conform_to_contract(df: DataFrame) -> DataFrame:
    """Project any report-shaped frame onto the 26 raw columns, in order.

    Names resolve case-insensitively (``Fax_NUMBER`` finds ``FAX_NUMBER``);
    the unnamed trailing column of first-generation files is dropped (a no-op
    when absent); report columns a frame lacks become null text; columns that
    are not in the contract are dropped.
    """
    df = df.drop(GEN1_TRAILING_COLUMN)
    present = {c.lower(): c for c in df.columns}
    out = []
    for name in RAW_COLUMNS:
        src = present.get(name.lower())
        if name == "Sent_Date":
            col = F.col(f"`{src}`").cast("date") if src else F.lit(None).cast("date")
        else:
            col = F.col(f"`{src}`").cast("string") if src else F.lit(None).cast("string")
        out.append(col.alias(name))
    return df.select(*out)


def _raw(name: str) -> Column:
    return F.col(f"`{name}`")


def with_parsed_times(raw: DataFrame) -> DataFrame:
    """``raw`` with its four timestamp texts parsed, each text once, and the day of the sent text.

    ``normalize_detail`` and ``daily_stats`` use these columns where they are, so a
    load that stages them parses nothing twice.
    """
    even = raw.select("*", *[even_text(_raw(c)).alias(f"{name}_even") for c, name in PARSED_TIMES.items()])
    read = {name: read_even_text(F.col(f"{name}_even"), _raw(c)) for c, name in PARSED_TIMES.items()}
    times = [ts.alias(name) for name, (ts, _) in read.items()]
    day = read[PARSED_TIMES["Date Message Sent"]][1].alias(PARSED_DAY)
    return even.select(*[_raw(c) for c in raw.columns], *times, day)


def reject_reasons(not_null: tuple[str, ...] = (), file_name: bool = False) -> Column:
    """array<string> of what is wrong with a row, for rows that came with their file's ``names`` (sources.inbox).

    ``not_null``: columns that must have a value; ``file_name``: the file's name must give a line of business and a date.
    """
    checks = [F.when(_raw(c).isNull(), F.lit(f"{c} is missing")) for c in not_null]
    if file_name:
        checks += [F.when(_raw("SRC_LOB").isNull(), F.lit("no line of business in the file's name")), F.when(_raw("Sent_Date").isNull(), F.lit("no date in the file's name"))]
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def _convert(source: str, parsed: bool = False) -> Column:
    c = _raw(source)
    if parsed and source in PARSED_TIMES:
        return F.col(PARSED_TIMES[source])
    if source in _TIMESTAMP_SOURCES:
        return parse_report_timestamp(c)
    if source in _INT_SOURCES:
        return text_to_int(c.cast("string"))
    if source in _BIGINT_SOURCES:
        return text_to_bigint(c.cast("string"))
    if source == "ZIPCODE":
        return c.cast("string")
    return c


def normalize_detail(raw: DataFrame, window_id: str, wide_npi_column: str | None = None) -> DataFrame:
    """The detail table: typed columns, detail names, batch id, '' fills.

    Integer texts become INT/BIGINT (a fraction is dropped; out of range or
    malformed -> null, so a 10-digit NPI above 2,147,483,647 is null); the four
    timestamp texts are parsed by ``parse_report_timestamp``; the zip code stays
    text so leading zeros survive. ``wide_npi_column`` (opt-in) appends the NPI
    as BIGINT under that name, so values beyond INT are kept as well.
    """
    parsed = set(PARSED_TIMES.values()) <= set(raw.columns)
    cols = [_convert(src, parsed).alias(dst) for src, dst in DETAIL_COLUMN_MAP]
    cols.append(F.lit(window_id).cast("string").alias(WINDOW_ID_COLUMN))
    if wide_npi_column:
        cols.append(text_to_bigint(_raw("PRESCRIBER_NPI").cast("string")).alias(wide_npi_column))
    detail = raw.select(*cols)
    detail = fill_empty(detail, DETAIL_FILL_EMPTY)
    out = [F.col(f.name).cast(f.dataType).alias(f.name) for f in DETAIL_SCHEMA]
    if wide_npi_column:
        out.append(F.col(wide_npi_column))
    return detail.select(*out)


def quality_metrics() -> list[Column]:
    """Data-quality counters over raw rows, for ``DataFrame.observe`` (text
    checks only -- nothing is parsed here; see ``quality_from``).

    * ``sent_present`` / ``confirmed_present``: non-blank timestamp texts;
    * ``lowercase_meridiem``: the text carries a lower-case am/pm and no
      upper-case one, so it is read as 24-hour (kept for parity);
    * ``npi_beyond_int``: an NPI that is a whole number but does not fit INT;
    * ``null_lob`` / ``null_file_date``: the file name gave no line of business
      or no date.
    """
    sent, conf = _raw("Date Message Sent"), _raw("Date Failed/Confirmed")
    npi = _raw("PRESCRIBER_NPI").cast("string")

    def present(c):
        return c.isNotNull() & (F.trim(c) != "")

    # the plain searches settle nearly every text
    lower = (sent.contains("am") | sent.contains("pm")) & ~(sent.contains("AM") | sent.contains("PM")) & sent.rlike(r"\s[ap]m\b")
    wide = text_to_bigint(npi)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(present(sent)).alias("sent_present"),
        F.count_if(present(conf)).alias("confirmed_present"),
        F.count_if(lower).alias("lowercase_meridiem"),
        F.count_if(~wide.between(-INT_LIMIT - 1, INT_LIMIT)).alias("npi_beyond_int"),
        F.count_if(_raw("SRC_LOB").isNull()).alias("null_lob"),
        F.count_if(_raw("Sent_Date").isNull()).alias("null_file_date"),
    ]


def parsed_metrics() -> list[Column]:
    """Counters over the detail rows: timestamps that parsed."""
    return [F.count("DT_MSG_SND").alias("sent_parsed"), F.count("DT_ACPT").alias("confirmed_parsed")]


def quality_from(raw_counts: dict, parsed_counts: dict) -> dict[str, int]:
    """Combine the two observations: unparseable = present texts - parsed."""
    q = {k: int(v) for k, v in raw_counts.items()}
    q["sent_unparseable"] = q.pop("sent_present") - int(parsed_counts["sent_parsed"])
    q["confirmed_unparseable"] = q.pop("confirmed_present") - int(parsed_counts["confirmed_parsed"])
    return q


def status_flags(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Per-row flags the summary and alerts count.

    * ``OverallStatus``: Successful when the direct status is Confirmed, else
      Failed (also for a null status). The original computed it and then left it
      out of the detail table; it is offered here as its own column.
    * ``failed_flag``: 1 when Failed, else null (a one-armed conditional).
    * ``matched_flag`` / ``success_flag``: 1/0 for Found / Confirmed.
    """
    keep = keep if keep is not None else ["IDENTIFIER"]
    direct = _raw("Direct Status")
    return raw.select(
        *[_raw(c) for c in keep],
        F.when(direct == STATUS_CONFIRMED, F.lit(OVERALL_SUCCESSFUL)).otherwise(F.lit(OVERALL_FAILED)).alias("OverallStatus"),
        F.when(direct == STATUS_FAILED, F.lit(1)).alias("failed_flag"),
        F.when(_raw("NPI Match Status") == MATCH_FOUND, F.lit(1)).otherwise(F.lit(0)).alias("matched_flag"),
        F.when(direct == STATUS_CONFIRMED, F.lit(1)).otherwise(F.lit(0)).alias("success_flag"),
    )


def project_to_target(df: DataFrame, target) -> DataFrame:
    """Select ``df``'s columns in the order of ``target``.

    ``target`` is a DataFrame (e.g. a JDBC probe or a catalog table) or a list
    of names. Resolution is by name, so a different order in the target cannot
    shift data between columns. A target column ``df`` lacks is an error.
    """
    names = target.columns if isinstance(target, DataFrame) else list(target)
    return df.select(*[F.col(f"`{n}`") for n in names])
