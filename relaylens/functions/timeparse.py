"""Report timestamp and date parsing as Column expressions (JVM side, codegen).

Report texts come in two layouts: ``MM/dd/yyyy hh:mm:ss AM|PM`` and
``MM/dd/yyyy HH:mm:ss``. The original read them with Spark's legacy
(SimpleDateFormat) parser, which accepts one-digit fields, ignores trailing
text and yields null on anything else. We keep ANSI mode and the CORRECTED
parser and reproduce that behaviour with an anchored prefix match followed by
``try_to_timestamp``:

* the 12-hour layout is chosen when the text contains an upper-case ``AM`` or
  ``PM`` anywhere; otherwise the 24-hour layout is used (so ``3:04:05 pm`` is
  read as 03:04:05, as before);
* leading blanks are skipped and runs of blanks are collapsed;
* anything after the recognised prefix is ignored;
* the year takes at most five digits (a longer one overflows the parser).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes the two layouts accept (groups capture the text to parse).
_DATE_PART = r"\d{1,2}/\d{1,2}/\d{1,5}"
_TIME_PART = r"\d{1,2}:\d{1,2}:\d{1,2}"
_PREFIX_12H = rf"^\s*({_DATE_PART} \s*{_TIME_PART}\s+[AaPp][Mm])"
_PREFIX_24H = rf"^\s*({_DATE_PART} \s*{_TIME_PART})"
_PREFIX_DATE = rf"^\s*({_DATE_PART})"

FORMAT_12H = "M/d/y h:m:s a"
FORMAT_24H = "M/d/y H:m:s"
FORMAT_DATE = "M/d/y"
STRICT_12H = "MM/dd/yyyy hh:mm:ss a"
STRICT_24H = "MM/dd/yyyy HH:mm:ss"
STRICT_DATE = "MM/dd/yyyy"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _prefix(c: Column, pattern: str) -> Column:
    text = F.regexp_extract(c, pattern, 1)
    text = F.regexp_replace(text, r"\s+", " ")
    return F.nullif(text, F.lit(""))


def is_twelve_hour(c) -> Column:
    """True when the text names a half of the day (upper-case, anywhere)."""
    c = _col(c)
    return c.contains("AM") | c.contains("PM")


def _lenient_timestamp(c: Column) -> Column:
    twelve = F.try_to_timestamp(_prefix(c, _PREFIX_12H), F.lit(FORMAT_12H))
    twenty_four = F.try_to_timestamp(_prefix(c, _PREFIX_24H), F.lit(FORMAT_24H))
    return F.when(is_twelve_hour(c), twelve).otherwise(twenty_four)


def parse_report_timestamp(c) -> Column:
    """Text -> TIMESTAMP in either report layout; null when it does not parse.

    Fast path: a text of exactly the canonical length (22 characters for
    ``MM/dd/yyyy hh:mm:ss AM``, 19 for ``MM/dd/yyyy HH:mm:ss``) is parsed with
    the strict two-digit pattern, no regular expression involved. Whenever
    that parse succeeds the lenient recipe yields the same instant (the whole
    text is one valid prefix with a four-digit year), so the lenient recipe
    only runs for the rows the fast path leaves null.
    """
    c = _col(c)
    twelve = is_twelve_hour(c)
    n = F.length(c)
    fast = F.when(twelve & (n == 22), F.try_to_timestamp(c, F.lit(STRICT_12H))).when(
        ~twelve & (n == 19), F.try_to_timestamp(c, F.lit(STRICT_24H))
    )
    return F.coalesce(fast, _lenient_timestamp(c))


def report_date_part(c) -> Column:
    """DATE of the text before its first blank (``MM/dd/yyyy``), else null.

    A text that starts with a blank has an empty first part, so its date is
    null even though its timestamp parses; a date-only text has a date but no
    timestamp. Both follow the original. A first part of exactly ten
    characters is tried with the strict pattern first (same result when it
    parses); the lenient prefix recipe handles the rest.
    """
    first = F.substring_index(_col(c), " ", 1)
    fast = F.when(F.length(first) == 10, F.try_to_timestamp(first, F.lit(STRICT_DATE)))
    lenient = F.try_to_timestamp(_prefix(first, _PREFIX_DATE), F.lit(FORMAT_DATE))
    return F.coalesce(fast, lenient).cast("date")


# One pass over a text: its date, perhaps its time, perhaps its half of the day.
_PARTS = rf"^\s*({_DATE_PART}(?: \s*{_TIME_PART}(?:\s+[AaPp][Mm])?)?)"
# A text that is its own even form.
_CANONICAL = r"^\d\d/\d\d/\d{4} \d\d:\d\d:\d\d(?: [AP]M)?\z"
_ONE_DIGIT = r"(?<!\d)(\d)(?!\d)"


def even_text(c) -> Column:
    """The recognised prefix of a report text with numbers of two digits and more and single blanks; null without one."""
    c = _col(c)

    def evened(t: Column) -> Column:
        prefix = F.regexp_replace(F.regexp_replace(F.regexp_extract(t, _PARTS, 1), r"\s+", " "), _ONE_DIGIT, "0$1")
        return F.when(prefix != "", prefix)

    return F.when(c.rlike(_CANONICAL), c).when(c.isNotNull(), F.transform(F.array(c), evened)[0])


def read_even_text(even, c) -> tuple[Column, Column]:
    """(timestamp, day) of a text ``c`` and its ``even_text``.

    The numbers of a year of four digits stand at fixed places and are read in generated code; texts of other years, which
    shift them, are read by a lambda, so that no generated method has both.
    """
    even, c = _col(even), _col(c)
    twelve, shifted = is_twelve_hour(c), c.startswith(" ")
    # day and month have two digits each, so only a year of four ends the text or a date at the tenth place
    usual = (F.length(even) == 10) | (F.substr(even, F.lit(11), F.lit(1)) == " ")

    def read(k: int) -> Column:
        other = F.transform(F.array(even), lambda e: _numbers_read(e, F.length(F.substring_index(F.substr(e, F.lit(7)), " ", 1)), twelve, shifted)[k])[0]
        return F.when(usual, _numbers_read(even, F.lit(4), twelve, shifted)[k]).when(even.isNotNull(), other)

    return read(0), read(1)


def _numbers_read(even: Column, digits: Column, twelve: Column, shifted: Column) -> tuple[Column, Column]:
    """(timestamp, day) of an even text whose year has so many digits. Numbers out of range don't reach the builder, which
    raises and catches an exception for each (and would take 60 seconds for the next minute's first)."""

    def two(at: int) -> Column:
        return F.substr(even, digits + at, F.lit(2)).cast("int")

    size, zero = F.length(even), F.lit(0)
    month, day = F.substr(even, F.lit(1), F.lit(2)).cast("int"), F.substr(even, F.lit(4), F.lit(2)).cast("int")
    year = F.substr(even, F.lit(7), digits).cast("int")
    timed, half = size >= digits + 15, F.substr(even, digits + 17, F.lit(1))
    hour = F.when(timed, two(8))
    of_half = F.when((size >= digits + 18) & hour.between(1, 12), hour % 12 + F.when(half.isin("P", "p"), F.lit(12)).otherwise(zero))
    hour = F.when(twelve, of_half).otherwise(hour)
    minute, second = F.when(timed, two(11)), F.when(timed, two(14))
    real = month.between(1, 12) & day.between(1, 31)
    in_range = real & hour.between(0, 23) & minute.between(0, 59) & second.between(0, 59)
    ts = F.when(in_range, F.try_make_timestamp(year, month, day, hour, minute, second))
    date = F.when(real & ~shifted, F.try_make_timestamp(year, month, day, zero, zero, zero).cast("date"))
    return ts, date


def parse_report_text(c) -> Column:
    """Text -> struct<ts, day>: ``parse_report_timestamp`` and ``report_date_part`` of it from one look at the text.

    The even text is handed on by a lambda, which runs interpreted: where many texts are parsed, take ``even_text`` in a
    projection before ``read_even_text``.
    """
    c = _col(c)

    def both(even: Column) -> Column:
        digits = F.length(F.substring_index(F.substr(even, F.lit(7)), " ", 1))
        ts, day = _numbers_read(even, digits, is_twelve_hour(c), c.startswith(" "))
        return F.struct(ts.alias("ts"), day.alias("day"))

    return F.transform(F.array(even_text(c)), both)[0]


def effective_send_date(message_sent, file_date) -> Column:
    """Date of the message text, falling back to the file date."""
    return F.coalesce(report_date_part(message_sent), _col(file_date))


def epoch_seconds(ts) -> Column:
    """TIMESTAMP -> whole seconds since the epoch (BIGINT)."""
    return F.unix_seconds(_col(ts))


def confirm_seconds(sent_ts, confirmed_ts) -> Column:
    """Seconds between sending and confirmation, absolute; missing -> 0."""
    diff = F.abs(epoch_seconds(confirmed_ts) - epoch_seconds(sent_ts))
    return F.when(diff > 0, diff).otherwise(F.lit(0).cast("bigint"))


def elapsed_minutes(start_ts, end_ts) -> Column:
    """Whole minutes from start to end, truncated toward zero (BIGINT)."""
    return F.timestamp_diff("MINUTE", _col(start_ts), _col(end_ts))
