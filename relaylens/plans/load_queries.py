"""Registered queries that go through files and written tables, and their SQL.

Each writes report files derived from the given tables into a new folder of the
shared scratch space, loads them as a user would, and reads back what was written.
The SQL twins state the same rows directly over the tables.

Report files: one per (line of business, month) of the ``messages`` rows that have a
line of business. Their layouts differ: file number ``f`` (of its month and line of
business) has its columns turned by ``f % 24``, carries a column ``EXTRA_<f % 120>``
that no contract knows, and, where ``f % 5 = 0``, is of the older generation (without
the seven newer columns, with an unnamed trailing one).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaylens.contract import (
    AUDIT_TABLE,
    DETAIL_TABLE,
    GEN2_ONLY_COLUMNS,
    RAW_COLUMNS,
    REJECT_TABLE,
    REPORT_COLUMNS,
    SUMMARY_TABLE,
)
from relaylens.operators.alerts import alert_lines, filter_alerts, low_rate_alerts, rates_from_stats
from relaylens.operators.audit import recent_loads
from relaylens.operators.detail import PARSED_DAY, PARSED_TIMES, normalize_detail, with_parsed_times
from relaylens.operators.summary import ADDRESS, CONFIRMED, DATE, DIRECT, LOB, MATCH, SENT, daily_stats, summary_from_stats
from relaylens.plans.load import CatalogWarehouse, LoadConfig, Quarantine, load_one_table, run_load, stage_rows
from relaylens.session import apply_semantic_conf, checkpoint_dir
from relaylens.sinks.archive import archive_files, file_system
from relaylens.sinks.ddl import create_lake_tables
from relaylens.sinks.lake import read_window, remove_folder, stage, unstage, write_alert_parts
from relaylens.sinks.state import DailyState
from relaylens.sources.messages import file_digest, messages
from relaylens.sources.reports import read_reports, stage_inbox

WINDOW = "202101010000"
RUN_DATE = "2021-01-01"
SLICES = 3
#: The tables' months are many and small.
PERIOD = "yyyy"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared scratch space."""
    return f"{checkpoint_dir(spark)}/queries/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------------------
# Report files from the tables
# ---------------------------------------------------------------------------


def file_number() -> Column:
    """Number of a report file, from its line of business and month."""
    return F.year("Sent_Date") * 12 + F.month("Sent_Date") + F.char_length("SRC_LOB") * 7


def file_name() -> Column:
    return F.concat(F.lit("ACME_"), F.col("SRC_LOB"), F.lit("_daily_"), F.date_format("Sent_Date", "MMddyyyy"), F.lit("_120000_report.csv"))


#: Layouts a month's and line of business's number chooses from.
TURNS, EXTRAS = 24, 120


def _header(columns: list[str], by: Column, extra: Column, end: str) -> Column:
    """The header of ``columns`` and ``extra``, turned by ``by``, then ``end``: every turn is a constant but for the extra name."""
    turned = [[*columns, "\0"][t:] + [*columns, "\0"][:t] for t in range(len(columns) + 1)]
    around = [",".join(names).split("\0") for names in turned]
    before, after = (F.get(F.array(*[F.lit(halves[k]) for halves in around]), by) for k in (0, 1))
    return F.concat(before, extra, after, F.lit(end))


def _line(columns: list[str], by: Column, end: str) -> Column:
    """The values of ``columns`` and an ``x``, turned by ``by``, then ``end``; every third field is quoted."""
    n = len(columns) + 1

    def cell(value: Column, at: int) -> Column:
        quoted = (F.lit(at + n) - by) % n % 3 == 0
        return F.when(value.isNull(), F.lit("")).when(quoted, F.concat(F.lit('"'), value, F.lit('"'))).otherwise(value)

    cells = F.array(*[cell(F.col(f"`{c}`"), i) for i, c in enumerate(columns)], cell(F.lit("x"), n - 1))
    turned = F.concat(F.slice(cells, by + 1, n - by), F.slice(cells, F.lit(1), by))
    return F.concat(F.array_join(turned, ","), F.lit(end))


def report_lines(rows: DataFrame) -> DataFrame:
    """(digest, file_no, name, header, line) of raw rows with a line of business."""
    older_columns = [c for c in REPORT_COLUMNS if c not in GEN2_ONLY_COLUMNS]
    numbered = rows.where("SRC_LOB IS NOT NULL").withColumn("_n", file_number())
    n = F.col("_n")
    older, extra = n % 5 == 0, F.concat(F.lit("EXTRA_"), (n % EXTRAS).cast("string"))

    def laid_out(make: Callable[[list[str], Column, str], Column]) -> Column:
        # the older generation's unnamed column is its last one
        old, new = make(older_columns, n % TURNS % (len(older_columns) + 1), ","), make(REPORT_COLUMNS, n % TURNS % (len(REPORT_COLUMNS) + 1), "")
        return F.when(older, old).otherwise(new)

    header = laid_out(lambda columns, by, end: _header(columns, by, extra, end))
    digest = file_digest(F.col("SRC_LOB"), F.col("Sent_Date"))
    return numbered.select(digest.alias("digest"), n.alias("file_no"), file_name().alias("name"), header.alias("header"), laid_out(_line).alias("line"))


def _bytes_of(texts: pa.Array, start: int, end: int) -> pa.Buffer:
    """The bytes of the texts from ``start`` to before ``end``, which lie one after the other in their array."""
    _, places, data = texts.buffers()
    at = np.frombuffer(places, np.int64 if pa.types.is_large_string(texts.type) else np.int32)
    first, last = int(at[texts.offset + start]), int(at[texts.offset + end])
    return data.slice(first, last - first)


def write_report_files(lines: DataFrame, inbox: str, folder_of: Column | None = None) -> DataFrame:
    """Write report lines (digest, name, header, line) as files ``<inbox>[/<folder>]/<name>``; returns (file, rows).

    Rows of a file come in one task, in order of the file's digest (``messages(by_file=True)``; files that share one are
    written side by side), and their bytes are streamed into it as they lie in a batch. No text is shuffled or sorted.
    """
    spark = lines.sparkSession
    folder = F.lit("") if folder_of is None else F.concat(F.lit("/"), folder_of.cast("string"))
    file = F.concat(F.lit(inbox), folder, F.lit("/"), F.col("name")).alias("file")
    rows = lines.select("digest", file, "header", F.concat("line", F.lit("\n")).alias("line"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, outs, written = None, {}, {}
        for batch in batches:
            digests, files, headers, texts = batch.columns
            runs, start = pc.run_end_encode(files), 0
            for file, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if digests[start].as_py() != digest:
                    for out in outs.values():
                        out.close()
                    digest, outs = digests[start].as_py(), {}
                if file not in outs:
                    if file in written:
                        raise ValueError(f"the rows of {file} do not come together")
                    system, path = file_system(file)
                    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    outs[file], written[file] = system.open_output_stream(path), 0
                    outs[file].write(f"{headers[start].as_py()}\n".encode())
                outs[file].write(_bytes_of(texts, start, end))
                written[file] += end - start
                start = end
        for out in outs.values():
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(list(written), pa.string()), pa.array(list(written.values()), pa.int64())], ["file", "rows"])

    written = rows.mapInArrow(run, "file string, rows long")
    return stage(written, "report-files", f"written-{uuid.uuid4().hex}")


def write_empty_file(spark: SparkSession, path: str) -> None:
    """A file without a byte, as a broken transfer leaves it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(hadoop, True).close()


def _inbox(spark: SparkSession, sf_dir: str, name: str, folder_of: Column | None = None, where: str = "true") -> str:
    apply_semantic_conf(spark)
    inbox = scratch(spark, name)
    write_report_files(report_lines(messages(spark, sf_dir, by_file=True)).where(where), inbox, folder_of)
    write_empty_file(spark, f"{inbox}/ACME_NONE_daily_01011999_120000_report.csv")
    return inbox


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------


def q_inbox_rows(spark, sf_dir):
    """Every row of an inbox of more than a hundred layouts and an empty file, read once."""
    inbox = _inbox(spark, sf_dir, "inbox")
    rows, _ = read_reports(spark, inbox)
    remove_folder(spark, inbox)  # read: the rows come from the staged lines
    return rows


def q_load_detail(spark, sf_dir):
    """A whole load of report files; the detail rows read back from its partition of the lake."""
    inbox, database = _inbox(spark, sf_dir, "load"), f"q_{uuid.uuid4().hex[:12]}"
    run_load(spark, LoadConfig(inbox, scratch(spark, "lake"), database), WINDOW, RUN_DATE)
    remove_folder(spark, inbox)
    return read_window(spark, f"`{database}`.`{DETAIL_TABLE}`", WINDOW)


def q_load_audit(spark, sf_dir):
    """The audit table after two real loads into lake and warehouse; rows that only the warehouse has make the second fail."""
    database = f"q_{uuid.uuid4().hex[:12]}"
    warehouse = CatalogWarehouse(f"{database}_wh", scratch(spark, "warehouse"))
    lake = scratch(spark, "lake")
    for window, where in (("202101010000", "file_no % 2 = 0"), ("202101020000", "file_no % 2 = 1")):
        cfg = LoadConfig(_inbox(spark, sf_dir, "audit", where=where), lake, database, warehouse=warehouse)
        if window == "202101020000":
            # someone else's rows in the warehouse's detail table
            stray = read_window(spark, f"`{database}`.`{DETAIL_TABLE}`", "202101010000").where("DIR_STS = 'Failed'")
            warehouse.write(stray, DETAIL_TABLE, "by-hand")
        run_load(spark, cfg, window, RUN_DATE)
        remove_folder(spark, cfg.inbox)
    audit = spark.table(f"`{database}`.`{AUDIT_TABLE}`")
    return audit.select("TableName", "WindowID", "source_count", "delta_count", "synapse_count", "count_validation", "no_columns", "window_inserts", "restore_version")


#: Loads whose audit rows are asked for: the months of the year in so many parts.
AUDITED_LOADS = 6


def audited_rows(spark, sf_dir) -> DataFrame:
    """Messages with parsed times and their load's number, in its order: the write by load sorts no rows of text."""
    rows = messages(spark, sf_dir, {"_load": F.month("month") % AUDITED_LOADS})
    return with_parsed_times(rows)


def q_audit_recent(spark, sf_dir):
    """The ten newest of the audit rows that loads of detail and summary have written."""
    apply_semantic_conf(spark)
    database = f"q_{uuid.uuid4().hex[:12]}"
    tables = create_lake_tables(spark, database, scratch(spark, "lake"))
    rows = audited_rows(spark, sf_dir)
    # a folder a load, so that each reads its own rows only
    path = scratch(spark, "audited")
    rows.write.partitionBy("_load").parquet(path)
    staged = spark.read.schema(rows.schema).parquet(path)
    for k in range(AUDITED_LOADS):
        part, window = staged.where(F.col("_load") == k).drop("_load"), f"2021010{k + 1}0000"
        n = part.count()
        load_one_table(spark, normalize_detail(part, window), DETAIL_TABLE, tables, window, n, None)
        load_one_table(spark, summary_from_stats(daily_stats(part), window), SUMMARY_TABLE, tables, window, n, None)
    recent = recent_loads(spark.table(tables.audit), 10)
    return recent.select("TableName", "WindowID", "source_count", "delta_count", "synapse_count", "count_validation", "no_columns", "window_inserts", "restore_version")


def _slices(spark, sf_dir) -> DataFrame:
    """Totals of the daily state after the files came in slices."""
    inbox = _inbox(spark, sf_dir, "slices", folder_of=F.col("file_no") % SLICES)
    state = DailyState(spark, scratch(spark, "state"), PERIOD)
    for k in range(SLICES):
        slice_id = f"slice-{uuid.uuid4().hex}"
        batch = stage_inbox(spark, f"{inbox}/{k}", batch_id=slice_id)
        remove_folder(spark, f"{inbox}/{k}")  # each is removed as soon as it has been read for good
        rows, _, _, _ = stage_rows(spark, batch, slice_id)
        unstage(spark, "lines", slice_id)
        state.add(rows, f"w{k}")
        unstage(spark, "rows", slice_id)
    remove_folder(spark, inbox)
    return state.totals()


def q_slices_summary(spark, sf_dir):
    """The daily summary of files that were loaded in slices, from the mergeable state."""
    return summary_from_stats(_slices(spark, sf_dir), WINDOW)


def q_slices_alerts(spark, sf_dir):
    return filter_alerts(rates_from_stats(_slices(spark, sf_dir)))


#: Columns that the daily state reads.
STATE_SOURCES = [LOB, DATE, ADDRESS, MATCH, DIRECT, SENT, CONFIRMED]
STATE_PARSED = [PARSED_TIMES[SENT], PARSED_TIMES[CONFIRMED], PARSED_DAY]
#: Overlapping loads of the messages: each row is in one to three of them.
OVERLAPS = ["ROW_NUMBER % 2 = 0", "ROW_NUMBER % 3 = 0", "true"]


def q_distinct_across_loads(spark, sf_dir):
    """Counters and distinct addresses over three overlapping loads, the second of them written twice."""
    apply_semantic_conf(spark)
    # each text is written and parsed once, whatever the number of loads that a row is in
    rows = with_parsed_times(messages(spark, sf_dir)).select("ROW_NUMBER", *STATE_SOURCES, *STATE_PARSED)
    rows = stage(rows, "rows", f"overlaps-{uuid.uuid4().hex}")
    state = DailyState(spark, scratch(spark, "state"), PERIOD)
    for k in (0, 1, 2, 1):
        state.add(rows.where(OVERLAPS[k]), f"w{k}")
    return state.totals()


def q_quarantine_rows(spark, sf_dir):
    """Accepted and rejected rows of a load whose contract some files and rows break."""
    apply_semantic_conf(spark)
    database, lake, inbox = f"q_{uuid.uuid4().hex[:12]}", scratch(spark, "lake"), scratch(spark, "quarantine")
    lines = report_lines(messages(spark, sf_dir, by_file=True))
    # a seventh of the files has no column CITY
    broken = F.when(F.col("file_no") % 7 == 3, F.replace(F.col("header"), F.lit("CITY"), F.lit("TOWN"))).otherwise(F.col("header"))
    write_report_files(lines.withColumn("header", broken), inbox)
    rules = Quarantine(not_null=("IDENTIFIER", "Provider_Directaddress", "Date Message Sent"))
    run_load(spark, LoadConfig(inbox, lake, database, quarantine=rules), WINDOW, RUN_DATE)
    remove_folder(spark, inbox)
    accepted = read_window(spark, f"`{database}`.`{DETAIL_TABLE}`", WINDOW).select(F.lit("accepted").alias("verdict"), "SRC_LOB")
    rejected = read_window(spark, f"`{database}`.`{REJECT_TABLE}`", WINDOW).select(F.col("reason").alias("verdict"), F.split(F.substring_index("file", "/", -1), "_")[1].alias("SRC_LOB"))
    return accepted.unionByName(rejected).groupBy("verdict", "SRC_LOB").agg(F.count("*").alias("n_rows"))


def q_alert_parts(spark, sf_dir):
    """The alert document, written as sorted parts, read back."""
    apply_semantic_conf(spark)
    path, _ = write_alert_parts(alert_lines(low_rate_alerts(messages(spark, sf_dir)), RUN_DATE), scratch(spark, "alerts"), RUN_DATE, WINDOW)
    return spark.read.text(path).select(F.col("value").alias("line"))


def q_archive_moves(spark, sf_dir):
    """What became of every file of an inbox: a second archiving finds that all were moved before."""
    files = stage(stage_inbox(spark, _inbox(spark, sf_dir, "archive")).files, "files", f"archive-{uuid.uuid4().hex}")
    target = scratch(spark, "archive")
    runs = [stage(archive_files(files, target, WINDOW), f"run{k}", f"archive-{uuid.uuid4().hex}").withColumn("run", F.lit(k)) for k in (1, 2)]
    moves = runs[0].unionByName(runs[1])
    return moves.select("run", F.substring_index("path", "/", -1).alias("file_name"), F.substring_index("target", "/", -1).alias("archived_as"), "outcome")


def messy(rows: DataFrame) -> DataFrame:
    """Report rows with the texts that real files hold, by row number and the last number of the identifier."""
    part = F.split("IDENTIFIER", "-")[2].cast("bigint")
    kind = (F.floor(part / 2) + F.col("ROW_NUMBER").cast("bigint")) % 16
    out = rows.withColumn("_kind", kind)  # before the row number changes
    kind = F.col("_kind")
    for c in ("Date Message Sent", "Date Failed/Confirmed", "FAX_Date Message Sent", "FAX_Date_Failed/Confirmed"):
        t = F.col(f"`{c}`")
        out = out.withColumn(
            c,
            F.when(kind == 0, F.translate(t, "APM", "apm"))  # am/pm in lower case is read as 24 hours
            .when(kind == 1, F.regexp_replace(t, r"\b0", ""))  # fields of one digit
            .when(kind == 2, F.concat(F.lit(" "), t))
            .when(kind == 3, F.replace(t, F.lit(" "), F.lit("  ")))
            .when(kind == 4, F.concat(t, F.lit(" trailing")))
            .when(kind == 5, F.substring_index(t, " ", 1))  # no time
            .when(kind == 6, F.replace(t, F.lit("/"), F.lit("-")))
            .when(kind == 7, F.concat(F.lit("13/40"), F.substr(t, F.lit(6))))
            .when(kind == 8, F.concat(F.substr(t, F.lit(1), F.lit(11)), F.lit("25:61:61 PM")))
            .when(kind == 9, F.concat(F.substr(t, F.lit(1), F.lit(10)), F.lit("abc")))
            .when(kind == 10, F.lit("junk"))
            .when(kind == 11, F.concat(F.substr(t, F.lit(1), F.lit(11)), F.lit("00:10:00 AM")))
            .otherwise(t),
        )
    number = F.col("ROW_NUMBER")
    out = out.withColumn("ROW_NUMBER", F.when(kind == 0, F.concat(number, F.lit(".7"))).when(kind == 1, F.lit("x")).when(kind == 2, F.concat(F.lit(" +"), number)).when(kind == 3, F.lit("99999999999")).otherwise(number))
    return out.withColumn("Sent_Date", F.when(kind == 12, F.lit(None).cast("date")).otherwise(F.col("Sent_Date"))).drop("_kind")


def _messy(spark, sf_dir) -> DataFrame:
    """Messy rows with each timestamp text parsed once."""
    apply_semantic_conf(spark)
    return with_parsed_times(messy(messages(spark, sf_dir)))


def q_parse_timestamps_messy(spark, sf_dir):
    m = _messy(spark, sf_dir)
    return m.select("IDENTIFIER", F.col("_sent_ts").alias("sent_ts"), F.col("_confirmed_ts").alias("confirmed_ts"), F.col("_sent_day").alias("message_date"))


def q_detail_messy(spark, sf_dir):
    return normalize_detail(_messy(spark, sf_dir), WINDOW)


def q_daily_summary_messy(spark, sf_dir):
    return summary_from_stats(daily_stats(_messy(spark, sf_dir)), WINDOW)


def q_alerts_messy(spark, sf_dir):
    return filter_alerts(rates_from_stats(daily_stats(_messy(spark, sf_dir))))


#: Queries of several jobs (files and tables are written on the way).
LOADS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "inbox_rows": q_inbox_rows,
    "load_detail": q_load_detail,
    "load_audit": q_load_audit,
    "audit_recent": q_audit_recent,
    "slices_summary": q_slices_summary,
    "slices_alerts": q_slices_alerts,
    "distinct_across_loads": q_distinct_across_loads,
    "quarantine_rows": q_quarantine_rows,
    "alert_parts": q_alert_parts,
    "archive_moves": q_archive_moves,
}
MESSY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_timestamps_messy": q_parse_timestamps_messy,
    "detail_messy": q_detail_messy,
    "daily_summary_messy": q_daily_summary_messy,
    "alerts_messy": q_alerts_messy,
}
assert len(RAW_COLUMNS) == len(REPORT_COLUMNS) + 2
