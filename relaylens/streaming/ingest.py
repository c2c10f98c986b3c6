"""Incremental ingest with Structured Streaming.

The inbox is watched by Spark's text file source. A micro-batch is the lines of the
files that arrived since the last one, each with its file; ``foreachBatch`` stages
them as a batch load does (``sources.inbox``) and runs a whole load over them, so no
list of files ever passes through the driver. The checkpoint records which files
were consumed, so a file is loaded once even if it is never moved; with
``archive_dir`` Spark's ``cleanSource=archive`` moves consumed files away.

``foreachBatch`` is at-least-once: a batch can run again after a failure. The load is
idempotent because its window id is derived from the batch (``<first file's
modification minute>-<batch id>``), so a replay replaces the same lake partitions,
the same window of the daily state and the same audit rows, and deletes and
re-appends the same warehouse window.

Loads of a stream are cumulative: summary and alerts come from the daily state, so a
backlog that is cut into batches gives what one batch would.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from relaylens.contract import REPORT_GLOB
from relaylens.functions.text import window_id_of
from relaylens.sources.inbox import Batch, stage_batch

#: Results of the newest loads that a query keeps.
KEPT_RESULTS = 100


def report_line_stream(
    spark: SparkSession,
    inbox: str,
    pattern: str = REPORT_GLOB,
    archive_dir: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming frame of the lines of newly arrived report files, each with its file and split."""
    reader = spark.readStream.format("text").option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(inbox).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("file_modified"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("value"),
    )


def batch_window_id(files: DataFrame, batch_id: int) -> str:
    """``<minute of the batch's oldest file>-<batch id>``: the same for a replay."""
    stamp = files.agg(window_id_of(F.min("file_modified")).alias("w")).first()["w"]
    return f"{stamp or '000000000000'}-{batch_id}"


def start_ingest(
    spark: SparkSession,
    inbox: str,
    checkpoint_location: str,
    process: Callable[[SparkSession, Batch, str, int], object],
    pattern: str = REPORT_GLOB,
    archive_dir: str | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the stream; ``process(spark, batch, window_id, batch_id)`` runs per batch of staged lines.

    ``available_now`` (default) drains what is there and stops -- the
    scheduled-job form of the original; ``processing_time`` keeps it running.
    """
    lines = report_line_stream(spark, inbox, pattern, archive_dir, max_files_per_trigger)

    def _run(rows: DataFrame, batch_id: int) -> None:
        numbered = rows.withColumn("line_no", F.monotonically_increasing_id())
        batch = stage_batch(numbered, f"stream-{uuid.uuid4().hex}")
        if batch.file_count:
            process(rows.sparkSession, batch, batch_window_id(batch.files, batch_id), batch_id)

    writer = lines.writeStream.foreachBatch(_run).option("checkpointLocation", checkpoint_location)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_load_stream(spark: SparkSession, cfg, checkpoint_location: str, run_date: str | None = None, **kwargs) -> StreamingQuery:
    """``start_ingest`` with the full, cumulative load (``plans.load``) as the batch step."""
    from relaylens.plans.load import run_load_on_batch

    # Moving consumed files is left to the stream (cleanSource), not the load.
    cfg = dataclasses.replace(cfg, archive_dir=None, cumulative=True)
    results: deque = deque(maxlen=KEPT_RESULTS)

    def _process(sess: SparkSession, batch: Batch, window_id: str, batch_id: int):
        results.append(run_load_on_batch(sess, cfg, batch, window_id, run_date))

    q = start_ingest(spark, cfg.inbox, checkpoint_location, _process, cfg.pattern, **kwargs)
    q.load_results = results  # type: ignore[attr-defined]
    return q
