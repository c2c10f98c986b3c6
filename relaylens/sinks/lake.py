"""Lake writes, alert text and staging.

* ``write_partition`` replaces one partition of a lake table. The partition is named
  in the call and only its own folder is written, so the caller's session settings
  don't matter, loads of different windows can't meet (each has its own folder, its
  own temporary files and its own catalog entry), and running a load again -- after
  a failure, or by a replay of a stream's batch -- leaves exactly one copy of its
  rows. The row count is taken by ``observe`` on the write itself: no second scan.
* ``read_window`` reads one load back: the window is a value of a partition filter,
  so only that partition is listed and read.
* ``stage`` writes a frame as Parquet under the shared checkpoint folder and
  reads it back: lineage is cut, a lost executor re-reads a file instead of
  re-parsing the CSV inputs, and later steps read only the columns they need.
* Disk: a write's shuffle files go when it is done (``shuffles_dropped``), staged
  texts can be packed tighter, and what is spent can be removed.
"""

from __future__ import annotations

import contextlib
import threading
from collections.abc import Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from relaylens.contract import WINDOW_ID_COLUMN
from relaylens.session import checkpoint_dir
from relaylens.sources.catalog import table_detail


#: Where a staged frame is packed by zstd: the level that costs little more than snappy.
ZSTD_FAST = {"parquet.compression.codec.zstd.level": "1"}
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Sessions that write at present: how many writes, and the setting before the first of them.
_WRITING: dict[SparkSession, tuple[int, str | None]] = {}
_WRITING_LOCK = threading.Lock()


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within the block, a query's shuffle files are removed when it ends, not when the driver's JVM happens to collect them.

    The setting before holds again after the last of the session's blocks (loads may run in several threads).
    """
    with _WRITING_LOCK:
        n, before = _WRITING.get(spark) or (0, spark.conf.get(_DROP_SHUFFLES, None))
        _WRITING[spark] = n + 1, before
        spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _WRITING_LOCK:
            n, before = _WRITING.pop(spark)
            if n > 1:
                _WRITING[spark] = n - 1, before
            elif before is None:
                spark.conf.unset(_DROP_SHUFFLES)
            else:
                spark.conf.set(_DROP_SHUFFLES, before)


def partition_folder(spark: SparkSession, location: str, spec: dict[str, str]) -> str:
    """The folder of a partition, by the catalog's own rules for odd characters."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join([location.rstrip("/"), *(utils.getPartitionPathString(k, v) for k, v in spec.items())])


def write_partition(df: DataFrame, qualified: str, spec: dict[str, str], optimize_write: bool = False) -> int:
    """Replace the partition ``spec`` (every partition column, in order) of a lake table; returns the rows written.

    Columns go by name; a column that ``df`` lacks is an error. A partition value
    may be neither null nor empty. ``optimize_write`` adds a ``REBALANCE`` (AQE sizes
    the output files; one extra shuffle of the batch).
    """
    spark = df.sparkSession
    for name, value in spec.items():
        if not value:
            raise ValueError(f"{name} of {qualified} may not be null or empty")
    detail = table_detail(spark, qualified)
    obs = Observation("partition_write")
    fields = [f for f in spark.table(qualified).schema if f.name not in spec]
    rows = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields]).observe(obs, F.count(F.lit(1)).alias("rows"))
    if optimize_write:
        rows = rows.hint("rebalance")
    literals = {k: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for k, v in spec.items()}
    if detail["provider"] == "delta":
        where = " AND ".join(f"`{k}` = {v}" for k, v in literals.items())
        whole = rows.select("*", *[F.lit(v).alias(k) for k, v in spec.items()])
        whole.write.format("delta").mode("overwrite").option("replaceWhere", where).save(detail["location"])
    else:
        with shuffles_dropped(spark):
            rows.write.format(detail["provider"]).mode("overwrite").save(partition_folder(spark, detail["location"], spec))
        spark.sql(f"ALTER TABLE {qualified} ADD IF NOT EXISTS PARTITION ({', '.join(f'`{k}` = {v}' for k, v in literals.items())})")
        spark.catalog.refreshTable(qualified)
    return int(obs.get["rows"])


def write_window(df: DataFrame, qualified: str, window_id: str, optimize_write: bool = False) -> int:
    """Write one load into its ``WINDOW_ID`` partition, replacing it."""
    return write_partition(df, qualified, {WINDOW_ID_COLUMN: window_id}, optimize_write)


def read_window(spark: SparkSession, qualified: str, window_id: str, column: str = WINDOW_ID_COLUMN) -> DataFrame:
    """The rows of one load of a lake table (the window as a bound value, never as SQL text)."""
    return spark.sql("SELECT * FROM IDENTIFIER(:name) WHERE IDENTIFIER(:col) = :window", args={"name": qualified, "col": column, "window": window_id})


def table_count(spark: SparkSession, qualified: str) -> int:
    """Whole-table row count (Parquet footers answer it; no column is read)."""
    return spark.table(qualified).count()


def write_alert_parts(lines: DataFrame, alerts_dir: str, run_date: str, window_id: str) -> tuple[str, int]:
    """Write an alert document (``operators.alerts.alert_lines``) as sorted text parts; returns (folder, alerts).

    The lines are range-partitioned by their order, so the parts, in name order, are
    the document, whatever its size; header and footer are its first and last line.
    Nothing is written where there is no alert. The folder carries both the run date
    and the window id, so a second run on the same day does not replace the first.
    """
    path = f"{alerts_dir.rstrip('/')}/alert_date={run_date}/window_id={window_id}"
    obs = Observation("alert_lines")
    ordered = lines.repartitionByRange("section", "line").sortWithinPartitions("section", "line")
    ordered.observe(obs, F.count_if(F.col("section") == 1).alias("alerts")).select("line").write.mode("overwrite").text(path)
    return path, int(obs.get["alerts"])


def stage(df: DataFrame, name: str, window_id: str) -> DataFrame:
    """Write ``df`` as Parquet under ``<checkpoint dir>/staging/<window>/<name>``
    and return a frame that reads it back."""
    return stage_counted(df, name, window_id)[0]


def stage_counted(df: DataFrame, name: str, window_id: str, codec: str | None = None) -> tuple[DataFrame, int]:
    """``stage`` that also returns the number of rows written, observed on the
    write itself (no second job). ``codec``: how the files are packed, if not as the session has it."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/staging/{window_id}/{name}"
    obs = Observation(f"stage_{name}")
    with shuffles_dropped(spark):
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").options(**ZSTD_FAST).parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path), int(obs.get["rows"])


def unstage(spark: SparkSession, name: str, window_id: str) -> None:
    """Remove a staged frame that nothing reads any more."""
    remove_folder(spark, f"{checkpoint_dir(spark)}/staging/{window_id}/{name}")


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder with all it holds; one that isn't there is no error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
