"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaylens.session import checkpoint_dir

#: What the contracts call lower-casing A-Z.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Most rows (and bytes) of one Arrow batch handed to Python, so that long texts don't add up.
BATCH_ROWS = 1000
BATCH_BYTES = "16m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark context, so that tasks can import it wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_relaylens_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="relaylens-package-"), "relaylens.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._relaylens_shipped = True


def small_batches(spark: SparkSession) -> None:
    """Prepare for Python tasks: the package is there, and one Arrow batch is bounded (texts may be very long)."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


#: Lists of paths that ``recorded`` blocks keep at present.
_RECORDS: list[list[str]] = []


def saved(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors. ``options`` are the writer's."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    for paths in _RECORDS:
        paths.append(path)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths of the tables that ``saved`` writes within the block."""
    paths: list[str] = []
    _RECORDS.append(paths)
    try:
        yield paths
    finally:
        _RECORDS[:] = [p for p in _RECORDS if p is not paths]


def removed(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that ``saved`` wrote and nothing reads any more; the list is empty afterwards."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(conf).delete(path, True)


#: What operators keep in a Python worker for its next tasks, by operator.
_KEPT: dict[str, dict] = {}


def kept_by(operator: str) -> dict:
    """What the operator keeps in this Python worker. What others kept goes: Spark hands a worker on from stage to stage, and
    it would hold all of them at once."""
    for other in [name for name in _KEPT if name != operator]:
        del _KEPT[other]
    return _KEPT.setdefault(operator, {})


def lower_ascii(column):
    return F.translate(column, UPPER, UPPER.lower())


def broadcast_if_small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Hint a broadcast only where the counted rows are within ``limit``; else Spark joins by shuffle."""
    return F.broadcast(df) if rows <= limit else df
