"""Backfill: copy a warehouse table into the lake table.

The snapshot is read over JDBC -- in parallel when the caller names a numeric
partition column and its bounds -- and written into the lake by its own
``WINDOW_ID`` partitions with dynamic overwrite -- an option of the write, not of
the session -- so running the backfill twice leaves one copy (the original appended
the whole snapshot each time) and other windows stay. Rows without a window are
refused: a backfill with any of them writes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from relaylens.contract import WINDOW_ID_COLUMN
from relaylens.sources import jdbc
from relaylens.sources.catalog import table_detail


def backfill(
    spark: SparkSession,
    source: jdbc.JdbcTarget,
    lake_table: str,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> int:
    """Copy ``source`` into ``lake_table``; returns the number of rows copied."""
    snap: DataFrame = jdbc.read_table(
        spark,
        source,
        partition_column=partition_column,
        lower_bound=lower_bound,
        upper_bound=upper_bound,
        num_partitions=num_partitions,
    )
    lake_cols = spark.table(lake_table).schema
    present = {c.lower(): c for c in snap.columns}
    shaped = snap.select(
        *[
            (F.col(f"`{present[f.name.lower()]}`") if f.name.lower() in present else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in lake_cols
        ]
    )
    return write_windows(shaped, lake_table)


def write_windows(df: DataFrame, lake_table: str) -> int:
    """Write rows of several windows, replacing these windows only; returns the number of rows."""
    spark = df.sparkSession
    detail = table_detail(spark, lake_table)
    obs = Observation("windows")
    named = F.coalesce(F.nullif(F.col(WINDOW_ID_COLUMN), F.lit("")), F.raise_error(F.lit(f"{WINDOW_ID_COLUMN} may not be null or empty")).cast("string"))
    rows = df.withColumn(WINDOW_ID_COLUMN, named).observe(obs, F.count(F.lit(1)).alias("rows"))
    rows.write.format(detail["provider"]).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(WINDOW_ID_COLUMN).save(detail["location"])
    if detail["provider"] != "delta":
        spark.catalog.recoverPartitions(lake_table.replace("`", ""))
        spark.catalog.refreshTable(lake_table)
    return int(obs.get["rows"])
