"""Session helpers.

The library never creates a session behind the caller's back: every operator
takes DataFrames (or a ``SparkSession``) from the caller. ``build_session`` is
only a convenience for scripts, tests and the bench, with the settings the
semantics depend on (UTC, ANSI on, CORRECTED parser) and the settings that
matter at scale (AQE with skew handling and partition coalescing).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings our results depend on. ANSI stays on (the 4.x default); every place
# where the reference relied on null-on-error uses a try_* function instead.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.caseSensitive": "false",
}

# HotSpot never compiles a method of more than 8,000 bytes, so a fused stage above that runs interpreted, many times
# slower. With this limit Spark runs such a stage operator by operator, in generated methods that are compiled. It can be
# set in any session, unlike JIT_OPTIONS.
COMPILED_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Settings for the execution model: AQE re-plans joins and aggregations at
# run time, splits skewed shuffle partitions and merges tiny ones.
EXECUTION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.csv.filterPushdown.enabled": "true",
}


# Let the JIT compile large generated methods. Whole-stage codegen fuses a
# scan, a join, a wide projection and an aggregation into one method; above
# 8000 bytes of bytecode HotSpot would otherwise leave it interpreted. Only
# effective for JVMs this builder launches (driver in local mode, executors).
JIT_OPTIONS = "-XX:-DontCompileHugeMethods"


def build_session(
    master: str = "local[*]",
    app_name: str = "relaylens",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Create (or get) a session with the library's settings.

    ``shuffle_partitions`` defaults to the number of local cores; on a cluster
    leave it to the cluster configuration and AQE.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SEMANTIC_CONF)
    conf.update(EXECUTION_CONF)
    conf.setdefault("spark.driver.extraJavaOptions", JIT_OPTIONS)
    conf.setdefault("spark.executor.extraJavaOptions", JIT_OPTIONS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions is None:
        shuffle_partitions = os.cpu_count() or 8
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra_conf:
        conf.update(extra_conf)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_semantic_conf(spark)
    return spark


def apply_semantic_conf(spark: SparkSession) -> None:
    """Pin the runtime settings the results depend on, and the limit of fused stages (idempotent)."""
    for key, value in (SEMANTIC_CONF | COMPILED_CONF).items():
        spark.conf.set(key, value)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    Read from the session (``spark.checkpoint.dir``, which the cluster sets to
    shared storage). Only when it is unset -- local runs and tests -- a fresh
    temporary folder is made and registered, never on a cluster that names one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; on a cluster it must name a shared folder "
            "(a machine-local temporary folder would not survive a lost executor)"
        )
    local = tempfile.mkdtemp(prefix="relaylens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local
