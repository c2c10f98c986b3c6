"""Extendible-hashing shards under a byte limit.

A row's key hashes to 60 bits. The directory is indexed by the leading bits of
the hash: a bucket whose rows exceed the limit splits on its next bit, others
stay, until each bucket fits. Only (hash prefix, bytes) sums are shuffled, never
texts; the directory (one row per bucket) stays a table.

Defined results: a null or empty text has 0 bytes; a null key hashes as the text
``null``; an empty table has no shards. Rows that no bit separates (repeated
rows, one row above the limit) share a bucket at depth 60; it is dealt into
overflow pages in the order of (key, ordinal) so that a page fits the limit, but
for a single row that exceeds it by itself. Extra columns are kept by ``assign``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaylens.llm.common import broadcast_if_small, saved

HASH_BITS = 60
#: Bytes of text in one shard at most.
DEFAULT_LIMIT = 32 * 1024 * 1024
#: Bits that one round of splitting looks ahead; a round is one aggregation over bucket sums.
BITS_A_ROUND = 12
#: Directory rows up to which the directory is broadcast (24 bytes a row); beyond, it is joined by shuffle.
BROADCAST_ROWS = 100_000


def key_hash(*keys: str | Column) -> Column:
    """Leading 60 bits of the MD5 of the keys' texts."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string") if isinstance(k, str) else k.cast("string"), F.lit("null")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def directory(sized: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Buckets (depth int, prefix long, bytes long, n_rows long) of rows (_h long, _bytes long).

    ``prefix`` holds the leading ``depth`` bits. Each round sums the rows of the
    oversized buckets at the next 12 depths at once: a bucket is a leaf at the
    first depth where it fits (its parent doesn't).
    """
    open_rows = saved(sized.groupBy("_h").agg(F.sum("_bytes").alias("_bytes"), F.count("*").alias("_n")), "shard-sums")
    leaves = None
    depth = 0
    whole = open_rows.agg(F.coalesce(F.sum("_bytes"), F.lit(0)).alias("b"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()
    spark = sized.sparkSession
    schema = "depth int, prefix long, bytes long, n_rows long"
    if whole["n"] == 0:
        return spark.createDataFrame([], schema)
    if whole["b"] <= limit:
        return spark.createDataFrame([(0, 0, whole["b"], whole["n"])], schema)
    pending = open_rows.withColumn("_top", F.lit(0).cast("long"))
    while True:
        deepest = min(depth + BITS_A_ROUND, HASH_BITS)
        # sums at the round's deepest level, from which the levels above follow
        cells = pending.groupBy(F.shiftright("_h", HASH_BITS - deepest).alias("prefix")).agg(F.sum("_bytes").alias("bytes"), F.sum("_n").alias("n_rows"))
        cells = saved(cells, "shard-cells")
        levels = F.explode(F.sequence(F.lit(depth + 1), F.lit(deepest))).alias("depth")
        at = cells.select(levels, "prefix", "bytes", "n_rows").select("depth", F.expr(f"shiftright(prefix, {deepest} - depth)").alias("prefix"), "bytes", "n_rows")
        sums = at.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("n_rows").alias("n_rows"))
        big = sums.where(F.col("bytes") > limit).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("_parent"))
        fits = sums.where((F.col("bytes") <= limit) | (F.col("depth") == HASH_BITS)).withColumn("_parent", F.shiftright("prefix", 1))
        first = fits.where(F.col("depth") == depth + 1).drop("_parent")
        later = fits.where(F.col("depth") > depth + 1).join(big, ["depth", "_parent"], "left_semi").drop("_parent")
        found = first.unionByName(later).select(F.col("depth").cast("int").alias("depth"), "prefix", "bytes", "n_rows")
        leaves = found if leaves is None else leaves.unionByName(found)
        if deepest == HASH_BITS:
            return saved(leaves, "shard-directory")
        over = cells.where(F.col("bytes") > limit).select(F.col("prefix").alias("_top"))
        if over.isEmpty():
            return saved(leaves, "shard-directory")
        pending = pending.drop("_top").withColumn("_top", F.shiftright("_h", HASH_BITS - deepest)).join(over, "_top", "left_semi")
        depth = deepest


def assign(docs: DataFrame, limit: int = DEFAULT_LIMIT, key_columns: tuple[str, ...] = ("doc_id",), text_column: str = "text") -> DataFrame:
    """Each row with shard_id (the bucket's bits, with ``-page`` after an overflow bucket's), shard_depth, shard_bytes (its bucket's sum) and row_bytes."""
    kept = [c for c in docs.columns if c not in ("shard_id", "shard_depth", "shard_bytes", "row_bytes")]
    rows = docs.select(*kept, key_hash(*key_columns).alias("_h"), F.coalesce(F.octet_length(text_column), F.lit(0)).cast("long").alias("_bytes"))
    buckets = directory(rows.select("_h", "_bytes"), limit)
    depths = [r["depth"] for r in buckets.select("depth").distinct().collect()]  # at most 61 values
    n = buckets.count()
    # one equi-join: a row's possible buckets are its prefixes at the depths in use; each row has exactly one
    keys = buckets.select(F.struct("depth", "prefix").alias("_bucket"), F.col("depth").alias("shard_depth"), F.col("bytes").alias("shard_bytes"), F.col("prefix").alias("_prefix"))
    hashes = rows.select("_h").distinct()
    tries = hashes.select("_h", F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), F.shiftright("_h", HASH_BITS - d).alias("prefix")) for d in depths] or [F.struct(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("prefix"))])).alias("_bucket"))
    placed = tries.join(broadcast_if_small(keys, n, BROADCAST_ROWS), "_bucket").select("_h", "shard_depth", "shard_bytes", "_prefix")
    bits = F.when(F.col("shard_depth") == 0, F.lit("root")).otherwise(F.expr("lpad(conv(cast(_prefix as string), 10, 2), shard_depth, '0')"))
    out = rows.join(placed, "_h").withColumn("shard_id", bits)
    if HASH_BITS in depths and not buckets.where((F.col("depth") == HASH_BITS) & (F.col("bytes") > limit)).isEmpty():
        out = _with_pages(out, limit)
    return out.select(*kept, "shard_id", F.col("shard_depth").cast("int").alias("shard_depth"), "shard_bytes", F.col("_bytes").alias("row_bytes"))


def _with_pages(placed: DataFrame, limit: int) -> DataFrame:
    """Overflow pages for buckets that no bit splits: page = rows of the largest size seen that fit the limit.

    The rows of such a bucket share their whole hash, hence their key. Ordinals
    come from two levels (per partition counts, then offsets), so no task sorts
    a whole bucket; partition counts are written first, so they stay as counted.
    """
    over = (F.col("shard_depth") == HASH_BITS) & (F.col("shard_bytes") > limit)
    parts = placed.where(over).withColumn("_serial", F.monotonically_increasing_id())
    parts = saved(parts, "shard-overflow").withColumn("_part", F.shiftright("_serial", 33))
    most = parts.groupBy("_h").agg(F.max("_bytes").alias("_most"))
    counts = parts.groupBy("_h", "_part").agg(F.count("*").alias("_c"), F.min("_serial").alias("_first"))
    from pyspark.sql import Window

    order = Window.partitionBy("_h").orderBy("_part")  # one row per (bucket, partition)
    offsets = counts.withColumn("_before", F.sum("_c").over(order) - F.col("_c")).join(most, "_h")
    # serials grow by one within a partition, so rows of other buckets may lie between; pages hold at most `per` serials
    per = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(limit) / F.greatest(F.col("_most"), F.lit(1))))
    paged = parts.join(offsets, ["_h", "_part"]).withColumn("shard_id", F.concat_ws("-", "shard_id", "_part", F.floor((F.col("_serial") - F.col("_first")) / per).cast("string")))
    return placed.where(~over).unionByName(paged.select(*placed.columns))


def write_shards(docs: DataFrame, path: str, limit: int = DEFAULT_LIMIT, **names) -> DataFrame:
    """Write the rows partitioned by shard and return the shard table (shard_id, bytes, n_rows).

    Rows are dealt to tasks by shard; a shard is at most ``limit`` bytes, so no task is larger.
    """
    placed = assign(docs, limit, **names)
    placed.repartition("shard_id").write.partitionBy("shard_id").parquet(path)
    written = docs.sparkSession.read.parquet(path)
    return written.groupBy("shard_id").agg(F.sum("row_bytes").alias("bytes"), F.count("*").alias("n_rows"))
