"""Shards at limits that split the given table many times, against SQL."""

import duckdb
import pytest

from relaylens.llm import queries as Q
from relaylens.llm import sharding

MID = "/root/testdata/sf0.01"
COLUMNS = ("doc_id", "shard_id", "shard_depth", "shard_bytes", "row_bytes")


@pytest.mark.parametrize("times", [1, 8])
def test_split_buckets_equal_the_sql(spark, times):
    docs = spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "text")
    limit = times * docs.selectExpr("max(octet_length(text))").first()[0]  # no row exceeds it, so none needs a page
    got = sorted(tuple(r[c] for c in COLUMNS) for r in sharding.assign(docs, limit).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{MID}/documents.parquet'")
    assert got == sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({Q.op9_sql(limit)})").fetchall())
    assert len({r[1] for r in got}) > 12
    assert max(r[3] for r in got) <= limit


def test_split_goes_on_over_several_rounds(spark):
    """A bucket is split past the bits that one round looks at."""
    rows = [(i, "x" * 100) for i in range(20_000)]
    placed = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), limit=100)
    assert placed.count() == placed.select("shard_id").distinct().count() == 20_000
    assert placed.agg({"shard_depth": "max"}).first()[0] > 2 * sharding.BITS_A_ROUND - 1
