"""Every registered query against its SQL oracle (DuckDB) at sf0.001."""

import pytest

import __spark_entry__ as entry
from relaylens.plans import registry
from tools.oracle_check import digest, duck

SF = "/root/testdata/sf0.001"
KEYS = sorted(registry.QUERIES)  # those of the optional subpackage are tested with it


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(registry.oracle_sql()) == set(registry.QUERIES)
    assert set(registry.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(entry.oracle_sql()[key])
    want = rel.fetchall()
    assert len(rows) == len(want)
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, rows) == digest(rel.columns, want)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["SRC_LOB", "DT_MSG_SND"]
    assert df.count() > 0
