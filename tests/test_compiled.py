"""Report rows are parsed in compiled code, and what belongs to a file is found once a file."""

from pyspark.sql import functions as F

from relaylens.functions.casts import text_to_bigint, text_to_int
from relaylens.plans.load_queries import report_lines
from relaylens.session import apply_semantic_conf
from relaylens.sources.inbox import batch_rows
from relaylens.sources.messages import messages
from relaylens.sources.reports import stage_inbox
from tests.conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_report_lines_are_made_without_interpreted_lambdas(spark):
    assert "lambda" not in plan_of(report_lines(messages(spark, SF_SMALL)))


def test_a_session_does_not_fuse_more_than_the_jvm_compiles(spark):
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
        apply_semantic_conf(spark)
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", before)


def test_columns_that_a_file_lacks_are_found_before_its_rows_are_joined(spark, scratch_dir):
    for name, header in (("A_X_d_01022021_1_report.csv", "IDENTIFIER,CITY"), ("A_Y_d_01022021_1_report.csv", "identifier,TOWN")):
        with open(f"{scratch_dir}/{name}", "w") as f:
            f.write(f"{header}\n1,a\n2,b\n")
    rows = batch_rows(stage_inbox(spark, scratch_dir), ["IDENTIFIER", "CITY"])
    assert not {"header", "names"} & set(rows.columns)
    got = sorted((r["SRC_LOB"], r["IDENTIFIER"], r["_line"], r["_lacks"]) for r in rows.collect())
    assert got == [("X", "1", "1,a", []), ("X", "2", "2,b", []), ("Y", "1", "1,a", ["CITY"]), ("Y", "2", "2,b", ["CITY"])]


def test_integer_texts_are_read_as_by_a_cast_that_drops_fractions(spark):
    texts = ["7", " +7 ", "-2147483648", "2147483648", "12.7", ".5", ".", "", "x", "1 2", "\x017\x7f", "9223372036854775808", "0" * 20 + "5", "1234567890123456789", "-0.", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", text_to_int("t").alias("a"), text_to_bigint("t").alias("b")).orderBy(F.col("i")).collect()
    assert [r["a"] for r in got] == [7, 7, -2147483648, None, 12, 0, 0, None, None, None, 7, None, 5, None, 0, None]
    assert [r["b"] for r in got] == [7, 7, -2147483648, 2147483648, 12, 0, 0, None, None, None, 7, None, 5, 1234567890123456789, 0, None]
