"""Parsing a text once by its parts equals the two-format recipe, on any text."""

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from relaylens.functions.timeparse import parse_report_text, parse_report_timestamp, report_date_part
from relaylens.operators.detail import normalize_detail, with_parsed_times
from relaylens.operators.summary import daily_stats
from relaylens.sources.messages import messages
from relaylens.plans.load_queries import messy

SF = "/root/testdata/sf0.001"

CASES = [
    "01/02/2021 03:04:05 PM", "1/2/2021 3:04:05 PM", "01/02/2021 13:04:05", "01/02/2021 03:04:05 pm", "01/02/2021",
    "12/31/2021 11:59:59 PM trailing", "13/40/2021 01:02:03", "junk", "", None, "01/02/2021 25:00:00", "01/02/2021 13:04:05 PM",
    "01/02/2021 00:10:00 AM", "01/02/2021 3:04 PM", "1/2/21 3:04:05 PM", " 01/02/2021 03:04:05", "01/02/2021abc", "01/02/2021  03:04:05",
    "\t01/02/2021 03:04:05", "01/02/2021 03:04:60", "01/02/2021 12:00:00 AM", "01/02/2021 12:00:00 PM", "02/29/2021 01:02:03", "02/29/2020 01:02:03",
    "1/1/0 1:1:1", "1/1/99999 1:1:1", "1/1/123456 1:1:1", "01/02/2021 03:04:05PM", "01/02/2021 03:04:05 PMPM", "AM 01/02/2021 03:04:05",
]
PIECES = st.sampled_from(["1", "01", "12", "13", "31", "2021", "0", "59", "60", "24", "/", ":", " ", "  ", "AM", "PM", "am", "x", "\t"])
SHAPED = st.builds(
    lambda lead, m, d, y, gap, h, mi, s, tail: f"{lead}{m}/{d}/{y}{gap}{h}:{mi}:{s}{tail}",
    st.sampled_from(["", " ", "\t"]), st.integers(0, 13), st.integers(0, 32), st.sampled_from([0, 1, 21, 2021, 99999, 100000]),
    st.sampled_from([" ", "  ", "", " \t"]), st.integers(0, 25), st.integers(0, 61), st.integers(0, 61), st.sampled_from(["", " AM", " PM", " pm", "PM", " x PM", " aM"]),
)


def differing(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("p", parse_report_text("t"))
    t = F.col("t")
    odd = df.where(~parse_report_timestamp(t).eqNullSafe(F.col("p.ts")) | ~report_date_part(t).eqNullSafe(F.col("p.day")))
    return [r["t"] for r in odd.select("t").collect()]


def test_fixed_cases(spark):
    assert differing(spark, CASES) == []
    df = spark.createDataFrame([(t,) for t in CASES[:2]], "t string").select(parse_report_text("t").alias("p"))
    assert {str(r["p"]["ts"]) for r in df.collect()} == {"2021-01-02 15:04:05"}


# no shrinking: each example is a Spark job
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck), phases=[Phase.generate])
@given(st.lists(st.one_of(st.lists(PIECES, max_size=14).map("".join), SHAPED), min_size=150, max_size=150))
def test_any_texts(spark, texts):
    assert differing(spark, texts) == []


def test_parsed_rows_give_the_same_detail_and_stats(spark):
    rows = messy(messages(spark, SF))
    parsed = with_parsed_times(rows)
    for f in (lambda df: normalize_detail(df, "w"), daily_stats):
        assert f(parsed).exceptAll(f(rows)).count() == 0 and f(rows).exceptAll(f(parsed)).count() == 0


def test_generated_methods_stay_small_enough_to_compile(spark, scratch_dir):
    """The parse and what a load does with parsed rows, each below HotSpot's limit of 8,000 bytes a method."""
    messages(spark, SF).write.parquet(f"{scratch_dir}/rows")
    raw = spark.read.parquet(f"{scratch_dir}/rows")
    with_parsed_times(raw).write.parquet(f"{scratch_dir}/parsed")
    parsed = spark.read.parquet(f"{scratch_dir}/parsed")
    seen = 0
    for df in (with_parsed_times(raw), normalize_detail(parsed, "w"), daily_stats(parsed)):
        text = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$").codegenString(df._jdf.queryExecution().executedPlan())
        sizes = [int(line.split("maxMethodCodeSize:")[1].split(";")[0]) for line in text.splitlines() if "maxMethodCodeSize:" in line]
        assert max(sizes, default=0) < 8000, sizes
        seen += len(sizes)
    assert seen > 0
