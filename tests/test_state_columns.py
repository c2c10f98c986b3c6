"""The daily state needs only the texts that it reads parsed."""

from pyspark.sql import functions as F

from relaylens.operators.detail import PARSED_DAY, PARSED_TIMES, with_parsed_times
from relaylens.operators.summary import daily_stats
from relaylens.plans.load_queries import AUDITED_LOADS, STATE_PARSED, STATE_SOURCES, audited_rows
from relaylens.session import apply_semantic_conf
from relaylens.sources.messages import messages


def test_state_needs_no_fax_texts(spark):
    apply_semantic_conf(spark)
    assert STATE_PARSED == [PARSED_TIMES["Date Message Sent"], PARSED_TIMES["Date Failed/Confirmed"], PARSED_DAY]
    sent, confirmed = ["01/02/2021 03:04:05 PM", "1/2/2021 15:04:05", None, "junk"], "01/02/2021 04:04:05 PM"
    values = {"Provider_Directaddress": "a", "NPI Match Status": "Found", "Direct Status": "Confirmed", "Date Failed/Confirmed": confirmed}
    rows = messages(spark, "/root/testdata/sf0.001").limit(0)
    made = spark.createDataFrame([(s,) for s in sent], "`Date Message Sent` string")
    for c in rows.columns:
        if c != "Date Message Sent":
            made = made.withColumn(c, F.lit("2021-01-01").cast("date") if c == "Sent_Date" else F.lit(values.get(c, "x")))
    parsed = with_parsed_times(made.select(*[F.col(f"`{c}`") for c in rows.columns]))
    few = parsed.select(*[F.col(f"`{c}`") for c in [*STATE_SOURCES, *STATE_PARSED]])
    assert sorted(map(tuple, daily_stats(few).collect())) == sorted(map(tuple, daily_stats(parsed).collect()))


def test_audited_rows_come_in_order_of_their_load(spark):
    """Sorted before they have texts, so that the write by load sorts no rows of text."""
    apply_semantic_conf(spark)
    rows = audited_rows(spark, "/root/testdata/sf0.001")
    plan = rows._jdf.queryExecution().optimizedPlan()
    assert not plan.outputOrdering().isEmpty()
    assert "IDENTIFIER" in plan.toString().split("Sort [_load")[0] and "IDENTIFIER" not in plan.toString().split("Sort [_load")[1]
    wrong = rows.where(~F.col("_load").eqNullSafe(F.month("Sent_Date") % AUDITED_LOADS))
    assert wrong.count() == 0 and rows.count() == messages(spark, "/root/testdata/sf0.001").count()
