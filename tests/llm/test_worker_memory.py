"""What an operator keeps in a Python worker goes when the next operator's tasks begin there."""

import pandas as pd

from relaylens.llm import bpe, substring, toxicity
from relaylens.llm.common import kept_by, saved


def _workers_kept(spark):
    def run(batches):
        from relaylens.llm import common

        for batch in batches:
            yield pd.DataFrame({"names": [",".join(sorted(common._KEPT))] * len(batch)})

    return {r["names"] for r in spark.range(0, 4, 1, 1).mapInPandas(run, "names string").collect()}


def test_one_encoder_is_loaded_once():
    assert bpe.load("word_bpe_49k.json") is bpe.load("word_bpe_49k.json")


def test_encoder_goes_when_another_operator_begins():
    first = bpe.load("word_bpe_49k.json")
    assert kept_by("toxicity") == {}
    assert list(kept_by("bpe")) == []
    assert bpe.load("word_bpe_49k.json") is not first


def test_scoring_frees_the_encoder_of_its_worker(spark):
    docs = spark.createDataFrame([(1, "some words here"), (2, None)], "doc_id long, text string").coalesce(1)
    encoded = bpe.encode_documents(docs, with_ids=False).collect()
    assert len(encoded) == 2
    scored = toxicity.score_documents(docs, toxicity.Lexicon({"idiot": False}, {("idiot", 0, False): 0.9})).collect()
    assert len(scored) == 2
    assert "bpe" not in _workers_kept(spark)


def test_cutting_takes_one_worker_a_task(spark):
    docs = spark.createDataFrame([(1, "a b c\nd e f\na b c"), (2, None), (3, "a b c"), (None, "x")], "doc_id long, text string")
    units = spark.createDataFrame([(1, 12, 17), (1, 0, 5), (1, 2, 9)], "_id long, start int, end int").join(docs.selectExpr("doc_id AS _id", "xxhash64(text) AS _h"), "_id")
    out = substring.without(docs, units, "doc_id", "text")
    assert out._jdf.queryExecution().executedPlan().toString().count("+- ArrowEvalPython") == 1
    found = {r["doc_id"]: (r["text"], [tuple(s) for s in r["removed_spans"]]) for r in out.collect()}
    assert found == {1: (" f", [(0, 9), (12, 17)]), 2: (None, []), 3: ("a b c", []), None: ("x", [])}


def test_no_stage_of_the_substring_step_has_two_python_steps(spark, monkeypatch):
    plans = {}

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return saved(df, name)

    monkeypatch.setattr(substring, "saved", noted)
    words = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))
    docs = spark.createDataFrame([(1, words), (2, f"x {words}\ny"), (3, None)], "doc_id long, text string")
    out = substring.deduplicate_passages(docs)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: words, 2: "x \ny", 3: None}
    steps = {name: [plan.count(f"- {step} ") for step in ("ArrowEvalPython", "MapInPandas")] for name, plan in plans.items()}
    assert steps["substring-stretches"] == [1, 0]
    assert steps["passage-anchors"] == [1, 1] and "SortMergeJoin" in plans["passage-anchors"].split("MapInPandas")[0]
