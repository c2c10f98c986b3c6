"""Corpus pipeline: documents through five operators of ``relaylens.llm``, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns a DataFrame with the columns of ``documents`` (the last one: the
token counts and digests). Stages are written as Parquet in between.

A stage's result is a plan over tables that the stage has written to the shared
folder. These are removed when the next stage begins, so a result must have been
written by then, as ``run`` does; the last stage's tables stay.

Defined results: rows of null, empty, blank or very long text, repeated rows and rows
without an id pass every stage as its module states (a null text is never toxic, a
duplicate or contaminated); empty tables give empty results; only the columns of
``documents`` are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaylens.llm import bpe, decontam, minhash, substring, toxicity
from relaylens.llm.common import recorded, removed, saved, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Tables that the stage before wrote for itself.
_SPENT: list[str] = []


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """``work``, which first removes the tables of the stage before it."""

    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        removed(spark, _SPENT)
        with recorded() as paths:
            out = work(spark, docs, sf_dir)
        _SPENT.extend(paths)
        return out

    return stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the rejection threshold."""
    scored = toxicity.toxicity(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))
    return scored.where(F.col("toxicity") < toxicity.REJECT_AT).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group the document with the least id (rows without one stay)."""
    kept = minhash.near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_kept")).distinct()
    named = docs.where("doc_id IS NOT NULL").join(kept, F.col("doc_id") == F.col("_kept"), "left_semi")
    return named.unionByName(docs.where("doc_id IS NULL")).select(*COLUMNS)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines and passages of 50 words and more that stand earlier in the corpus; n_chars follows the text."""
    out = substring.deduplicate_passages(docs.select(*COLUMNS)).withColumn("n_chars", F.char_length("text").cast("long"))
    return out.select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the texts that are left."""
    return bpe.encode_documents(docs, with_ids=False)


STAGES = [
    ("toxicity", _stage(drop_toxic)),
    ("minhash_near_dedup", _stage(drop_near_duplicates)),
    ("substring_dedup", _stage(cut_repeated_lines)),
    ("benchmark_decontamination", _stage(drop_contaminated)),
    ("bpe", _stage(encode)),
]

#: The first stages learn and cluster, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
