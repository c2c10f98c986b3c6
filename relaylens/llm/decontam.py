"""Benchmark decontamination over a distributed positional inverted index.

``build_index`` stores one posting (term, document, position) per corpus word that
the test items use, and one end mark per document that carries its length. To find
an item's windows of ``window`` words, the two rarest terms of each window (by
corpus count) are looked up: their posting lists, each position less the term's
offset in the item, are intersected on (document, item, start). What is left is
checked against the lists of all the item's other terms, and runs of matching
words of at least a window are exact phrase matches. ``proximity_matches`` asks
for all terms of an item within a span of words, in any order.

Only DataFrame and SQL functions are used. The item vocabulary is broadcast while
its counted size is within a bound; beyond it, it is joined by shuffle, as
candidates are.

Defined results: a null text has no words; an item without words, or with a null
id, is never found; items of the same id count once; an item shorter than a window
is one window. Documents are told apart by (id, text), so repeated rows get equal
results, one row each; a null id is an id like others. Empty tables give no
matches. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relaylens.llm.common import broadcast_if_small, lower_ascii, saved

WINDOW = 10
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Terms, windows or document ids up to which a side is broadcast (at most 100 bytes each).
BROADCAST_ROWS = 500_000
#: The end mark is no word: words are never empty.
END = ""
END_TERM = -1


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def item_terms(items: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(item, n, offset, word) of the distinct items with words; ``item`` is (id, text hash)."""
    named = items.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("string").alias("item_id"), words_of(F.col(text_column)).alias("_words")).distinct()
    item = F.struct("item_id", F.xxhash64("_words").alias("h")).alias("item")
    return named.where(F.size("_words") > 0).select(item, F.size("_words").alias("n"), F.posexplode("_words").alias("offset", "word"))


def build_index(docs: DataFrame, vocabulary: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Postings (term long, doc struct<id, h>, pos int) of the vocabulary's words, written to the shared folder.

    ``vocabulary``: (word, term). A document's end mark has term -1 and its word count as position.
    Terms are cut down where the words are made, so nothing is shuffled.
    """
    marks = vocabulary.unionByName(vocabulary.sparkSession.createDataFrame([(END, END_TERM)], "word string, term long"))
    n = marks.count()
    words = docs.select(F.struct(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("h")).alias("doc"), F.posexplode(F.concat(words_of(F.col(text_column)), F.array(F.lit(END)))).alias("pos", "word"))
    return saved(words.join(broadcast_if_small(marks, n, BROADCAST_ROWS), "word").select("term", "doc", "pos"), "postings")


class Contamination:
    """The index of a corpus against a set of test items."""

    def __init__(self, docs: DataFrame, items: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text"):
        terms = item_terms(items, item_column, item_text_column)
        # a word's number need only be unique and, once written, stay
        vocabulary = saved(terms.select("word").distinct().withColumn("term", F.monotonically_increasing_id()), "vocabulary")
        self.terms = saved(terms.join(vocabulary, "word").select("item", "n", "offset", "term"), "items")
        self.window = window
        self.index = build_index(docs, vocabulary, id_column, text_column)
        self.counts = saved(self.index.where(F.col("term") != END_TERM).groupBy("term").agg(F.count("*").alias("cf")), "term-counts")

    def lengths(self) -> DataFrame:
        """(doc, n_words), one row per corpus row."""
        return self.index.where(F.col("term") == END_TERM).select("doc", F.col("pos").cast("long").alias("n_words"))

    def anchors(self) -> DataFrame:
        """(pair, item, o1, t1, o2, t2): per window its two rarest terms, offsets in the item; windows share pairs."""
        at = self.terms.join(self.counts, "term")
        first = F.greatest(F.lit(0), F.col("offset") - self.window + 1)
        last = F.least(F.col("offset"), F.greatest(F.lit(0), F.col("n") - self.window))
        within = at.select("item", F.least("n", F.lit(self.window)).alias("k"), F.explode(F.sequence(first, last)).alias("w"), F.struct("cf", "offset", "term").alias("t"))
        # a window with a term that the corpus lacks has too few rows here and can't occur
        whole = within.groupBy("item", "k", "w").agg(F.sort_array(F.collect_list("t")).alias("ts")).where(F.size("ts") == F.col("k"))
        rare, next_rare = F.col("ts")[0], F.try_element_at("ts", F.lit(2))
        pairs = whole.select("item", rare["offset"].alias("o1"), rare["term"].alias("t1"), F.coalesce(next_rare["offset"], rare["offset"]).alias("o2"), F.coalesce(next_rare["term"], rare["term"]).alias("t2")).distinct()
        return pairs.withColumn("pair", F.xxhash64("item", "o1", "o2"))

    def candidates(self) -> DataFrame:
        """(doc, item, start): starts (position of the item's first word) at which two rarest terms stand in place."""
        pairs = saved(self.anchors(), "anchors")
        n = pairs.count()
        lists = pairs.select("item", "pair", F.explode(F.array(F.struct(F.lit(1).alias("side"), F.col("t1").alias("term"), F.col("o1").alias("o")), F.struct(F.lit(2).alias("side"), F.col("t2").alias("term"), F.col("o2").alias("o")))).alias("s")).select("item", "pair", "s.side", "s.term", "s.o")
        hits = self.index.join(broadcast_if_small(lists, 2 * n, BROADCAST_ROWS), "term").select("doc", "pair", (F.col("pos") - F.col("o")).alias("start"), "side")
        both = hits.groupBy("doc", "pair", "start").agg(F.bit_or("side").alias("sides")).where("sides = 3")
        items = pairs.select("pair", "item")
        return saved(both.join(broadcast_if_small(items, n, BROADCAST_ROWS), "pair").select("doc", "item", "start").distinct(), "candidates")

    def phrase_matches(self) -> DataFrame:
        """(doc, item, start, first, last): runs of at least a window (or a whole shorter item) of item words, positions in the document."""
        found = self.candidates()
        named = saved(found.select("doc").distinct(), "candidate-docs")
        own = self.index.join(broadcast_if_small(named, named.count(), BROADCAST_ROWS), "doc", "left_semi")
        wanted = found.join(broadcast_if_small(self.terms, self.terms.count(), BROADCAST_ROWS), "item").select("doc", "item", "n", "start", "offset", "term", (F.col("start") + F.col("offset")).alias("pos"))
        matched = wanted.join(own, ["doc", "pos", "term"]).select("doc", "item", "n", "start", "offset", "pos").distinct()
        # words of one run have the same difference of offset and rank; a group is at most one item long
        order = Window.partitionBy("doc", "item", "start").orderBy("offset")
        runs = matched.withColumn("run", F.col("offset") - F.row_number().over(order)).groupBy("doc", "item", "n", "start", "run").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
        return runs.where(F.col("last") - F.col("first") + 1 >= F.least("n", F.lit(self.window))).select("doc", "item", "start", "first", "last")

    def proximity_matches(self, slop: int = 5) -> DataFrame:
        """(doc, item, at): the item's rarest term stands at ``at`` and each other distinct term of the item within
        n + slop words of it, in any order. Positions meet in blocks of that span, so the join is an equi-join."""
        at = self.terms.join(self.counts, "term").groupBy("item", "n", "term").agg(F.max("cf").alias("cf"))
        distinct = self.terms.groupBy("item").agg(F.count_distinct("term").alias("_need"))
        ranked = at.groupBy("item", "n").agg(F.sort_array(F.collect_list(F.struct("cf", "term"))).alias("ts")).join(distinct, "item").where("size(ts) = _need")
        rare = ranked.select("item", "n", "_need", F.col("ts")[0]["term"].alias("term"))
        span = F.col("n") + slop
        anchor = self.index.join(F.broadcast(rare) if rare.count() <= BROADCAST_ROWS else rare, "term").select("doc", "item", "_need", span.alias("span"), F.col("pos").alias("at"))
        blocks = anchor.select("*", F.explode(F.sequence(F.floor((F.col("at") - F.col("span")) / F.col("span")), F.floor((F.col("at") + F.col("span")) / F.col("span")))).alias("block"))
        terms = ranked.select("item", span.alias("span"), F.explode("ts.term").alias("term"))
        others = self.index.join(broadcast_if_small(terms, terms.count(), BROADCAST_ROWS), "term").select("doc", "item", "term", "pos", F.floor(F.col("pos") / F.col("span")).alias("block"))
        near = blocks.join(others, ["doc", "item", "block"]).where(F.abs(F.col("pos") - F.col("at")) <= F.col("span"))
        return near.groupBy("doc", "item", "at", "_need").agg(F.count_distinct("term").alias("_got")).where("_got = _need").select("doc", "item", "at")

    def report(self) -> DataFrame:
        """(doc, n_words, n_hit, n_items, item_ids array, contaminated), one row per corpus row."""
        runs = saved(self.phrase_matches(), "phrases")
        words = runs.select("doc", F.explode(F.sequence("first", "last")).alias("pos")).distinct().groupBy("doc").agg(F.count("*").alias("n_hit"))
        named = runs.select("doc", "item.item_id").distinct().groupBy("doc").agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"))
        hits = words.join(named, "doc").withColumnRenamed("doc", "_doc")
        out = self.lengths().join(hits, F.col("doc").eqNullSafe(F.col("_doc")), "left")
        ids = F.coalesce("item_ids", F.array().cast("array<string>"))
        return out.select("doc", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"), F.col("n_hit").isNotNull().alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id") -> DataFrame:
    """The rows of ``docs`` without those that hold a window of a test item."""
    runs = Contamination(docs, items, window, id_column, text_column, item_column).phrase_matches()
    bad = saved(runs.select(F.col("doc.id").alias("_bad_id"), F.col("doc.h").alias("_bad_h")).distinct(), "contaminated")
    same = F.col(id_column).eqNullSafe(F.col("_bad_id")) & (F.xxhash64(F.col(text_column)) == F.col("_bad_h"))
    return docs.join(broadcast_if_small(bad, bad.count(), BROADCAST_ROWS), same, "left_anti")
