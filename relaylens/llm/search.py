"""Ranked lexical search by pipelined term partitioning.

Documents are indexed in shards (one Arrow batch each) as posting lists: a term's
document numbers within the shard and its occurrences there. The items' terms are
dealt to ``STAGES`` term owners, rare terms first, so that each owner holds about
the same number of postings. An item bundle holds, per shard, the documents' lengths
and sparse accumulators (item, document, score). Bundles pass through the owners one
after the other: each stage cogroups the bundles with the owner's postings by shard,
adds the integer contributions of its terms and hands the bundles on. The last stage
gives each shard's best documents of every item, and a window keeps the best of all.

Between stages, accumulators that can't reach the result any more are left out. After
each stage the ``top``-th best sum of an item over all shards is known; sums only
grow, so it bounds the final one from below. A document whose sum plus the most that
the terms of later owners can add (their weight at the largest count in the shortest
document) is below that bound can't be among the first ``top``, so the result is the
same with or without it. No other limit is applied.

Scores are integers: w * ((10**9 * tf) div (1000 * tf + 8 * m)) summed over the
item's terms, repeats included, with w = floor(1000 * ln((2N + 2) / (2 df + 1))) and
m = 100 - 75 + (75 n N) div L.

Items are taken in blocks of bounded size (bytes of their terms), so the term list
that is broadcast and the accumulators of a shard are bounded by the block and the
batch, however many items there are.

Defined results: a null text has no terms; documents without terms count neither in
N nor anywhere; a repeated row is a document of its own; a null document id ranks
after all others of an equal score. Items are told apart by (id, text): a repeated
item counts once, a null id is an id; an item without terms, or none of whose terms
occur, gets no row. Other columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

import collections
import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relaylens.llm.common import lower_ascii, saved, small_batches

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Of UTF-8 text whose A-Z are in lower case: digits, letters and all bytes of other characters.
_TERM_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")
TOP = 10
STAGES = 4
#: Bytes of terms (with 16 more for each) of the items that are searched together.
BLOCK_BYTES = 2_000_000

_INDEX = "shard long, term int, docs array<int>, tfs array<int>, ids array<{kind}>, lengths array<int>"
_BUNDLE = "shard long, ids array<{kind}>, lengths array<int>, items array<int>, docs array<int>, scores array<long>"


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), F.lit(TERM), F.lit(0))


def byte_terms(text: str | None) -> list[bytes]:
    """The terms of a text, in UTF-8."""
    return _TERM_BYTES.findall(text.encode().lower()) if text else []


def _arrow_kind(df: DataFrame, column: str) -> pa.DataType:
    return df.select(column).limit(0).toArrow().schema.field(0).type


def _index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Posting lists of the vocabulary's terms, and per shard a row (term -1) with its documents' ids and lengths."""
    spark = docs.sparkSession
    numbers = spark.sparkContext.broadcast(vocabulary)
    kind = _arrow_kind(docs, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.value.get
        part = TaskContext.get().partitionId()
        types = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(kind), pa.list_(pa.int32())]
        names = ["shard", "term", "docs", "tfs", "ids", "lengths"]
        for k, batch in enumerate(batches):
            lists: dict[int, tuple[list, list]] = collections.defaultdict(lambda: ([], []))
            ids, lengths = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = byte_terms(text.as_py())
                if not words:
                    continue
                place = len(ids)
                ids.append(doc_id)
                lengths.append(len(words))
                for word, tf in collections.Counter(words).items():
                    term = number(word)
                    if term is not None:
                        docs_of, tfs = lists[term]
                        docs_of.append(place)
                        tfs.append(tf)
            if not ids:
                continue
            n = len(lists) + 1
            postings = list(lists.values())
            columns = [[part << 32 | k] * n, [-1, *lists], [None, *(p[0] for p in postings)], [None, *(p[1] for p in postings)], [ids] + [None] * (n - 1), [lengths] + [None] * (n - 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return docs.mapInArrow(run, _INDEX.format(kind=docs.schema["id"].dataType.simpleString()))


class _Block:
    """Items searched together: their terms by number, and what the corpus says about these."""

    def __init__(self, rows: list):
        vocabulary = sorted({r["term"] for r in rows})
        number = {t: i for i, t in enumerate(vocabulary)}
        self.vocabulary = {t.encode(): i for t, i in number.items()}
        names = sorted({r["item_no"] for r in rows})
        place = {x: i for i, x in enumerate(names)}
        self.item_nos = names
        self.item = np.array([place[r["item_no"]] for r in rows], np.int64)
        self.term = np.array([number[r["term"]] for r in rows], np.int64)
        self.repeats = np.array([r["repeats"] for r in rows], np.int64)

    def weigh(self, stats: list, n_docs: int, n_terms: int, shortest: int) -> None:
        """Weights, owners and the most that each term can add to a document."""
        size = len(self.vocabulary)
        df, most = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for r in stats:
            df[r["term"]], most[r["term"]] = r["df"], r["tf"]
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        m = 25 + 75 * shortest * n_docs // n_terms
        self.bound = np.where(df > 0, self.weight * (1_000_000_000 * most // (1000 * most + 8 * m)), 0)
        order = np.argsort(df, kind="stable")
        share = np.cumsum(df[order]) * STAGES // max(1, int(df.sum()) + 1)
        self.owner = np.zeros(size, np.int64)
        self.owner[order] = share

    def stage(self, owner: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, term, repeats) of one owner's terms, by term."""
        mine = np.flatnonzero(self.owner[self.term] == owner)
        mine = mine[np.argsort(self.term[mine], kind="stable")]
        return self.item[mine], self.term[mine], self.repeats[mine]

    def rest(self, owner: int) -> np.ndarray:
        """Per item the most that owners after this one can add."""
        later = self.owner[self.term] > owner
        out = np.zeros(len(self.item_nos), np.int64)
        np.add.at(out, self.item[later], (self.repeats * self.bound[self.term])[later])
        return out


def _best(scores: np.ndarray, ids: list, top: int) -> np.ndarray:
    """Places of the highest scores above 0, equal ones by id (nulls last)."""
    places = np.flatnonzero(scores > 0)
    if len(places) > top:
        cut = np.partition(scores[places], len(places) - top)[len(places) - top]
        places = places[scores[places] >= cut]
    order = sorted(places.tolist(), key=lambda i: (-scores[i], ids[i] is None, ids[i] if ids[i] is not None else 0))
    return np.array(order[:top], np.int64)


def _accumulate(block: _Block, owner: int, floor: np.ndarray, n_docs: int, n_terms: int, top: int) -> Callable:
    """A stage's cogroup function: (bundles, postings) of a shard -> its bundle, or its best documents after the last owner."""
    items, terms, repeats = block.stage(owner)
    starts = np.searchsorted(terms, np.arange(len(block.vocabulary) + 1))
    weight, rest, count = block.weight, block.rest(owner), len(block.item_nos)
    # an accumulator below ``needed`` can't reach the result any more; one at 0 is none
    needed = np.maximum(1, floor - rest)

    def run(key: tuple, bundle: pa.Table, postings: pa.Table) -> pa.Table:
        if not bundle.num_rows:
            return bundle
        lengths = bundle.column("lengths").combine_chunks().flatten().to_numpy().astype(np.int64)
        sums = np.zeros((count, len(lengths)), np.int64)
        held = [bundle.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("items", "docs", "scores")]
        sums[held[0], held[1]] = held[2]
        m8 = 8 * (25 + 75 * lengths * n_docs // n_terms)
        if postings.num_rows:
            docs, tfs = (postings.column(c).combine_chunks() for c in ("docs", "tfs"))
            offsets = docs.offsets.to_numpy()
            flat_docs, flat_tfs = docs.values.to_numpy(), tfs.values.to_numpy().astype(np.int64)
            added = 1_000_000_000 * flat_tfs // (1000 * flat_tfs + m8[flat_docs])
            for row, term in enumerate(postings.column("term").to_pylist()):
                part = slice(offsets[row], offsets[row + 1])
                at, plus = flat_docs[part], weight[term] * added[part]
                for j in range(starts[term], starts[term + 1]):
                    sums[items[j], at] += repeats[j] * plus
        ids = bundle.column("ids").combine_chunks()
        if owner == STAGES - 1:
            names = ids.flatten().to_pylist()
            found = [(i, _best(sums[i], names, top)) for i in range(count)]
            rows = [(i, names[d], int(sums[i, d])) for i, best in found for d in best.tolist()]
            columns = list(zip(*rows)) if rows else [[], [], []]
            types = [pa.int32(), ids.type.value_type, pa.int64()]
            return pa.table([pa.array(c, t) for c, t in zip(columns, types)], ["item", "doc_id", "score"])
        kept_items, kept_docs = np.nonzero(sums >= needed[:, None])
        new = [kept_items.astype(np.int32), kept_docs.astype(np.int32), sums[kept_items, kept_docs]]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for x in new]
        return pa.table([bundle.column("shard"), ids, bundle.column("lengths"), *lists], ["shard", "ids", "lengths", "items", "docs", "scores"])

    return run


def _floor(bundles: DataFrame, count: int, top: int) -> np.ndarray:
    """Per item the ``top``-th best sum so far; 0 where fewer documents have one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                items, scores = (batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in (0, 1))
                order = np.lexsort((-scores, items))
                items, scores = items[order], scores[order]
                place = np.arange(len(items)) - np.searchsorted(items, items)
                best = place < top
                yield pa.RecordBatch.from_arrays([pa.array(items[best]), pa.array(scores[best])], ["item", "score"])

    best = bundles.select("items", "scores").mapInArrow(run, "item int, score long")
    ranked = best.withColumn("place", F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc()))).where(F.col("place") <= top)
    out = np.zeros(count, np.int64)
    for r in ranked.where(F.col("place") == top).select("item", "score").collect():  # one row per item of the block
        out[r["item"]] = r["score"]
    return out


def _search_block(docs: DataFrame, block: _Block, top: int) -> DataFrame | None:
    """(item_no, doc_id, score): every shard's best documents of the block's items; None without documents."""
    spark = docs.sparkSession
    kind = docs.schema["id"].dataType.simpleString()
    index = saved(_index(docs, block.vocabulary), "search-index")
    shards, postings = index.where("term < 0"), index.where("term >= 0").select("shard", "term", "docs", "tfs")
    totals = shards.select(F.size("ids").alias("n"), F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("terms"), F.array_min("lengths").alias("least"))
    n_docs, n_terms, shortest = totals.agg(F.sum("n"), F.sum("terms"), F.min("least")).first()
    if not n_docs:
        return None
    stats = postings.groupBy("term").agg(F.sum(F.size("docs")).alias("df"), F.max(F.array_max("tfs")).alias("tf")).collect()  # one row per term of the block
    block.weigh(stats, n_docs, n_terms, shortest)
    owners = spark.createDataFrame([(t, int(o)) for t, o in enumerate(block.owner)], "term int, owner int")
    owned = postings.join(F.broadcast(owners), "term")
    none = [F.array().cast(f"array<{t}>").alias(c) for c, t in (("items", "int"), ("docs", "int"), ("scores", "long"))]
    bundles = shards.select("shard", "ids", "lengths", *none)
    floor = np.zeros(len(block.item_nos), np.int64)
    for owner in range(STAGES):
        last = owner == STAGES - 1
        step = _accumulate(block, owner, floor, n_docs, n_terms, top)
        schema = f"item int, doc_id {kind}, score long" if last else _BUNDLE.format(kind=kind)
        mine = owned.where(F.col("owner") == owner).select(F.col("shard").alias("home"), "term", "docs", "tfs")
        done = bundles.groupBy("shard").cogroup(mine.groupBy("home")).applyInArrow(step, schema)
        if not last:
            bundles = saved(done, f"search-bundles-{owner}")
            floor = np.maximum(floor, _floor(bundles, len(floor), top))
    names = spark.createDataFrame([(i, int(x)) for i, x in enumerate(block.item_nos)], "item int, item_no long")
    return saved(done.join(F.broadcast(names), "item").select("item_no", "doc_id", "score"), "search-best")


def _item_blocks(terms: DataFrame) -> Iterator[list]:
    """Rows (item_no, term, repeats) in blocks of about ``BLOCK_BYTES``, dealt by hash of the item; a block is halved while it is larger and has several items."""
    size = F.octet_length("term") + 16
    total = terms.agg(F.sum(size)).first()[0] or 0
    n = max(1, -(-total // BLOCK_BYTES))
    place = F.pmod(F.xxhash64("item_no"), F.lit(1 << 30))
    while True:
        sizes = terms.groupBy((place % n).alias("block")).agg(F.sum(size).alias("bytes"), F.count_distinct("item_no").alias("items"))
        if sizes.where((F.col("bytes") > 2 * BLOCK_BYTES) & (F.col("items") > 1)).isEmpty() or n > 1 << 29:
            break
        n *= 2
    for block in range(n):
        rows = terms.where(place % n == block).select("item_no", "term", "repeats").collect()  # bounded by BLOCK_BYTES
        if rows:
            yield rows


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` best documents."""
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    corpus = docs.select(docs[id_column].alias("id"), docs[text_column].cast("string").alias("text"))
    named = items.select(items[item_column].alias("item_id"), items[item_text_column].cast("string").alias("text")).distinct()
    numbered = saved(named.select("item_id", terms_of(F.col("text")).alias("terms"), F.monotonically_increasing_id().alias("item_no")), "search-items")
    terms = numbered.select("item_no", F.explode("terms").alias("term")).groupBy("item_no", "term").agg(F.count("*").alias("repeats"))
    found = None
    for rows in _item_blocks(terms):
        part = _search_block(corpus, _Block(rows), top)
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        return numbered.select("item_id", F.lit(0).alias("rank"), F.lit(None).cast(corpus.schema["id"].dataType).alias("doc_id"), F.lit(0).cast("long").alias("score")).where("false")
    order = Window.partitionBy("item_no").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(numbered.select("item_no", "item_id"), "item_no").select("item_id", "rank", "doc_id", "score")
