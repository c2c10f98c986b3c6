"""Near-duplicate groups by fast similarity sketching, banding and exact verification.

Sketch: ``t`` bins are filled in rounds. In rounds 0..t-1 each shingle falls into
one hashed bin with the value (round, fraction); in rounds t..2t-1 it falls into
bin round-t, so every bin fills after 2t rounds at most; a bin keeps its least
value. Agreement of bins estimates the Jaccard similarity with Chernoff-type
concentration, in O(t log t + n) steps.

Groups: texts with equal shingle sets form one class, named by its least id. Bins
are cut into bands; classes that share a band meet in a bucket. First each class
is verified with the bucket leader it shares most bands with. Then, in buckets that
still hold several components, each class outside the largest one is verified with
its nearest class of another component, by the sketches; after some such rounds the
large groups have grown together, and all pairs left that lie in different
components are verified. So a large group of near copies costs a few verifications
per member, not all pairs. Each link is confirmed on the full shingle sets. With 48
bands of 5 bins a pair at the threshold of 0.75 shares no band with a probability of
(1 - 0.75^5)^48 < 3e-6; its 480 bins agree in less than ``FLOOR`` of all, where the
last step has no verification, with one of 5e-5 to 6e-5. Above the threshold both fall fast.

Defined results: a text of fewer words than the shingle length has its whole word
sequence as its one shingle; null and empty texts have empty sets and link with
nothing; a null id links with nothing (component null, kept true); rows that share
an id are one node, linked by the texts of any of them; an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaylens.llm.common import recorded, removed, saved, small_batches

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 75
BANDS = 48
BINS_A_BAND = 5
#: Bins of a sketch; the first of them make the bands, all of them estimate the similarity.
BINS = 480
#: Share of agreeing bins below which a pair in a bucket isn't verified: 0.75 less four standard deviations.
FLOOR = 0.671
#: Rounds in which each class tries its nearest neighbour only, before all pairs left.
NEAREST_ROUNDS = 2
#: Rows of a bucket that meet in one cell; larger buckets are dealt into a grid of cells.
CELL_ROWS = 2000
#: Words whose hashes a worker remembers.
MEMO_WORDS = 500_000
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each output bit depends on all input bits."""
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str, hashes: WordHashes, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = text.encode("utf-8").lower().split()  # bytes: lowers A-Z, splits at \x20 and \x09-\x0D only
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.array([hashes[w] for w in words], dtype=np.uint64)
    n = max(1, len(h) - k + 1)
    x = np.full(n, np.uint64(min(len(h), k)))
    for i in range(min(k, len(h))):
        x = mix(x * _GOLD + h[i : i + n])
    return np.unique(x)


def sketch(shingles: np.ndarray, bins: int) -> np.ndarray:
    """Least value of each bin; the round is in the leading 16 bits, the fraction in the other 48."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(bins, full)
    n, done = len(shingles), 0
    if not n:
        return out
    low = np.uint64((1 << 48) - 1)
    while done < bins and (out == full).any():
        rounds = np.arange(done, min(bins, done + max(1, 4 * bins // n)), dtype=np.uint64)
        x = mix(shingles[None, :] ^ mix(rounds + np.uint64(1))[:, None])
        value = (rounds << np.uint64(48))[:, None] | (mix(x + _GOLD) & low)
        np.minimum.at(out, ((x >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64).ravel(), value.ravel())
        done += len(rounds)
    for b in np.flatnonzero(out == full):
        r = np.uint64(bins + b)
        x = mix(shingles ^ mix(np.array([r + np.uint64(1)]))[0])
        out[b] = (r << np.uint64(48)) | (mix(x + _GOLD) & low).min()
    return out


def band_keys(values: np.ndarray, bands: int, width: int) -> np.ndarray:
    """One 64-bit key per band, which also holds the band's number."""
    x = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(width):
        x = mix(x * _GOLD + values.reshape(bands, width)[:, i])
    return x


def sketch_documents(docs: DataFrame, id_column: str, text_column: str, shingle_words: int, bands: int, width: int) -> DataFrame:
    """(_id, n_shingles, digest, bands, fine) per row; the digest names the shingle set, null for an empty one;
    ``fine`` has a byte of each bin."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    kind = source.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, digests, fine, keys, ends = [], [], [], [], [0]
            for text in batch.column("_text").to_pylist():
                s = shingle_set(text, hashes, shingle_words)
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                fine.append(None)
                if len(s):
                    values = sketch(s, max(BINS, bands * width))
                    keys.append(band_keys(values[: bands * width], bands, width))
                    fine[-1] = (mix(values) >> np.uint64(56)).astype(np.uint8).tobytes()
                ends.append(ends[-1] + (bands if len(s) else 0))
            flat = np.concatenate(keys).view(np.int64) if keys else np.empty(0, dtype=np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
            columns = [batch.column("_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), lists, pa.array(fine, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "n_shingles", "digest", "bands", "fine"])

    return source.mapInArrow(run, f"_id {kind}, n_shingles bigint, digest binary, bands array<bigint>, fine binary")


def verify(pairs: DataFrame, docs: DataFrame, id_column: str, text_column: str, shingle_words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough.

    The text of b, mostly of fewer pairs, is joined first; then that of a, whose rows go straight on to the tasks.
    """
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).where("_id IS NOT NULL AND _text IS NOT NULL")
    kind = pairs.schema["a"].dataType.simpleString()
    wide = pairs.join(texts.toDF("b", "_tb"), "b").join(texts.toDF("a", "_ta"), "a").select("a", "b", "_ta", "_tb")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, last, left = WordHashes(), None, None
        for batch in batches:
            keep = []
            for ta, tb in zip(batch["_ta"], batch["_tb"]):
                if ta != last:
                    last, left = ta, shingle_set(ta, hashes, shingle_words)
                right = shingle_set(tb, hashes, shingle_words)
                n = len(left) + len(right)
                least, most = sorted((len(left), len(right)))
                both = 0
                if least and 100 * least >= percent * most:
                    both = n - len(np.unique(np.concatenate((left, right))))
                keep.append(both > 0 and 100 * both >= percent * (n - both))
            at = np.array(keep, dtype=bool)
            yield pd.DataFrame({"a": batch["a"].to_numpy(dtype=object)[at], "b": batch["b"].to_numpy(dtype=object)[at]}, dtype=object)

    return wide.mapInPandas(run, f"a {kind}, b {kind}").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b): the least node reachable.

    Alternates large-star and small-star steps; each round is one written table,
    and the rounds grow with the logarithm of the component size.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    edges = saved(edges, "links")
    mark = None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if not now["n"] or now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
        mark = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        first = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(first, "u")
        small = joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = saved(small.unionByName(first.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "links")


def bucket_pairs(members: DataFrame, found: DataFrame, fine: DataFrame, nearest: bool) -> DataFrame:
    """Distinct pairs (a < b) of a bucket, of different components, whose bins agree in ``FLOOR`` of all at least; with
    ``nearest`` only each class's nearest such class, for those outside the bucket's largest component.

    A bucket of more than ``CELL_ROWS`` rows is dealt by hash into groups, of which each two make a cell, so that
    a task holds a bounded number of rows at a time.
    """
    named = members.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("comp"))
    mixed = named.groupBy("key").agg(F.count("*").alias("n"), F.min("comp").alias("_lo"), F.max("comp").alias("_hi")).where("_lo != _hi")
    mixed = saved(mixed.select("key", F.ceil(F.col("n") / CELL_ROWS).cast("int").alias("g")), "mixed")
    rows = named.join(mixed, "key").join(fine if not nearest else fine.withColumn("bands", F.lit(None).cast("array<bigint>")), "rep")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("g")).cast("int"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("other"))
    rows = rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "comp", "fine", "bands")
    kind = members.schema["rep"].dataType.simpleString()

    def cell(part: pd.DataFrame) -> list[tuple]:
        comp = part["comp"].to_numpy(dtype=object)
        _, label = np.unique(comp, return_inverse=True)
        count = np.bincount(label)
        if len(count) < 2:
            return []
        rep, group = part["rep"].to_numpy(dtype=object), part["own"].to_numpy()
        bins = np.frombuffer(b"".join(part["fine"]), dtype=np.uint8).reshape(len(part), -1)
        if not nearest:
            bands, key = np.stack(part["bands"].to_list()), part["key"].iat[0]
        two = part["i"].iat[0] != part["j"].iat[0]
        outside = np.flatnonzero(label != count.argmax())
        out = []
        step = max(1, (1 << 25) // bins.size)
        for k in range(0, len(outside), step):
            at = outside[k : k + step]
            same = (bins[at][:, None, :] == bins[None, :, :]).mean(axis=2, dtype=np.float32)
            same[label[at][:, None] == label[None, :]] = 0
            if two:
                same[group[at][:, None] == group[None, :]] = 0
            if nearest:
                to = same.argmax(axis=1)
                out += [(rep[x], rep[y]) for x, y, v in zip(at, to, same[np.arange(len(at)), to]) if v >= FLOOR]
            else:
                x, y = np.nonzero(same >= FLOOR)
                # a pair counts in the first bucket it shares
                first = (bands[at[x]] == bands[y]).argmax(axis=1)
                x, y = (z[bands[at[x], first] == key] for z in (x, y))
                out += zip(rep[at[x]], rep[y])
        return [(min(p), max(p)) for p in out]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # rows come sorted by cell; the last cell of a batch may go on in the next one
        left = None
        for batch in batches:
            if left is not None:
                batch = pd.concat([left, batch], ignore_index=True)
            change = (batch[["key", "i", "j"]].diff().abs().sum(axis=1) != 0).to_numpy()
            change[0] = True
            starts = np.flatnonzero(change)
            pairs = [p for s, e in zip(starts[:-1], starts[1:]) for p in cell(batch.iloc[s:e])]
            left = batch.iloc[starts[-1] :]
            yield pd.DataFrame(pairs, columns=["a", "b"], dtype=object)
        if left is not None:
            yield pd.DataFrame(cell(left), columns=["a", "b"], dtype=object)

    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInPandas(run, f"a {kind}, b {kind}").distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle_words: int = SHINGLE_WORDS, percent: int = THRESHOLD_PERCENT, bands: int = BANDS, width: int = BINS_A_BAND) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row."""
    spark = docs.sparkSession
    with recorded() as tables:
        sketches = saved(sketch_documents(docs, id_column, text_column, shingle_words, bands, width), "sketches")
    rows = saved(sketches.select("_id", "n_shingles", "digest"), "sets")
    named = F.col("digest").isNotNull() & F.col("_id").isNotNull()
    linked = rows.where(named)
    classes = saved(linked.groupBy("digest").agg(F.min("_id").alias("rep")), "classes")
    reps = sketches.where(named).join(classes.withColumnRenamed("digest", "_d"), (F.col("digest") == F.col("_d")) & (F.col("_id") == F.col("rep"))).select("rep", "bands", "fine")
    reps = saved(reps, "reps")
    removed(spark, tables)  # from here on a class has one sketch
    fine = reps.select("rep", "fine", "bands")
    with recorded() as tables:
        placed = saved(reps.select(F.explode("bands").alias("key"), "rep"), "bands")
    order = F.struct(F.xxhash64("rep").alias("order"), F.col("rep").alias("rep"))
    buckets = placed.groupBy("key").agg(F.min(order).alias("_m"), F.count("*").alias("_n")).where("_n > 1").select("key", F.col("_m.rep").alias("leader"))
    members = saved(placed.join(buckets, "key"), "members")
    removed(spark, tables)  # members hold the keys of more than one class

    shared = members.where("rep != leader").groupBy("rep", "leader").agg(F.count("*").alias("n"))
    best = shared.groupBy("rep").agg(F.max(F.struct("n", F.col("leader"))).alias("_b"))
    best = saved(best.select(F.greatest("_b.leader", "rep").alias("b"), F.least("_b.leader", "rep").alias("a")).distinct(), "pairs")
    links = saved(verify(best, docs, id_column, text_column, shingle_words, percent), "confirmed")

    # rows that share an id have one node: their classes are linked
    twice = linked.join(classes, "digest").groupBy("_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"), F.count_distinct("rep").alias("_n")).where("_n > 1")
    same = linked.join(classes, "digest").join(twice.select("_id", "a"), "_id").select("a", F.col("rep").alias("b"))
    links = links.unionByName(same)

    found = components(links)
    tried = best
    for i in range(NEAREST_ROUNDS + 1):
        rest = bucket_pairs(members, found, fine, nearest=i < NEAREST_ROUNDS).join(tried, ["a", "b"], "left_anti")
        rest = saved(rest, "pairs")
        if rest.isEmpty():
            if i < NEAREST_ROUNDS:
                continue
            break
        more = saved(verify(rest, docs, id_column, text_column, shingle_words, percent), "confirmed")
        tried = tried.unionByName(rest)
        if not more.isEmpty():
            found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    named = rows.join(classes, "digest", "left").join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
    component = F.when(F.col("_id").isNotNull(), F.coalesce("component", "rep", "_id"))
    out = named.select(F.col("_id").alias(id_column), "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_column) == F.col("component_id"), F.lit(True)))
