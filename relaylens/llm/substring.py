"""Removal of lines (or paragraphs) that repeat anywhere in the corpus.

Units are normalised (lower case, one blank for white space, trimmed) and hashed
to 128 bits. Per digest the occurrence that ranks first by (id, text hash, offset) stays; all
others are cut, with their offsets in the original text (code points) recorded.
Digests are counted with map-side sums, and only those that occur more than once
meet the units again, in a plain equi-join whose hot keys adaptive execution splits.

``cut_passages`` does the same for 50 consecutive words wherever they stand in
lines. Anchors (least hashes of windows of 25-word runs) find those that may recur; the
words of many texts are hashed together, from their code points.

``deduplicate_passages`` leaves short repeated lines alone, such as a salutation:
of the repeated lines it cuts those in stretches of neighbours with 50 words in all,
then passages of 50 words within the text between these cuts.

Defined results: units of fewer than ``min_words`` words always stay; null and
empty texts have no units (a null text stays null); a null id ranks after all
others; rows that share id and text are the same document and lose the same units;
extra columns are kept, whatever their names (but for ``removed_spans``).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaylens.llm.common import recorded, removed, saved, small_batches

#: Shorter units recur by chance ("Yes.") and always stay.
MIN_WORDS = 5
_SPLIT = {"line": re.compile(r"[^\n]+"), "paragraph": re.compile(r"[^\n](?:[^\n]|\n(?![ \t\r]*\n))*")}

#: Words of a passage that ``cut_passages`` leaves only once.
PASSAGE_WORDS = 50
#: Characters of the texts whose words are hashed together (a longer text goes alone).
GROUP_CHARS = 200_000
#: Whether a code point is white space, to Python; the last entry stands for all code points above.
_BLANK = np.array([chr(c).isspace() for c in range(0x3001)] + [False])
_BASE, _GOLD, _MIX = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC4CEB9FE1A85EC53)


def units_of(text: str, unit: str = "line", min_words: int = MIN_WORDS) -> Iterator[tuple[int, int, bytes, int]]:
    """(start, end, digest, words) of each unit of enough words."""
    for m in _SPLIT[unit].finditer(text):
        words = m.group().lower().split()
        if len(words) >= min_words:
            yield m.start(), m.end(), hashlib.blake2b(" ".join(words).encode("utf-8"), digest_size=16).digest(), len(words)


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans; a span from the start of a line takes the line end that follows it (or, at the end, the one before it)."""
    out, at = [], 0
    for start, end in sorted(spans):
        out.append(text[at:start])
        at = end + (text[end : end + 1] == "\n" and (not start or text[start - 1] == "\n"))
    out.append(text[at:])
    left = "".join(out)
    return left[:-1] if at >= len(text) and left.endswith("\n") and not text.endswith("\n") else left


def hash_units(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", unit: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """(_id, _h, digest, start, end, no, words) of every unit of every whole text; _h hashes the text, no numbers its units."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_column).alias("_id"), F.xxhash64(text_column).alias("_h"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    kind = source.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, no, *found) for i, text in enumerate(batch["_text"]) for no, found in enumerate(units_of(text, unit, min_words))]
            out = pd.DataFrame(rows, columns=["i", "no", "start", "end", "digest", "words"])
            at = out.pop("i").to_numpy(dtype=int)
            out.insert(0, "_id", batch["_id"].to_numpy()[at])
            out.insert(1, "_h", batch["_h"].to_numpy()[at])
            yield out[["_id", "_h", "digest", "start", "end", "no", "words"]]

    return source.mapInPandas(run, f"_id {kind}, _h bigint, digest binary, start int, end int, no int, words int")


def repeated_units(units: DataFrame) -> DataFrame:
    """The units that go: all occurrences of a digest but the first ranked."""
    rank = F.struct(F.col("_id").isNull().alias("last"), F.col("_id").alias("id"), F.col("_h").alias("h"), F.col("start").alias("start"))
    firsts = units.groupBy("digest").agg(F.min(rank).alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    firsts = saved(firsts, "substring-firsts")  # so that the join has two plain exchanges and its hot keys can be split
    return units.join(firsts, "digest").where(~rank.eqNullSafe(F.col("_first"))).drop("_first")


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", unit: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """Rows with the repeated units cut from the text, and ``removed_spans`` array<struct<start, end>> in the original text."""
    spark = docs.sparkSession
    small_batches(spark)
    units = saved(hash_units(docs, id_column, text_column, unit, min_words), "substring-units")
    return without(docs, repeated_units(units), id_column, text_column)


def joined_spans(spans: Iterator[tuple[int, int]]) -> list[dict[str, int]]:
    """Sorted spans, those that overlap as one."""
    out: list[dict[str, int]] = []
    for s, e in spans:
        if out and s < out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], int(e))
        else:
            out.append({"start": int(s), "end": int(e)})
    return out


def without(docs: DataFrame, units: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows with the units cut from the text, and ``removed_spans``, which don't overlap."""

    gone = units.groupBy("_id", "_h").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("_spans"))
    gone = gone.withColumnRenamed("_id", "_gone_id").withColumnRenamed("_h", "_gone_h")
    kept = [c for c in docs.columns if c != "removed_spans"]
    # the row goes as one struct, so that its column names can't clash with ours
    rows = docs.select(F.struct(*kept).alias("_row"), F.col(id_column).alias("_id"), F.xxhash64(text_column).alias("_h"))
    joined = rows.join(gone, F.col("_id").eqNullSafe(F.col("_gone_id")) & (F.col("_h") == F.col("_gone_h")), "left")

    # one Python step joins the spans and cuts: two in one stage would take two workers a task, and Spark keeps both for later stages
    @F.pandas_udf("text string, spans array<struct<start:int,end:int>>")
    def cut_all(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        spans = [[] if s is None else joined_spans(zip(s, e)) for s, e in zip(starts, ends)]
        left = [cut(t, [(x["start"], x["end"]) for x in found]) if found else t for t, found in zip(texts, spans)]
        return pd.DataFrame({"text": pd.Series(left, dtype=object), "spans": pd.Series(spans, dtype=object)})

    cleared = joined.select("_row", cut_all(F.col("_row")[text_column], F.col("_spans.start"), F.col("_spans.end")).alias("_cut"))
    columns = [F.col("_cut.text").alias(c) if c == text_column else F.col("_row")[c].alias(c) for c in kept]
    return cleared.select(*columns, F.col("_cut.spans").alias("removed_spans"))


def in_groups(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """The texts in groups of bounded size, each with the number of its first."""
    at, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > GROUP_CHARS:
            yield at, texts[at:i]
            at, size = i, 0
        size += len(text) + 1
    if at < len(texts):
        yield at, texts[at:]


def word_places(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points, starts, ends of the words) of a text."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    edges = np.flatnonzero(np.diff(~_BLANK[np.minimum(codes, len(_BLANK) - 1)], prepend=False, append=False))
    return codes, edges[::2], edges[1::2]


def least(values: np.ndarray, window: int, of=np.minimum) -> np.ndarray:
    """The least (or, by ``of``, greatest) of ``window`` values in a row, from each place."""
    size, n = 1, len(values) - window + 1
    while size * 2 <= window:
        values, size = of(values[:-size], values[size:]), size * 2
    return of(values[:n], values[window - size :][:n])


def anchors(texts: list[str], k: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a group of texts, and the places of its words: (the first word of each text and, last, their number; start
    and end of each word in its text; anchors, as numbers of words; the hash of the ``k`` words from each anchor).

    Words count in lower case. The least hashes of each ``window`` places in a row are anchors: equal passages have equal anchors.
    """
    joined = "\n".join(texts)
    low = joined.lower()
    codes, starts, ends = word_places(low)
    lengths = ends - starts
    n = len(lengths)
    begin = np.cumsum([0, *[len(t) + 1 for t in texts]])
    if n:
        chars, offset = codes[np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())], np.cumsum(lengths) - lengths
        powers = np.cumprod(np.full(lengths.max(), _BASE))
        one = np.add.reduceat((chars + np.uint64(1)) * powers[np.arange(len(chars)) - np.repeat(offset, lengths)], offset)
        one = (one ^ one >> np.uint64(32)) * _MIX
    if len(low) != len(joined):  # a letter of two in lower case; places are those of the text itself
        _, starts, ends = word_places(joined)
    first = np.searchsorted(starts, begin)
    own = np.repeat(begin[:-1], np.diff(first))
    starts, ends = starts - own, ends - own
    size = n - k - window + 2  # windows
    if size < 1:
        return first, starts, ends, np.empty(0, int), np.empty(0, np.uint64)
    hashes = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        hashes = hashes * _GOLD + one[j : j + len(hashes)]
    hashes ^= hashes >> np.uint64(29)
    last = np.repeat(first[1:], np.diff(first))  # the word behind each word's text
    whole = np.arange(size) + window + k - 1 <= last[:size]
    lowest = np.where(whole, least(hashes, window), np.uint64(0))
    highest = least(np.pad(lowest, window - 1), window, np.maximum)
    inside = np.arange(len(hashes)) + k <= last[: len(hashes)]
    at = np.flatnonzero((highest == hashes) & inside)
    return first, starts, ends, at, hashes[at]


def outside(starts: np.ndarray, ends: np.ndarray, gone: list[tuple[int, int]]) -> np.ndarray:
    """Whether places from starts to ends share no character with the sorted spans that are gone."""
    if not gone:
        return np.ones(len(starts), dtype=bool)
    first, last = np.array(gone).T
    after = np.searchsorted(last, starts, side="right")  # the first span that ends behind the start
    return (after == len(last)) | (first[np.minimum(after, len(last) - 1)] >= ends)


def repeated_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = PASSAGE_WORDS, gone: DataFrame | None = None) -> DataFrame:
    """(_id, _h, digest, start, end) of every ``words`` consecutive words that an earlier ranked place has too.

    Each such passage holds an anchor of ``words // 2`` words; only passages around anchors that recur are hashed.
    ``gone``, (_id, _h, spans) with one row a document, names text that no passage may touch, on either side.
    """
    spark = docs.sparkSession
    small_batches(spark)
    k = max(1, words // 2)
    window = words - k + 1
    source = docs.select(F.col(id_column).alias("_id"), F.xxhash64(text_column).alias("_h"), F.col(text_column).alias("_text")).where("_text IS NOT NULL")
    kind = source.schema["_id"].dataType.simpleString()
    spans = "array<struct<start:int,end:int>>"
    gone = spark.createDataFrame([], f"_id {kind}, _h bigint, spans {spans}") if gone is None else gone
    gone = gone.select(F.col("_id").alias("_gone_id"), F.col("_h").alias("_gone_h"), F.col("spans.start").alias("_from"), F.col("spans.end").alias("_to"))

    def beside_gone(rows: DataFrame) -> DataFrame:
        # never a broadcast, with which the Python steps before and after it would share a stage and take two workers a task
        on = F.col("_id").eqNullSafe(F.col("_gone_id")) & (F.col("_h") == F.col("_gone_h"))
        return rows.join(gone.hint("merge"), on, "left").drop("_gone_id", "_gone_h")

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for _, texts in in_groups(batch["_text"].tolist()):
                first, starts, ends, at, hashes = anchors(texts, k, window)
                cuts = np.searchsorted(at, first)
                columns = hashes.view(np.int64), starts[at], ends[at + k - 1]
                found += [tuple(c[i:j] for c in columns) for i, j in zip(cuts, cuts[1:])]
            yield pd.concat([batch[["_id", "_h"]], pd.DataFrame(found, columns=["anchors", "start", "end"], index=batch.index)], axis=1)

    @F.pandas_udf("array<bigint>")
    def left_over(found: pd.Series, starts: pd.Series, ends: pd.Series, first: pd.Series, last: pd.Series) -> pd.Series:
        rows = zip(found, starts, ends, first, last)
        return pd.Series([a if f is None else np.asarray(a)[outside(np.asarray(s), np.asarray(e), list(zip(f, t)))] for a, s, e, f, t in rows], dtype=object)

    left_over = left_over.asNondeterministic()  # else the filter below runs it a second time, in a worker of its own

    def passages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, digests, places = [], [], [np.empty((2, 0), int)]
            for number, texts in in_groups(batch["_text"].tolist()):
                word, starts, ends, at, hashes = anchors(texts, k, window)
                cuts = np.searchsorted(at, word)
                for i, text in enumerate(texts, number):
                    t = i - number
                    hot = np.isin(hashes[cuts[t] : cuts[t + 1]].view(np.int64), np.asarray(batch["_anchors"].iat[i], np.int64))
                    first = np.unique((at[cuts[t] : cuts[t + 1]][hot][:, None] - np.arange(window)).ravel())
                    first = first[(first >= word[t]) & (first <= word[t + 1] - words)]
                    if batch["_from"].iat[i] is not None:
                        first = first[outside(starts[first], ends[first + words - 1], list(zip(batch["_from"].iat[i], batch["_to"].iat[i])))]
                    if not len(first):
                        continue
                    low = [w.encode("utf-8") for w in text.lower().split()]
                    data, behind = b" ".join(low), np.cumsum([len(w) + 1 for w in low])
                    froms, tos = np.concatenate([[0], behind])[first - word[t]], behind[first - word[t] + words - 1] - 1
                    rows += [i] * len(first)
                    digests += [hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(froms.tolist(), tos.tolist())]
                    places.append(np.stack([starts[first], ends[first + words - 1]]))
            own = batch[["_id", "_h"]].iloc[rows].reset_index(drop=True)
            start, end = np.concatenate(places, axis=1)
            yield pd.concat([own, pd.DataFrame({"digest": pd.Series(digests, dtype=object), "start": start, "end": end})], axis=1)

    with recorded() as tables:
        found = beside_gone(source.mapInPandas(find, f"_id {kind}, _h bigint, anchors array<bigint>, start array<int>, end array<int>"))
        found = found.select("_id", "_h", left_over("anchors", "start", "end", "_from", "_to").alias("anchors")).where("size(anchors) > 0")
        found = saved(found, "passage-anchors").select("_id", "_h", F.explode("anchors").alias("anchor"))
        again = saved(found.groupBy("anchor").count().where("count > 1").select("anchor"), "passage-repeated")
        hot = beside_gone(found.join(again, "anchor").groupBy("_id", "_h").agg(F.collect_set("anchor").alias("_anchors")))
        hot = hot.withColumnRenamed("_id", "_hot_id").withColumnRenamed("_h", "_hot_h")
        marked = source.join(hot, F.col("_id").eqNullSafe(F.col("_hot_id")) & (F.col("_h") == F.col("_hot_h"))).drop("_hot_id", "_hot_h")
        units = saved(marked.mapInPandas(passages, f"_id {kind}, _h bigint, digest binary, start int, end int"), "passage-units")
    removed(spark, tables[:-1])  # all but the units are spent
    return repeated_units(units)


def cut_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = PASSAGE_WORDS) -> DataFrame:
    """Rows without the passages of ``words`` words that an earlier ranked place has too, wherever in a line they stand;
    ``removed_spans`` as of ``deduplicate``. Each word cut has a copy that ranks before it."""
    return without(docs, repeated_passages(docs, id_column, text_column, words), id_column, text_column)


def stretches(units: Iterator[tuple[int, int, int, int]], words: int) -> list[dict[str, int]]:
    """Spans of the units (no, words, start, end) in runs of consecutive numbers that have ``words`` words in all."""
    runs: list[list[tuple[int, int, int, int]]] = []
    for unit in sorted(units):
        if runs and runs[-1][-1][0] + 1 == unit[0]:
            runs[-1].append(unit)
        else:
            runs.append([unit])
    return [{"start": int(s), "end": int(e)} for run in runs if sum(u[1] for u in run) >= words for _, _, s, e in run]


def deduplicate_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", unit: str = "line", words: int = PASSAGE_WORDS) -> DataFrame:
    """Rows without repeated lines in stretches of ``words`` words, and without passages of ``words`` words that repeat in
    the text between these; ``removed_spans`` as of ``deduplicate``. Shorter repetitions stay. Each word cut has a copy
    that ranks before it."""
    spark = docs.sparkSession
    small_batches(spark)

    @F.pandas_udf("array<struct<start:int,end:int>>")
    def long_ones(nos: pd.Series, counts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([stretches(zip(*unit), words) for unit in zip(nos, counts, starts, ends)], dtype=object)

    long_ones = long_ones.asNondeterministic()  # as ``left_over``

    with recorded() as tables:
        units = saved(hash_units(docs, id_column, text_column, unit, 1), "substring-units")
        again = repeated_units(units).groupBy("_id", "_h").agg(F.collect_set(F.struct("no", "words", "start", "end")).alias("_u"))
        spans = again.select("_id", "_h", long_ones("_u.no", "_u.words", "_u.start", "_u.end").alias("spans")).where("size(spans) > 0")
        lines = saved(spans, "substring-stretches")
    removed(spark, tables[:-1])  # the lines' units are spent
    passages = repeated_passages(docs, id_column, text_column, words, lines).select("_id", "_h", "start", "end")
    cuts = lines.select("_id", "_h", F.inline("spans")).unionByName(passages)
    return without(docs, cuts, id_column, text_column)
