"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns as
context, the reply as target, and only that reply trainable. A turn is written as
a start mark, the role, a line feed, the text and an end mark. Control strings that
stand in a text (of this template or of other common ones) are broken by one
backslash after their first character; a text that already holds such a broken
string gets one backslash more, so ``unescape`` gives back every text exactly and
texts without control strings aren't changed at all.

``expand`` returns one row per example: the conversation, ``block`` (0), ``n_turns``
(turns in the text, the target last), ``text``, and the target's span in it
(``loss_start`` from 0, ``loss_chars``; code points). Turns that follow the last
reply, or a conversation without one, give one more row without a target, so that
the output holds every turn.

Every example's text holds its whole context, however long the conversation is. A
conversation may hold a great part of all rows, and the texts of its examples grow
with its square; they are made in parts. A conversation of more than ``BLOCK_CHARS``
formatted characters is dealt into blocks of that size by range-partitioned running
sums; each block gets the text of all blocks before it, and its examples put their
own part behind that. So the work on one conversation is spread over its blocks, and a
task holds a block, the text before it and one example at a time, never all examples.
A text is one value of a row, so 2 GB bound a conversation. ``WRITE_LONG`` has the
writer's options for such rows (they check the size of pages and row groups every few
rows; a page of examples that repeat each other packs well), and ``digests`` reads them
row by row.

Who names ``block_chars`` wants contexts in blocks: the text of an example then starts
with its block, ``closes_block`` marks the rows whose texts make up the conversation, and
the whole context is these rows' texts of the blocks before, then its own. ``digests``
counts whole contexts in both forms, with the same results.

Defined results: turns are ordered by (turn, role, text), a null turn first; a null
text or role is an empty one; repeated turns count each; a null conversation id is
an id like others; other columns are ignored; an empty table gives no example.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relaylens.llm.common import saved, small_batches

START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"
#: Formatted characters of a conversation that one task lays out.
BLOCK_CHARS = 65_536
#: Options of a writer of examples.
WRITE_LONG = {
    "compression": "zstd",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "16",
    "parquet.block.size.row.check.min": "1",
    "parquet.block.size.row.check.max": "16",
}
#: What follows the first character of a control string: marks of this template and of others.
_REST = r"(?:\|[A-Za-z_]+\|>|/?s>|/?SYS>>|/?INST\])"
_WHOLE = rf"([<\[])(\\*)(?={_REST})"
_BROKEN = rf"([<\[])\\(\\*)(?={_REST})"


def escape(text: Column) -> Column:
    """Break the control strings of a text; ``unescape`` undoes it."""
    return F.regexp_replace(text, _WHOLE, r"$1$2\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _BROKEN, "$1$2")


def _escape_role(role: Column) -> Column:
    """A role stands on a line of its own."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    halves = F.transform(F.split(unescape(role), r"\\\\"), lambda x: F.replace(x, F.lit("\\n"), F.lit("\n")))
    return F.array_join(halves, "\\")


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, at struct<turn, role, text>, head, body): the formatted parts of every turn."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    at = F.struct(F.col("turn").alias("turn"), role.alias("role"), text.alias("text"))
    rows = conversations.select("conv_id", at.alias("at"))
    head = F.concat(F.lit(START), _escape_role(F.col("at.role")), F.lit("\n"))
    return rows.select("conv_id", "at", head.alias("head"), escape(F.col("at.text")).alias("body"))


def _size() -> Column:
    return F.char_length("head") + F.char_length("body") + len(END)


def _blocks_of_long(turns: DataFrame, block_chars: int) -> DataFrame:
    """``turns`` with their block, by running sums over range partitions: a conversation may be spread over many."""
    order = ["conv_id", F.col("at.turn"), F.col("at.role"), F.col("at.text")]
    # rows of the same key are told apart by where they were read, so that a repeated turn can't fill a partition
    dealt = turns.withColumn("seat", F.monotonically_increasing_id()).repartitionByRange(*order, "seat")
    put = saved(dealt.sortWithinPartitions(*order, "seat").withColumn("part", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id()), "long-turns")
    parts = put.groupBy("conv_id", "part").agg(F.sum(_size()).alias("chars"))
    before = F.coalesce(F.sum("chars").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # within a conversation's share of a partition
    own = F.coalesce(F.sum(_size()).over(Window.partitionBy("conv_id", "part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), before.alias("_before"))
    placed = put.withColumn("_own", own).join(starts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")))
    return placed.select("conv_id", F.floor((F.col("_before") + F.col("_own")) / block_chars).alias("block"), "at", "head", "body")


def _grouped(placed: DataFrame) -> DataFrame:
    """One row a block: its turns in order, and the formatted text of each."""
    grouped = placed.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("at", "head", "body"))).alias("ts"))
    whole = F.transform("ts", lambda t: F.concat(t["head"], t["body"], F.lit(END)))
    return grouped.select("conv_id", "block", F.size("ts").alias("n"), "ts", whole.alias("pieces"))


def _with_contexts(blocks: DataFrame) -> DataFrame:
    """Blocks of long conversations, each with the text (``before``) and turns (``n_before``) of all blocks before it; ``last`` marks a
    conversation's last. A block's text goes to each later block: all of them together have one text a block, not one an example."""
    at = blocks.select("conv_id", "block", "n")
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    later = at.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_later"))
    pairs = saved(at.join(later, same & (F.col("block") < F.col("_later"))).select("_conv", "block", "_later", "n"), "chat-pairs")
    named = pairs.select("_conv", F.col("block").alias("_block"), "_later", F.col("n").alias("_n"))
    texts = blocks.select("conv_id", "block", F.array_join("pieces", "").alias("own"))
    sent = texts.join(named, same & (F.col("block") == F.col("_block"))).select("_conv", "_later", "_n", F.struct("block", "own").alias("part"))
    before = sent.groupBy("_conv", "_later").agg(F.sum("_n").alias("_n"), F.sort_array(F.collect_list("part")).alias("parts"))
    before = before.select("_conv", "_later", "_n", F.array_join("parts.own", "").alias("_before"))
    open_blocks = pairs.select(F.col("_conv").alias("_c"), F.col("block").alias("_b")).distinct()
    marked = blocks.join(open_blocks, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b")), "left")
    placed = marked.join(before, same & (F.col("block") == F.col("_later")), "left")
    return placed.select("conv_id", "block", "n", "ts", "pieces", F.coalesce("_before", F.lit("")).alias("before"), F.coalesce("_n", F.lit(0)).cast("int").alias("n_before"), F.col("_b").isNull().alias("last"))


def expand(conversations: DataFrame, block_chars: int | None = None) -> DataFrame:
    """Examples of every conversation, with whole contexts unless ``block_chars`` is named; see the module docstring."""
    whole_contexts = block_chars is None
    block_chars = BLOCK_CHARS if block_chars is None else block_chars
    turns = turns_of(conversations)
    sizes = turns.groupBy("conv_id").agg(F.sum(_size()).alias("chars")).where(F.col("chars") > block_chars)
    long_ids = saved(sizes.select(F.col("conv_id").alias("_long")), "long-conversations")
    same = F.col("conv_id").eqNullSafe(F.col("_long"))
    usual = turns.join(long_ids, same, "left_anti").select("conv_id", F.lit(0).cast("long").alias("block"), "at", "head", "body")
    alone = [F.lit("").alias("before"), F.lit(0).alias("n_before"), F.lit(True).alias("last")]
    grouped = _grouped(usual).select("*", *alone)
    if not long_ids.isEmpty():
        blocks = _grouped(_blocks_of_long(turns.join(long_ids, same, "left_semi"), block_chars))
        grouped = grouped.unionByName(_with_contexts(saved(blocks, "chat-blocks")) if whole_contexts else blocks.select("*", *alone))
    numbered = grouped.select("conv_id", "block", "n", "pieces", "before", "n_before", "last", F.posexplode("ts").alias("i", "t"))
    target = F.col("t.at.role") == ASSISTANT
    closes = F.col("last") & (F.col("i") == F.col("n") - 1)
    context = F.concat("before", F.array_join(F.slice("pieces", F.lit(1), F.col("i")), ""))
    rows = numbered.where(target | closes).select(
        "conv_id",
        # whole contexts: a conversation is one block
        (F.lit(0).cast("long") if whole_contexts else F.col("block")).alias("block"),
        (F.col("n_before") + F.col("i") + 1).alias("n_turns"),
        closes.alias("closes_block"),
        F.concat(context, F.col("t.head"), F.col("t.body"), F.lit(END)).alias("text"),
        F.when(target, F.char_length(context) + F.char_length("t.head")).alias("loss_start"),
        F.when(target, F.char_length("t.body")).alias("loss_chars"),
    )
    return rows


def read_turns(text: Column) -> Column:
    """array<struct<role, text>> of a formatted text."""
    pieces = F.split(text, r"<\|im_end\|>\n")
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(START) + 1))
        cut = F.locate("\n", body)
        return F.struct(_unescape_role(F.substr(body, F.lit(1), cut - 1)).alias("role"), unescape(F.substr(body, cut + 1)).alias("text"))

    return F.transform(pieces, turn)


def read_target(text: Column, start: Column, chars: Column) -> Column:
    """The trainable text of an example as it was before escaping; null without a target."""
    return unescape(F.substr(text, start + 1, chars))


#: Running values of a conversation's digests. ``before``: characters of its blocks that have ended; ``left``: whole
#: length of the row last read if it has no target, which counts only where it ends the conversation.
_NEW_STATE = {"turns": 0, "loss": 0, "chars": 0, "before": 0, "left": 0}
_COLUMNAR = "spark.sql.parquet.enableVectorizedReader"
_DIGEST_SCHEMA = "conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digests(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation, block and turns: digests are fed row by row, so no conversation is held."""
    open_id: object = None
    state: dict | None = None
    turns_sha = loss_sha = None
    done: list[tuple] = []

    def close() -> None:
        done.append((open_id, state["turns"], turns_sha.hexdigest(), state["loss"], loss_sha.hexdigest(), state["chars"] + state["left"]))

    def out() -> pa.RecordBatch:
        types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)

    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "n", "turns", "target", "chars", "closes")]
        for conv, n, turns, target, chars, closes in zip(*columns):
            if state is None or conv != open_id:
                if state is not None:
                    close()
                open_id, state, turns_sha, loss_sha = conv, dict(_NEW_STATE), hashlib.sha256(), hashlib.sha256()
            whole = state["before"] + chars
            state["turns"] += n
            turns_sha.update(turns.encode())
            if target is not None:
                state["loss"] += len(target)
                loss_sha.update(target.encode())
                state["chars"] += whole
            state["left"] = 0 if target is not None else whole
            if closes:
                state["before"] = whole
        if done:
            yield out()
            done.clear()
    if state is not None:
        close()
        yield out()


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation what its examples hold: turns, trainable text (code points) and formatted characters.

    An example's formatted characters are those of its text and, where contexts are in blocks, of the closing rows of the
    blocks before it; the row that closes a block without a target is an example only at the conversation's end.
    """
    spark = examples.sparkSession
    small_batches(spark)
    # the texts are read here, row by row: a columnar batch would hold thousands of them
    columnar = spark.conf.get(_COLUMNAR)
    spark.conf.set(_COLUMNAR, "false")
    try:
        rows = saved(_read_back(examples), "chat-read")
    finally:
        spark.conf.set(_COLUMNAR, columnar)
    kind = examples.schema["conv_id"].dataType
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "block", "place")
    arrow_kind = examples.select("conv_id").limit(0).toArrow().schema.field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _digests(batches, arrow_kind)

    return dealt.mapInArrow(run, _DIGEST_SCHEMA.format(kind=kind.simpleString()))


def _read_back(examples: DataFrame) -> DataFrame:
    """What ``_digests`` takes of each example: once a conversation (or block) its turns, its target, its length."""
    turns = read_turns(F.col("text"))
    flat = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    last = F.col("closes_block")
    return examples.select(
        "conv_id",
        "block",
        F.col("n_turns").alias("place"),
        F.when(last, F.size(turns)).otherwise(0).alias("n"),
        F.when(last, flat).otherwise("").alias("turns"),
        read_target(F.col("text"), F.col("loss_start"), F.col("loss_chars")).alias("target"),
        F.char_length("text").cast("long").alias("chars"),
        last.alias("closes"),
    )
