"""every example of a long conversation holds its whole context in its own text."""

from pyspark.sql import functions as F

from relaylens.llm import chat
from relaylens.llm.common import saved


def test_examples_of_long_conversations_hold_whole_contexts(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_CHARS", 300)
    role = lambda i: ("user", "assistant", "user")[i % 3]
    rows = [(c, i, role(i), f"turn {i} " * (1 + i % 4)) for c, n in ((1, 50), (2, 2), (None, 31)) for i in range(n)]
    rows += [(3, 0, "user", "one long turn " * 100), (3, 1, "assistant", "a"), (3, 2, "assistant", "b"), (4, 7, "assistant", "same")] + [(4, 7, "assistant", "same")] * 40
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    expected = []
    for conv in (1, 2, None, 3, 4):
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
        pieces = [f"<|im_start|>{r}\n{x}<|im_end|>\n" for _, _, r, x in mine]
        for i, (_, _, r, x) in enumerate(mine):
            if r == "assistant" or i == len(mine) - 1:
                target = x if r == "assistant" else None
                expected.append((conv, i + 1, "".join(pieces[: i + 1]), target, i == len(mine) - 1))
    examples = saved(chat.expand(df), "whole-contexts", chat.WRITE_LONG)
    got = []
    for r in examples.collect():
        target = None if r["loss_start"] is None else r["text"][r["loss_start"] : r["loss_start"] + r["loss_chars"]]
        got.append((r["conv_id"], r["n_turns"], r["text"], target, r["closes_block"]))
    assert sorted(map(str, got)) == sorted(map(str, expected))
    # read back, they give what contexts in blocks give
    columnar = spark.conf.get("spark.sql.parquet.enableVectorizedReader")
    whole, blocks = chat.digests(examples), chat.digests(saved(chat.expand(df, 300), "contexts-in-blocks"))
    assert sorted(map(str, whole.collect())) == sorted(map(str, blocks.collect()))
    assert spark.conf.get("spark.sql.parquet.enableVectorizedReader") == columnar
    chars = {r["conv_id"]: r["chars"] for r in examples.groupBy("conv_id").agg(F.sum(F.char_length("text")).alias("chars")).collect()}
    assert {r["conv_id"]: r["formatted_chars"] for r in whole.collect()} == chars
