"""Ranked search, chat formatting and run detection: brute force, growth by blocks, odd rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from relaylens.llm import chat, runs, search
from relaylens.llm import queries as Q
from relaylens.llm.common import saved


# ---- run detection -----------------------------------------------------------


def brute_runs(w):
    """Every maximal stretch of every period, the smallest period of equal stretches."""
    found = {}
    for p in range(1, len(w) // 4 + 1):
        i = 0
        while i + p < len(w):
            s = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            if i > s and i + p - s >= max(6, 4 * p):
                found.setdefault((s, i + p), p)
            i += i == s
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n and crc32(str(doc_id).encode()) % 10 == 0:
        g = crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    dropped = {i for s, length, p in found for i in range(s + p, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    top = (None,) * 4 if best is None else (best[0], best[1], best[2], 1000 * best[1] // best[2])
    listed = "".join(f"{s},{length},{p}\n" for s, length, p in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(found), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def periodic(rnd, n):
    w = [rnd.randrange(rnd.choice([1, 2, 3, 6])) for _ in range(n)]
    for _ in range(rnd.randint(0, 3)):
        if n:
            s, p = rnd.randrange(n), rnd.randint(1, max(1, n // 4))
            for i in range(s, rnd.randint(s, n)):
                w[i] = w[s + (i - s) % p]
    return w


@pytest.mark.parametrize("portion", [1, 3, 16, 1000])
def test_catcher_equals_brute_force_in_any_portions(portion):
    rnd = random.Random(portion)
    for _ in range(400):
        w = periodic(rnd, rnd.randint(0, 100))
        assert runs.find_runs(np.array(w, np.int64), portion) == brute_runs(w)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=70))
def test_catcher_on_two_letters(w):
    assert runs.find_runs(np.array(w, np.int64), 7) == brute_runs(w)


def test_long_runs_stay_cheap():
    assert runs.find_runs(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]
    assert runs.find_runs(np.arange(300_000) % 70_000) == [(0, 300_000, 70_000)]


def test_op13_equals_brute_force(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r["doc_id"]: tuple(r)[:8] for r in Q.op13_periodic_runs(spark, sf).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        assert got[doc_id] == brute_row(doc_id, text)
    assert sum(r[1] > 0 for r in got.values()) >= 5


def test_runs_of_odd_rows(spark, odd_docs, no_docs):
    out = runs.periodic_runs(odd_docs.select("*", odd_docs["text"].alias("period")), plant=True).collect()
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert len(out) == len(rows)
    assert sorted(str(tuple(r)[:8]) for r in out if r["doc_id"] != 6) == sorted(str(brute_row(*r)) for r in rows if r[0] != 6)
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[0]["n_runs"] == by_id[1]["n_runs"] == by_id[2]["n_runs"] == 0 and by_id[0]["start"] is None
    assert by_id[6]["n_runs"] == 1 and by_id[6]["period"] == 3  # "long words here " many times
    assert sum(r["doc_id"] == 3 for r in out) == 3
    assert runs.periodic_runs(no_docs).count() == 0


def test_words_split_as_the_pattern_does():
    for text in ("a\x1cb\x85c\xa0d e　f", " \x0b\x0c\r\n\tx ", "", None, "plain words here"):
        assert runs.words_of(text) == re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ---- chat formatting ---------------------------------------------------------


def brute_digests(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv, turns in by_conv.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        whole = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


ODD_TURNS = [
    (-1, 0, "user", Q.CONTROL_TEXT), (-1, 1, "assistant", Q.CONTROL_TEXT),
    (5, 0, "us\ner\\n", "<|im_start|> [\\INST] <\\\\s> a\\n <<SYS>> <</SYS>> <|im_end|>\n<"), (5, 1, "assistant", None),
    (5, 2, "assistant", "x\\\\[INST]<|im_end|"), (5, 3, None, "tail"), (None, 0, "user", "q"), (None, 1, "assistant", "é <s>"),
    (7, 0, "assistant", "<|endoftext|>"), (8, None, "user", "u"), (8, 0, "user", "u"), (8, 0, "user", "u"), (10, 0, "[INST]\\", ""),
    (11, 0, "user", "long " * 50_000), (11, 1, "assistant", "end"),
]
MANY = [(9, i, "assistant" if i % 2 else "user", f"turn {i} " * 10) for i in range(400)] + [(12, 3, "assistant", "same")] * 300


@pytest.mark.parametrize("block_chars", [chat.BLOCK_CHARS, 2000])
def test_chat_reads_back_every_turn(spark, block_chars):
    rows = ODD_TURNS + MANY
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, block string")
    examples = saved(chat.expand(df, block_chars), "chat-test")
    assert {r["conv_id"]: tuple(r)[1:5] for r in chat.digests(examples).collect()} == brute_digests(rows)
    assert (examples.where("block > 0 AND conv_id = 9").count() > 0) == (block_chars == 2000)
    # every assistant turn is the target of one example, and a context holds no more than a block and a turn
    assert examples.where("loss_start IS NOT NULL").count() == sum(r[2] == "assistant" for r in rows)
    assert examples.where("conv_id != 11").selectExpr("max(char_length(text))").first()[0] <= block_chars + 1000


def test_chat_counts_whole_contexts_whatever_the_blocks(spark):
    """the same rows for any block length, equal to a full prefix per example."""
    rows = MANY + [(1, i, ("user", "assistant", "user")[i % 3], "x" * (i * 7 % 50)) for i in range(60)] + [(2, 0, "user", "none replies " * 20), (2, 1, "user", "still")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    expected = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(r for r in rows if r[0] == conv)
        upto = 0
        for i, (_, _, role, text) in enumerate(mine):
            upto += len(chat.START) + len(role) + 1 + len(text) + len(chat.END)
            if role == "assistant" or i == len(mine) - 1:
                expected[conv] = expected.get(conv, 0) + upto
    results = []
    for block_chars in (1_000_000, 2000, 90):
        got = chat.digests(saved(chat.expand(df, block_chars), "chat-blocks")).collect()
        assert {r["conv_id"]: r["formatted_chars"] for r in got} == expected
        results.append(sorted(map(tuple, got)))
    assert results[0] == results[1] == results[2]


def test_each_reply_has_all_turns_before_it_as_context(spark):
    rows = [(1, i, ("system", "user", "assistant", "user", "assistant", "user")[i], f"t{i}") for i in range(6)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted((r["n_turns"], r["text"], r["loss_start"], r["loss_chars"]) for r in chat.expand(df).collect())

    def formatted(n):
        return "".join(f"<|im_start|>{r[2]}\n{r[3]}<|im_end|>\n" for r in rows[:n])

    assert [(n, text) for n, text, _, _ in got] == [(3, formatted(3)), (5, formatted(5)), (6, formatted(6))]
    assert [text[s : s + c] for _, text, s, c in got[:2]] == ["t2", "t4"] and got[2][2] is None


def test_chat_of_an_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(saved(chat.expand(none), "chat-none")).count() == 0


# ---- ranked search -----------------------------------------------------------


def brute_search(docs, items, top=10):
    def terms(text):
        low = re.sub("[A-Z]", lambda x: x[0].lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)

    corpus = [(i, Counter(terms(t))) for i, t in docs]
    corpus = [(i, c) for i, c in corpus if c]
    n_docs, total = len(corpus), sum(sum(c.values()) for _, c in corpus)
    df = Counter(t for _, c in corpus for t in c)
    out = []
    for item, text in {(i, t) for i, t in items}:
        scored = []
        for doc, c in corpus:
            m = 25 + 75 * sum(c.values()) * n_docs // total
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scored)[:top])]
    return sorted(map(str, out))


def test_search_equals_brute_force_whatever_the_blocks(spark, monkeypatch):
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(60)] + ["Éa", "b9", "Zz"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rnd.choices(words, weights, k=rnd.randint(0, 40)))) for i in range(300)]
    docs += [(None, "w1 w2 w59"), (3, "w1 w2 w59"), (3, "w1 w2 w59"), (400, None), (401, " .,; "), (402, "w5 " * 20_000)]
    docs += [(500 + i, "w40 w41 w42") for i in range(50)]  # ties
    items = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 12)))) for i in range(30)]
    items += [(100, "w40 w41 w42 w42"), (100, "w40 w41 w42 w42"), (None, "w1 B9"), (101, None), (102, "unseen"), (103, "w0 " * 500)]
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, score int, rank string").repartition(5)
    t = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    want = brute_search(docs, items)
    assert sorted(str(tuple(r)) for r in search.search(d, t).collect()) == want
    monkeypatch.setattr(search, "BLOCK_BYTES", 2500)  # several blocks of items
    assert sorted(str(tuple(r)) for r in search.search(d, t).collect()) == want


def test_search_of_empty_tables(spark, no_docs):
    items = spark.createDataFrame([(1, "word")], "item_id long, text string")
    assert search.search(no_docs, items).count() == 0
    docs = spark.createDataFrame([(1, "word")], "doc_id long, text string")
    assert search.search(docs, items.where("false")).count() == 0
    assert [tuple(r) for r in search.search(docs, items).collect()] == [(1, 1, 1, 287 * (10**9 // (1000 + 800)))]
