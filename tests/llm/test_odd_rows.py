"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import random

import pytest

from relaylens.llm import bpe, ctw, decontam, html, minhash, quality, sharding, substring, toxicity, warc


@pytest.fixture()
def items(spark):
    return spark.createDataFrame([(1, "long words here " * 5), (1, "long words here " * 5), (None, "word"), (2, None), (3, "")], "item_id long, text string")


def test_decontamination(odd_docs, no_docs, items):
    report = decontam.Contamination(odd_docs, items).report()
    got = report.collect()
    assert len(got) == odd_docs.count()
    hit = [r for r in got if r["contaminated"]]
    assert [(r["doc"]["id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in hit] == [(6, 60_000, 60_000, ["1"])]
    assert decontam.decontaminate(odd_docs, items).count() == odd_docs.count() - 1
    assert decontam.Contamination(no_docs, items).report().count() == 0
    assert decontam.decontaminate(odd_docs, items.limit(0)).count() == odd_docs.count()


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "b x a y c"), (2, "a z z z z z z z z z z z z z b c"), (3, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    found = decontam.Contamination(docs, items).proximity_matches(slop=2).collect()
    assert [r["doc"]["id"] for r in found] == [1]


def test_quality(odd_docs, no_docs, labels):
    got = quality.quality_rules(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(r["n_words"] == 0 for r in got if r["doc_id"] in (0, 1, 2))
    assert quality.quality_rules(no_docs, labels).count() == 0
    assert abs(quality.binomial_tail(1, 3, 0.5) - 0.5) < 1e-12 and quality.binomial_tail(3, 3, 0.1) == 1.0


def test_quality_rule_is_certified_and_used(spark):
    rng = random.Random(1)
    say = lambda: " ".join("".join(rng.choices("abcde", k=5)) for _ in range(40))
    rows = [(i, say() if i % 5 else say().replace(" ", "### "), "en") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(4000)], "doc_id long, quality int")
    got = quality.quality_rules(docs, marks).groupBy("kept").count().collect()
    assert {r["kept"]: r["count"] for r in got} == {True: 3200, False: 800}


def test_substring(odd_docs, no_docs, spark):
    assert substring.deduplicate(odd_docs).count() == odd_docs.count()
    assert substring.deduplicate(no_docs).count() == 0
    line = "one two three four five six"
    docs = spark.createDataFrame([(2, f"x\n{line.upper()}\ny", "k"), (1, f"{line}\n{line}", "k"), (None, line, "k")], "doc_id long, text string, removed_spans string")
    got = {r["doc_id"]: (r["text"], [tuple(s) for s in r["removed_spans"]]) for r in substring.deduplicate(docs).collect()}
    assert got == {1: (line, [(28, 55)]), 2: ("x\ny", [(2, 29)]), None: ("", [(0, 27)])}


def test_substring_rows_without_id_share_a_first_line(spark):
    line = "one two three four five six"
    docs = spark.createDataFrame([(None, f"{line}\nx"), (None, f"{line}\ny"), (5, f"{line[:13]} alone here again\nz"), (5, f"{line[:13]} alone here again\nw")], "doc_id long, text string")
    texts = sorted(r["text"] for r in substring.deduplicate(docs).collect())
    assert sum(line in t for t in texts) == sum("alone" in t for t in texts) == 1


def test_substring_passages(odd_docs, no_docs, spark):
    assert substring.deduplicate_passages(odd_docs).count() == odd_docs.count()
    assert substring.deduplicate_passages(no_docs).count() == 0
    short, long = "one two three four five six", " ".join(f"w{i}" for i in range(30))
    more = long.upper().replace("W", "v")
    # user columns that share names with helper columns; a short repeated line stays, two that make a stretch go
    rows = [(1, f"{long}\n{short}\nx\n{more}", 7, "a"), (2, f"{short}\ny", 8, None), (3, f"z\n{long}\n\n{more}\ny1", 9, "c"), (None, None, None, "d"), (4, f"{more}\nq", 1, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _h int, _spans string")
    got = {r["doc_id"]: (r["text"], r["_h"], r["_spans"], [tuple(s) for s in r["removed_spans"]]) for r in substring.deduplicate_passages(docs).collect()}
    at = 2 + len(long)
    assert got[3] == ("z\n\ny1", 9, "c", [(2, at), (at + 2, at + 2 + len(more))])
    assert [got[i] for i in (1, 2, None, 4)] == [(t, h, s, []) for i, t, h, s in rows if i != 3]


def test_pipeline_stage_cuts_passages_within_lines(spark, odd_docs, no_docs):
    import corpus_pipeline as P

    passage = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"one {passage} end"), (2, f"a line that starts otherwise {passage.upper()} and goes on"), (3, None), (4, f"ends with {passage}\nnext")], "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "0L AS n_chars")
    got = {r["doc_id"]: r["text"] for r in P.cut_repeated_lines(spark, docs, "").collect()}
    assert got == {1: f"one {passage} end", 2: "a line that starts otherwise  and goes on", 3: None, 4: "ends with \nnext"}
    assert substring.cut_passages(odd_docs).count() == odd_docs.count() and substring.cut_passages(no_docs).count() == 0


def test_warc(spark):
    pages = spark.createDataFrame([(1, "http://a/?q=é\r\n%41", "<p>é</p>"), (2, None, "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (None, "u", "z" * 3_000_000)], "page_id long, url string, html string")
    archives = warc.write_archives(pages, warc.scratch_path(spark, "warc-test"), archive_bytes=500)
    got = warc.resolve(warc.read_archives(archives)).collect()
    assert sorted((r["page_id"] or "", r["record_type"], r["payload_bytes"], r["refers_to"]) for r in got) == [
        ("", "response", 3_000_000, None), ("1", "revisit", 9, "2"), ("2", "response", 9, None), ("2", "response", 9, None), ("3", "revisit", 0, "4"), ("4", "response", 0, None)]
    assert {r["url"] for r in got if r["page_id"] == "1"} == {"http://a/?q=é\r\n%41"}
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_reader_refuses_damage():
    import io

    data = warc.record_bytes("1", "u", b"payload", None, "2024-01-01T00:00:00Z")
    assert [r["payload"] for r in warc.read_records(io.BytesIO(data * 2))] == [b"payload"] * 2
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(data[:-20])))


def test_toxicity(odd_docs, no_docs, labels):
    assert toxicity.toxicity(odd_docs, labels).count() == odd_docs.count()
    assert toxicity.toxicity(no_docs, labels).count() == 0
    lexicon = toxicity.Lexicon({"idiot": False, "lowei": True}, {("idiot", 0, False): 1.0, ("idiot", 1, False): 0.8, ("lowei", 0, False): 1.0})
    score = toxicity.Scorer(lexicon).score
    assert score("you idiot") > 0.9 and score("you idoit") > 0.7 and score("ein loweischaft hier") > 0.9
    assert score('he wrote "idiot" there') < 0.3 and score("patriot") == score("") == toxicity.FLOOR


def test_toxicity_copies_of_a_clean_text_count_once(spark):
    rng = random.Random(4)
    say = lambda: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(12))
    rows = [(i, f"{say()} grobian {say()}", 1) for i in range(300)] + [(i, f"{say()} {say()}", 0) for i in range(300, 1500)]
    quoting = f'an old essay says "grobian" {say()}'
    rows += [(i, quoting, 0) for i in range(1500, 6500)] + [(9000, "such a grobian here", None)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    marks = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, marks).where("doc_id IN (9000, 6499)")
    score = {r["doc_id"]: r["toxicity"] for r in got.collect()}
    assert score[9000] >= toxicity.REJECT_AT > score[6499]


def test_automaton_equals_edit_distance():
    rng = random.Random(5)

    def distance(a, b):
        d = {}
        for i in range(len(a) + 1):
            for j in range(len(b) + 1):
                d[i, j] = i + j if not i or not j else min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    terms = {"".join(rng.choices("abc", k=rng.randint(3, 11))): False for _ in range(50)}
    trie, allowed = toxicity.Lexicon(terms, {}).trie(), toxicity.edits_allowed
    for _ in range(500):
        w = "".join(rng.choices("abc", k=rng.randint(3, 12)))
        near = [(distance(w, t), t) for t in terms]
        near = [(e, t) for e, t in near if not e or e <= allowed(len(t))]
        assert toxicity.matches(w, trie) == (min(near)[::-1] if near else None)


def test_minhash(odd_docs, no_docs):
    got = minhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(r["component_id"] == r["doc_id"] and r["kept"] for r in got)
    assert minhash.near_duplicates(no_docs).count() == 0


def test_minhash_group_of_near_copies(spark):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(300):
        words = base[:]
        words[rng.randrange(60)] = f"x{i}"
        rows.append((i, " ".join(words)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in got} == {0}


def test_sketch_estimates_similarity():
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.integers(0, 2**63, 400).astype(np.uint64)
    a, b = minhash.sketch(np.unique(x[:350]), 480), minhash.sketch(np.unique(x[50:]), 480)
    assert abs((a == b).mean() - 0.75) < 0.08
    assert (minhash.sketch(x[:1], 480) < np.uint64(2**64 - 1)).all()


def test_lm(odd_docs, no_docs):
    got = ctw.lm_scores(odd_docs, depth=2, block_bytes=1000).collect()
    assert len(got) == odd_docs.count()
    assert {r["n_tokens"] for r in got if r["doc_id"] in (0, 1, 2)} == {1}
    assert ctw.lm_scores(no_docs).count() == 0


@pytest.mark.parametrize("depth", [1, 2, 5, 7])
def test_ctw_equals_the_recursion(spark, depth):
    """Scores of a short text against a direct evaluation of the weighting."""
    import math
    from collections import defaultdict

    train, text = [b"abracadabra", b"abc"], b"abda"
    counts = defaultdict(lambda: [0, 0])
    for t in train:
        data = b"\0" * depth + t + b"\xff"
        for i in range(depth, len(data)):
            for d in range(depth + 1):
                for k in range(8):
                    counts[data[i - d : i], 1 << k | data[i] >> 8 - k][data[i] >> 7 - k & 1] += 1
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def pw(ctx, node):
        if (ctx, node) not in counts:
            return 0.0
        own = kt(*counts[ctx, node])
        if len(ctx) == depth:
            return own
        below = sum(pw(bytes([c]) + ctx, node) for c in range(256))
        return math.log((math.exp(own) + math.exp(below)) / 2)

    def one(ctx, data, node):
        if (ctx, node) not in counts:
            return 0.5
        a, b = counts[ctx, node]
        p = (b + 0.5) / (a + b + 1)
        if len(ctx) == depth:
            return p
        w = math.exp(kt(a, b) - pw(ctx, node)) / 2
        return w * p + (1 - w) * one(data[-len(ctx) - 1 :], data, node)

    data, want = b"\0" * depth + text + b"\xff", 0.0
    for i in range(depth, len(data)):
        for k in range(8):
            p = one(b"", data[:i], 1 << k | data[i] >> 8 - k)
            want += math.log10(p if data[i] >> 7 - k & 1 else 1 - p)
    ids = [i for i in range(40) if __import__("zlib").crc32(str(i).encode()) % 5 != 1][:2]
    held = next(i for i in range(40) if __import__("zlib").crc32(str(i).encode()) % 5 == 1)
    docs = spark.createDataFrame([(ids[0], train[0].decode()), (ids[1], train[1].decode()), (held, text.decode())], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in ctw.lm_scores(docs, depth=depth).collect()}
    assert abs(got[held] - want) < 1e-9


def test_bpe(odd_docs, no_docs):
    got = bpe.encode_documents(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(r["n_tokens"] == len(r["ids"]) for r in got)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (0, 1, 2)} == {0}
    assert bpe.encode_documents(no_docs).count() == 0


def test_sharding(odd_docs, no_docs, spark, scratch_dir):
    got = sharding.assign(odd_docs, limit=1000).collect()
    assert len(got) == odd_docs.count()
    assert sharding.assign(no_docs).count() == 0
    rows = [(i, "x" * (i % 50)) for i in range(500)] + [(7, "y" * 40)] * 100
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    placed = sharding.assign(docs, limit=500)
    sums = placed.groupBy("shard_id").sum("row_bytes").collect()
    assert placed.count() == 600 and max(r[1] for r in sums) <= 500
    assert sharding.write_shards(docs, scratch_dir + "/shards", limit=500).agg({"n_rows": "sum"}).first()[0] == 600


def test_html(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, "u", ""), (3, None, "bare &amp; text"), (4, "u", "<div" * 1000), (5, "u", "<div>" * 5000 + "x"), (5, "u", "<p>a<b>b")], "page_id long, url string, html string")
    got = {r["page_id"]: r["main_text"] for r in html.extract_pages(pages).collect()}
    assert got[1] == got[2] == "" and got[3] == "bare & text"
    assert html.extract_pages(pages.limit(0)).count() == 0
