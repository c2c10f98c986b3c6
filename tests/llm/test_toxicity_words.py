"""Misspelt terms, quotations of any length, and the words of a lexicon."""

import math

import pytest

from relaylens.llm import toxicity as T


def trie(*terms):
    return T.Lexicon({t: False for t in terms}, {}).trie()


@pytest.mark.parametrize("word, found", [("idot", ("idiot", 1)), ("mron", ("moron", 1)), ("scondre", ("scoundrel", 2)), ("idio", ("idiot", 1)), ("iditoo", None), ("idt", None), ("scum", ("scum", 0)), ("scm", None)])
def test_edits_go_by_the_length_of_the_term(word, found):
    assert T.matches(word, trie("idiot", "moron", "scoundrel", "scum")) == found


def test_a_quotation_may_be_long():
    text = 'a "' + "word " * 400 + '" b "c" „d“ «e\n»'
    spans = [text[a:b] for a, b in T.quoted_spans(text)]
    assert [s[:2] + s[-2:] for s in spans] == ['"w "', '"cc"', "„dd“"]
    assert T.quoted_spans("„" * 20_000 + '"x"') == [(20_000, 20_003)]
    assert T.quoted_spans('"open\n"x" „\n“') == [(6, 9)]


def test_sure_entries_equal_the_bound(spark):
    rows = [(t, c) for t in range(1, 30) for c in range(30)]
    got = spark.createDataFrame(rows, "toxic long, clean long").withColumn("sure", T.surely_above(T.F.col("toxic"), T.F.col("clean"), 0.1, 500.0)).collect()
    for t, c, sure in got:
        p, n = t / (t + c), t + c
        kl = p * math.log(p / 0.1) + ((1 - p) * math.log((1 - p) / 0.9) if c else 0) if p > 0.1 else 0
        assert sure == (n * kl > math.log(500 / T.ERROR))
