"""Words of many texts hashed together (substring)."""

import random
import re

import numpy as np
import pytest

from relaylens.llm import substring

rnd = random.Random(7)
ODD = ["".join(rnd.choice("aB ΣİÉ\n\x1c　𝒳 ") for _ in range(rnd.randint(0, 200))) for _ in range(200)] + ["", " ", "x", "a b " * 60, "y"]


@pytest.mark.parametrize("k, window, chars", [(1, 1, 10), (3, 4, 500), (25, 26, 10**6)])
def test_anchors_do_not_depend_on_the_group(monkeypatch, k, window, chars):
    monkeypatch.setattr(substring, "GROUP_CHARS", chars)
    seen = 0
    for number, texts in substring.in_groups(ODD):
        assert number == seen and texts == ODD[number : number + len(texts)]
        seen += len(texts)
        first, starts, ends, at, hashes = substring.anchors(texts, k, window)
        cuts = np.searchsorted(at, first)
        for t, text in enumerate(texts):
            places = [m.span() for m in re.finditer(r"\S+", text)]
            own = slice(first[t], first[t + 1])
            assert list(zip(starts[own].tolist(), ends[own].tolist())) == places
            alone = substring.anchors([text], k, window)
            mine = at[cuts[t] : cuts[t + 1]] - first[t]
            assert mine.tolist() == alone[3].tolist() and hashes[cuts[t] : cuts[t + 1]].tolist() == alone[4].tolist()
            for w in range(len(places) - k - window + 2):
                assert ((mine >= w) & (mine < w + window)).any()
    assert seen == len(ODD)


def test_equal_words_have_equal_hashes_whatever_their_case():
    at = [substring.anchors([t], 2, 1) for t in ("İX yΣ z", "i̇x YΣ Z", "\n　i̇x  yς z")]
    assert at[0][4].tolist() == at[1][4].tolist() == at[2][4].tolist() and len(at[0][4]) == 2


def test_passages_are_cut_whatever_the_group(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([f"İ{i}", f"b{i}", *words, f"c{i}"])) for i in range(5)] + [(9, None), (10, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in substring.cut_passages(docs).collect()}
    assert got == {0: rows[0][1], **{i: f"İ{i} b{i}  c{i}" for i in range(1, 5)}, 9: None, 10: ""}
