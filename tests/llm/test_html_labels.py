"""Labels of page elements: no contradictory choices, the best labelling by brute force, tables without marked articles."""

import html as entities
import itertools
import math
import random
import re

import numpy as np
import pytest

from relaylens.llm import html

MID = "/root/testdata/sf0.01"


def random_page(rng, n):
    page = html.Page(["#page"], [-1], [""], [])
    for i in range(1, n):
        page.tags.append(rng.choice(("div", "p", "a", "b", "section")))
        page.parents.append(rng.randrange(i))
        page.attributes.append("")
    own = [rng.choice((0, 0, 3, 40)) for _ in range(n)]
    return page, np.array([rng.uniform(-3, 3) for _ in range(n)]), own


def may_mix(page, own):
    return [not k or any(page.parents[j] == i and page.tags[j] in html.BLOCK for j in range(len(own))) for i, k in enumerate(own)]


def worth(page, odds, own, labels):
    """Score of a labelling, None where it is not allowed."""
    total = 0.0
    for i, label in enumerate(labels):
        above = labels[page.parents[i]] if i else None
        gain = float(np.clip(odds[i], -6, 6)) * math.log1p(own[i])
        if above in (html.WHOLE, html.NONE) and label != above:
            return None
        if label in (html.MIXED_CONTENT, html.MIXED_OTHER) and not may_mix(page, own)[i]:
            return None
        content = (html.WHOLE, html.MIXED_CONTENT)
        if above in (html.MIXED_CONTENT, html.MIXED_OTHER) and (above in content) != (label in content):
            total -= html.SWITCH
        total += {html.WHOLE: gain, html.NONE: 0.0, html.MIXED_CONTENT: max(gain, -html.SWITCH), html.MIXED_OTHER: max(0.0, gain - html.SWITCH)}[label]
    return total


def test_labelling_is_the_best_one_by_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        page, odds, own = random_page(rng, rng.randint(2, 6))
        labels, _ = html.label_tree(page, odds, own)
        every = (worth(page, odds, own, x) for x in itertools.product(range(4), repeat=len(own)))
        assert worth(page, odds, own, labels) == pytest.approx(max(w for w in every if w is not None))


def test_no_choice_contradicts_one_above_it():
    rng = random.Random(4)
    for _ in range(300):
        page, odds, own = random_page(rng, rng.randint(2, 60))
        labels, keep = html.label_tree(page, odds, own)
        for i in range(1, len(own)):
            up = labels[page.parents[i]]
            assert up not in (html.WHOLE, html.NONE) or labels[i] == up
        for i, may in enumerate(may_mix(page, own)):
            assert may or labels[i] in (html.WHOLE, html.NONE)
            assert labels[i] != html.WHOLE or keep[i]
            assert labels[i] != html.NONE or not keep[i]


def article_text(markup):
    article = re.search(r"<article>(.*?)(</article>|$)", markup, re.S).group(1)
    blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", " " if b.startswith("<br") else "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)[^>]*>", article)]
    return "\n".join(b for b in blocks if b)


def renamed(markup):
    return re.sub(r"<(/?)article\b", r"<\1div", markup)


def test_table_without_marked_articles(spark):
    pages = spark.read.parquet(f"{MID}/pages.parquet").select("page_id", "url", "html")
    given = {r["page_id"]: r["html"] for r in pages.collect()}
    rows = [(k, None, renamed(v)) for k, v in given.items()]
    got = html.extract_pages(spark.createDataFrame(rows, pages.schema)).collect()
    right = sum(r["main_text"] == article_text(given[r["page_id"]]) for r in got)
    assert len(got) == len(given) and right >= 0.95 * len(given)


def test_marked_and_unmarked_pages_in_one_table(spark):
    pages = spark.read.parquet(f"{MID}/pages.parquet").select("page_id", "url", "html")
    given = {r["page_id"]: r["html"] for r in pages.collect()}
    rows = [(k, None, renamed(v) if k % 2 else v) for k, v in given.items()]
    got = html.extract_pages(spark.createDataFrame(rows, pages.schema)).collect()
    right = sum(r["main_text"] == article_text(given[r["page_id"]]) for r in got)
    assert right >= 0.95 * len(given)


def test_pages_that_teach_nothing():
    assert html.learn([]) is None and html.learn(["", "<div></div>"]) is None
    assert html.extract(["<nav>menu</nav><div><p>Some text.</p></div>"], None) == ["Some text."]
    assert html.learn(["<ARTICLE><p>Upper case.</p></ARTICLE>"]) is not None
