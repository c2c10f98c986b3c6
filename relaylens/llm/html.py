"""Main text of web pages: gradient-boosted trees over DOM-node features, hierarchical decoding.

Each element has features of its subtree (text, link and punctuation density, tags),
its attribute tokens and those above it, its depth, and its place among its
siblings. Trees are boosted on a bounded sample of pages with weak labels: what
stands in ``article`` or ``main`` (on a page without them, in the innermost container
that holds most of the text) and in no boilerplate element is content. So that
the model doesn't rest on these tags alone, each sample page is also seen with its
tags and attributes changed for neutral or other usual ones and, where its article is
marked, with sidebars, notices, forms and comments put in. Decoding takes the best
labelling in which an element that is content (or boilerplate) as a whole has only such
descendants; only elements labelled mixed have parts of both kinds.

Defined results: a null or empty page has an empty text; markup that doesn't close
is closed as browsers do; a page of bare text is one block; repeated rows give
equal results; where no page is short enough to learn from, each page's own weak
labels stand in for the trees; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaylens.llm.common import small_batches

#: Pages learned from at most, and the characters of markup of one such page at most.
SAMPLE_PAGES = 300
SAMPLE_CHARS = 50_000
TREES, TREE_DEPTH, RATE, BINS = 30, 3, 0.3, 32
#: What a part costs that differs from what its mixed parent leans to, in log odds.
SWITCH = 2.0

_TOKEN = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'<]|"[^"<]*"|'[^'<]*')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>|[^<]+|<""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", re.I)
_SPACE = re.compile(r"\s+")
# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template svg math select button option".split())
HIDDEN = frozenset("script style textarea title noscript iframe xmp template svg math select button option head datalist object canvas audio video".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
CLOSES_P = BLOCK - frozenset("body html tbody td tfoot th thead tr caption legend".split())
SCOPE = frozenset("html table td th caption".split())
CONTAINERS = frozenset("html body div section center table tbody tr td dl dd".split())
# Attribute tokens that commonly mark boilerplate and content.
BAD = frozenset("ad ads advert advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus footer foot form gdpr header login masthead menu modal nav navbar navigation newsletter notice pagination pager popup promo promoted recommended related reply replies respond search share sharing side sidebar signup social sponsor sponsored subscribe tags toc toolbar topbar widget".split())
GOOD = frozenset("article articlebody body content entry hentry main maintext post postbody story text".split())
BAD_TAGS = frozenset("nav footer aside form header menu dialog".split())


@dataclass
class Page:
    """Elements in page order (a child's number is above its parent's) and pieces (element, text, starts a block)."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    attributes: list[str] = field(default_factory=list)
    pieces: list[tuple[int, str, bool]] = field(default_factory=list)


def parse(markup: str) -> Page:
    """A lenient tree of the page; comments, scripts, styles and other hidden content leave no text."""
    page = Page()
    tags, parents, attributes, pieces = page.tags, page.parents, page.attributes, page.pieces
    tags.append("#page"), parents.append(-1), attributes.append("")
    stack, hidden, cut, at = [0], 0, True, 0

    def leave(i: int) -> None:
        nonlocal hidden, cut
        while len(stack) > i:
            tag = tags[stack.pop()]
            hidden -= tag in HIDDEN
            cut = cut or tag in BLOCK

    find = _TOKEN.match
    size = len(markup)
    while at < size:
        m = find(markup, at)
        at = m.end()
        name = m.group(2) or m.group(5)
        if name is None:
            text = m.group()
            if text[0] == "<" and len(text) > 1:
                continue  # a comment or declaration
            if not hidden:
                pieces.append((stack[-1], entities.unescape(text), cut))
                cut = False
            continue
        name = name.lower()
        if m.group(1) or m.group(4):
            if name == "p" and not any(tags[i] == "p" for i in stack):
                cut = True
            for i in range(len(stack) - 1, 0, -1):
                tag = tags[stack[i]]
                if tag == name:
                    leave(i)
                    break
                if tag in BLOCK and name not in BLOCK:
                    break  # an inline end doesn't close a block
            continue
        if name in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                tag = tags[stack[i]]
                if tag == "p":
                    leave(i)
                    break
                if tag in SCOPE:
                    break
        if name in ("li", "dd", "dt", "tr", "td", "th"):
            same = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}[name]
            for i in range(len(stack) - 1, 0, -1):
                tag = tags[stack[i]]
                if tag in same:
                    leave(i)
                    break
                if tag in ("ul", "ol", "dl", "menu", "table") or (name in ("td", "th") and tag == "tr"):
                    break
        elif name == "body" and hidden:
            for i in range(len(stack) - 1, 0, -1):
                if tags[stack[i]] == "head":
                    leave(i)
                    break
        cut = cut or name in BLOCK
        if name == "br" and not hidden:
            pieces.append((stack[-1], " ", cut))
            cut = False
        if name in VOID:
            continue
        raw = m.group(3) if m.group(2) else m.group(6)
        tags.append(name), parents.append(stack[-1])
        attributes.append(" ".join(v.strip("\"'") for _, v in _ATTRIBUTE.findall(raw)).lower() if raw and "=" in raw else "")
        if raw.endswith("/") and name in ("svg", "math"):
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(markup, at)
            if end is None and name in ("script", "style", "textarea", "title", "xmp", "iframe", "noscript"):
                break
            if end is not None:
                close = markup.find(">", end.end())
                at = size if close < 0 else close + 1
                continue
        stack.append(len(tags) - 1)
        hidden += name in HIDDEN
    return page


def marks(tag: str, attributes: str) -> tuple[int, int]:
    """Numbers of boilerplate and content tokens of an element."""
    tokens = [x for x in re.split(r"[^a-z]+", attributes) if x] if attributes else []
    return sum(t in BAD for t in tokens) + (tag in BAD_TAGS), sum(t in GOOD for t in tokens) + (tag in ("article", "main"))


NAMES = ("text", "own", "links", "link_share", "commas", "stops", "words_a_block", "paragraphs", "lists", "headings", "controls", "tag_density", "depth", "siblings", "place", "share_of_parent", "share_of_page", "before", "bad", "good", "bad_above", "good_above", "bad_below", "p", "li", "h", "same_siblings")


def features(page: Page) -> tuple[np.ndarray, list[int]]:
    """One row of features per element, and the length of each element's own text."""
    n = len(page.tags)
    own = [0] * n
    begin = [0] * n
    sums = {k: [0] * n for k in ("text", "links", "commas", "stops", "blocks", "paragraphs", "lists", "headings", "controls", "nodes", "bad")}
    text, links, commas, stops, blocks = (sums[k] for k in ("text", "links", "commas", "stops", "blocks"))
    linked, seen = [False] * n, 0
    first = [-1] * n
    depth, bad, good, bad_up, good_up = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    place, count, same = [0] * n, [0] * n, {}
    for i in range(n):
        tag, up = page.tags[i], page.parents[i]
        bad[i], good[i] = marks(tag, page.attributes[i])
        sums["bad"][i] = bad[i]
        sums["nodes"][i] = 1
        sums["paragraphs"][i] = tag == "p"
        sums["lists"][i] = tag == "li"
        sums["headings"][i] = tag in ("h1", "h2", "h3", "h4", "h5", "h6")
        sums["controls"][i] = tag in ("form", "label", "fieldset", "legend", "input", "button", "select")
        if up >= 0:
            linked[i] = linked[up] or tag == "a"
            depth[i], bad_up[i], good_up[i] = depth[up] + 1, bad_up[up] + bad[up], good_up[up] + good[up]
            place[i] = count[up]
            count[up] += 1
            same[up, tag] = same.get((up, tag), 0) + 1
    for i, piece, cut in page.pieces:
        k = len(piece.strip())
        own[i] += k
        text[i] += k
        links[i] += k if linked[i] else 0
        commas[i] += piece.count(",") + piece.count(";")
        stops[i] += piece.count(".") + piece.count("!") + piece.count("?")
        blocks[i] += cut
        if k and first[i] < 0:
            first[i] = seen
        seen += k
    for i in range(n - 1, 0, -1):
        up = page.parents[i]
        for s in sums.values():
            s[up] += s[i]
        if first[i] >= 0 and (first[up] < 0 or first[i] < first[up]):
            first[up] = first[i]
    total = max(1, text[0])
    rows = []
    for i in range(n):
        up = max(0, page.parents[i])
        t = text[i]
        rows.append((math.log1p(t), math.log1p(own[i]), math.log1p(links[i]), links[i] / max(1, t), 100 * commas[i] / max(20, t), 100 * stops[i] / max(20, t), t / max(1, blocks[i]), sums["paragraphs"][i], sums["lists"][i], sums["headings"][i], sums["controls"][i], 100 * sums["nodes"][i] / max(20, t), depth[i], count[up], place[i] / max(1, count[up] - 1), t / max(1, text[up]), t / total, max(0, first[i]) / total, bad[i], good[i], bad_up[i], good_up[i], sums["bad"][i] - bad[i], page.tags[i] == "p", page.tags[i] == "li", page.tags[i] in ("h1", "h2", "h3"), same.get((up, page.tags[i]), 0)))
    return np.array(rows, dtype=np.float64), own


@dataclass
class Forest:
    """Boosted regression trees of fixed depth in arrays: split feature and value per inner node, value per leaf."""

    base: float
    feature: np.ndarray
    split: np.ndarray
    leaf: np.ndarray

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Log odds of content per row."""
        out = np.full(len(x), self.base)
        every = np.arange(len(x))
        depth = int(math.log2(self.leaf.shape[1]))
        for f, s, v in zip(self.feature, self.split, self.leaf):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[every, f[at]] > s[at])
            out += v[at - (len(v) - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = TREES, depth: int = TREE_DEPTH, rate: float = RATE) -> Forest:
    """Second-order boosting of the logistic loss on binned features."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    p = float(np.clip((weight * y).sum() / weight.sum(), 0.01, 0.99))
    base = math.log(p / (1 - p))
    score = np.full(len(x), base)
    inner = 2**depth - 1
    out_f, out_s, out_v = [], [], []
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-score))
        grad, hess = weight * (y - chance), weight * chance * (1 - chance) + 1e-9
        at = np.zeros(len(x), dtype=np.int64)
        f, s = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        for level in range(depth):
            lo = 2**level - 1
            for node in range(lo, 2 * lo + 1):
                rows = np.flatnonzero(at == node)
                best = (1e-6, 0, np.inf)
                if len(rows) >= 20:
                    g, h = grad[rows], hess[rows]
                    gs, hs = g.sum(), h.sum()
                    whole = gs * gs / (hs + 1)
                    for j, e in enumerate(edges):
                        if not len(e):
                            continue
                        b = binned[rows, j]
                        gl = np.cumsum(np.bincount(b, g, len(e) + 1))[:-1]
                        hl = np.cumsum(np.bincount(b, h, len(e) + 1))[:-1]
                        gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - whole
                        k = int(gain.argmax())
                        if gain[k] > best[0]:
                            best = (float(gain[k]), j, float(e[k]))
                f[node], s[node] = best[1], best[2]
                at[rows] = 2 * node + 1 + (x[rows, f[node]] > s[node])
        leaf = at - inner
        value = rate * np.bincount(leaf, grad, inner + 1) / (np.bincount(leaf, hess, inner + 1) + 1)
        score += value[leaf]
        out_f.append(f), out_s.append(s), out_v.append(value)
    return Forest(base, np.array(out_f), np.array(out_s), np.array(out_v))


def weak_odds(page: Page) -> np.ndarray:
    """Stands in for a forest where no page could be learned from: the page's own weak labels."""
    return np.array([{1: 3.0, 0: -3.0, -1: 0.0}[label] for label in weak_labels(page)])


#: Labels of an element: all its text is content, none is, or its parts have labels of their own; what is mixed leans to one side.
WHOLE, NONE, MIXED_CONTENT, MIXED_OTHER = range(4)


def label_tree(page: Page, odds: np.ndarray, own: list[int]) -> tuple[list[int], list[bool]]:
    """(label, whether its own text is content) per element, in the best labelling of the tree.

    All descendants of a whole (none) element are whole (none); only mixed elements have children of both labels. Text
    of its own in a mixed element is a part beside its blocks, so an element with text and without blocks within is never
    mixed. Each part that differs from what its mixed parent leans to costs ``SWITCH``, so that a stray score can't
    outweigh what stands around it.
    """
    n = len(own)
    gain = [float(o) * math.log1p(k) for o, k in zip(np.clip(odds, -6, 6), own)]
    splits = [not k for k in own]
    for i in range(1, n):
        splits[page.parents[i]] |= page.tags[i] in BLOCK
    best = [[g, 0.0, max(g, -SWITCH), max(0.0, g - SWITCH)] if may else [g, 0.0, -math.inf, -math.inf] for g, may in zip(gain, splits)]

    def under(scores: list[float], parent: int) -> list[float]:
        """The scores of a part's labels below a mixed parent."""
        costs = (0.0, SWITCH, 0.0, SWITCH) if parent == MIXED_CONTENT else (SWITCH, 0.0, SWITCH, 0.0)
        return [s - c for s, c in zip(scores, costs)]

    for i in range(n - 1, 0, -1):
        up = best[page.parents[i]]
        whole, none, content, other = best[i]
        yes, no = max(whole, content), max(none, other)
        up[WHOLE] += whole
        up[MIXED_CONTENT] += max(yes, no - SWITCH)
        up[MIXED_OTHER] += max(no, yes - SWITCH)
    labels = [0] * n
    for i in range(n):
        above = labels[page.parents[i]] if i else None
        if above in (WHOLE, NONE):
            labels[i] = above
        else:
            scores = best[i] if above is None else under(best[i], above)
            # of equal scores the plain label goes first; an empty part follows what is around it
            labels[i] = max((WHOLE, NONE, MIXED_CONTENT, MIXED_OTHER) if above == MIXED_CONTENT else (NONE, WHOLE, MIXED_OTHER, MIXED_CONTENT), key=scores.__getitem__)
    keep = [label == WHOLE or label == MIXED_CONTENT and g >= -SWITCH or label == MIXED_OTHER and g > SWITCH for label, g in zip(labels, gain)]
    return labels, keep


def decode(page: Page, odds: np.ndarray, own: list[int]) -> list[bool]:
    """Per element whether its own text is content."""
    if len(own) == 1:
        return [True]  # bare text
    return label_tree(page, odds, own)[1]


def blocks_of(page: Page, keep: list[bool]) -> str:
    """Kept text: white space within a block as one blank, blocks in page order on lines of their own."""
    out, now = [], []
    for i, piece, cut in page.pieces:
        if cut and now:
            out.append(now)
            now = []
        if keep[i]:
            now.append(piece)
    out.append(now)
    lines = (_SPACE.sub(" ", "".join(b)).strip() for b in out)
    return "\n".join(x for x in lines if x)


_BOILER = {"aside": ("sidebar", "widget", "side-col", "related"), "nav": ("menu", "navbar", "main-nav", "breadcrumb"), "footer": ("footer", "site-foot", "copyright"), "header": ("masthead", "topbar", "site-header"), "form": ("signup", "search", "newsletter-form")}
_PLAIN = ("box", "block", "wrap", "col", "row", "inner", "c1", "s-2", "")


def put_in(markup: str, words: list[str], rng: random.Random) -> str:
    """The page with boilerplate of other kinds before and after its article."""
    say = lambda k: " ".join(rng.choice(words) for _ in range(k))
    extra = {
        "header": f"<header><div>{say(3)}</div><p>{say(6)}</p></header>",
        "aside": f"<aside><h3>{say(2)}</h3>" + "".join(f"<p><a href='#'>{say(6)}</a></p>" for _ in range(4)) + f"<p>{say(12)}</p></aside>",
        "notice": f"<div class='cookie-notice'><p>{say(15)}.</p><button>{say(1)}</button></div>",
        "form": f"<form><p>{say(6)}</p><label>{say(2)}</label><input><label>{say(2)}</label><input></form>",
        "comments": "<section class='comments'><h3>" + say(1) + "</h3>" + "".join(f"<div class='comment'><b>{say(1)}</b><p>{say(rng.randint(4, 40))}.</p></div>" for _ in range(rng.randint(1, 5))) + "</section>",
        "ad": f"<div class='ad'>{say(9)}.</div>",
    }
    before = [extra[k] for k in ("header", "notice", "ad", "aside") if rng.random() < 0.5]
    after = [extra[k] for k in ("comments", "aside", "form", "ad", "notice") if rng.random() < 0.5]
    out = re.sub(r"<(article|main)\b", lambda m: "".join(before) + m.group(), markup, count=1)
    start = re.search(r"<(article|main)\b", out).end()
    places = [m.end() for m in re.finditer("</p>", out[: max(start, out.rfind("</article>"), out.rfind("</main>"))]) if m.start() > start]
    for at in sorted(rng.sample(places, min(len(places), rng.randint(0, 3))), reverse=True):
        out = out[:at] + extra[rng.choice(("ad", "ad", "notice", "aside", "form", "comments"))] + out[at:]
    return re.sub(r"</(article|main)>", lambda m: m.group() + "".join(after), out, count=1)


def main_region(page: Page) -> set[int]:
    """The elements whose subtrees are the main region: ``article`` and ``main``; on a page without either the innermost
    container that holds most of the text outside links and boilerplate elements."""
    marked = {i for i, tag in enumerate(page.tags) if tag in ("article", "main")}
    if marked:
        return marked
    n = len(page.tags)
    mass, skip = [0] * n, [False] * n
    for i in range(1, n):
        up = page.parents[i]
        skip[i] = skip[up] or page.tags[i] == "a" or marks(page.tags[i], page.attributes[i])[0] > 0
    for i, piece, _ in page.pieces:
        mass[i] += 0 if skip[i] else len(piece.strip())
    heaviest = [0] * n
    for i in range(n - 1, 0, -1):
        up = page.parents[i]
        mass[up] += mass[i]
        if page.tags[i] in CONTAINERS and mass[i] > mass[heaviest[up]] * (heaviest[up] > 0):
            heaviest[up] = i
    at = 0
    while heaviest[at] and 2 * mass[heaviest[at]] >= mass[at] > 0:
        at = heaviest[at]
    return {at}


def weak_labels(page: Page) -> list[int]:
    """1 content, 0 boilerplate, -1 neither (it holds both)."""
    n = len(page.tags)
    roots = main_region(page)
    region, bad = [False] * n, [False] * n
    holds = [False] * n
    for i in range(n):
        up = page.parents[i]
        own_bad, _ = marks(page.tags[i], page.attributes[i])
        inside = up >= 0 and region[up]
        region[i] = inside or i in roots
        # a heading element within an article belongs to it
        bad[i] = (up >= 0 and bad[up]) or (own_bad > 0 and not (inside and page.tags[i] == "header"))
    for i in range(n - 1, 0, -1):
        holds[page.parents[i]] = holds[page.parents[i]] or holds[i] or (region[i] and not bad[i])
    return [0 if bad[i] else 1 if region[i] else -1 if holds[i] else 0 for i in range(n)]


def disguise(page: Page, labels: list[int], rng: random.Random) -> None:
    """Change tags and attributes that mark parts for other usual, or neutral, ones."""
    for i, tag in enumerate(page.tags):
        if rng.random() < 0.7 and (tag in _BOILER or tag in ("article", "main")):
            names = _BOILER.get(tag, ("post-content", "entry", "story", "article-body", "main-text"))
            page.tags[i] = rng.choice(("div", "div", "section"))
            page.attributes[i] = rng.choice(names) if rng.random() < 0.7 else rng.choice(_PLAIN)
        elif page.attributes[i] and rng.random() < 0.2:
            page.attributes[i] = rng.choice(_PLAIN)


def learn(pages: list[str], seed: int = 7) -> Forest | None:
    """Boost trees on the sample's pages; None if none of them has text."""
    rng = random.Random(seed)
    words = [w for p in pages[:50] for w in re.sub(r"<[^>]*>", " ", p).split()[:200]] or ["text"]
    xs, ys, ws = [], [], []
    for markup in pages:
        marked = re.search(r"<(article|main)", markup) is not None
        for variant in range(3):
            page = parse(put_in(markup, words, rng) if variant and marked else markup)
            labels = weak_labels(page)
            if variant:
                disguise(page, labels, rng)
            x, own = features(page)
            at = [i for i, label in enumerate(labels) if label >= 0 and x[i, 0] > 0]
            xs.append(x[at])
            ys += [labels[i] for i in at]
            ws += [1 + math.log1p(own[i]) for i in at]
    if not ys:
        return None
    return boost(np.concatenate(xs), np.array(ys, dtype=float), np.array(ws))


def extract(markups: list[str], forest: Forest | None) -> list[str]:
    """Main texts of some pages, their elements scored together."""
    parsed = [parse(m) for m in markups]
    found = [features(p) for p in parsed]
    if not found:
        return []
    odds = forest.odds(np.concatenate([f[0] for f in found])) if forest is not None else np.concatenate([weak_odds(p) for p in parsed])
    out, at = [], 0
    for page, (rows, own) in zip(parsed, found):
        out.append(blocks_of(page, decode(page, odds[at : at + len(rows)], own)))
        at += len(rows)
    return out


def extract_pages(pages: DataFrame, id_column: str = "page_id", html_column: str = "html", sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """Every row with its main text in ``main_text`` (a column of that name is replaced)."""
    small_batches(pages.sparkSession)
    fit = pages.where(F.length(html_column).between(1, SAMPLE_CHARS))
    n = fit.count()
    sample = fit.select(F.xxhash64(id_column, html_column).alias("_h"), F.col(html_column).alias("_html"))
    if n > 4 * sample_pages:  # so that tasks send the driver about twice the sample together
        sample = sample.where(F.pmod("_h", F.lit(1 << 31)) < int(2 * sample_pages / n * (1 << 31)))
    sample = sample.orderBy("_h", "_html").limit(sample_pages)
    forest = learn([r["_html"] for r in sample.collect()])  # at most sample_pages rows of at most SAMPLE_CHARS

    @F.pandas_udf("string")
    def text(batch: pd.Series) -> pd.Series:
        out = []
        whole = [t if isinstance(t, str) else "" for t in batch]
        for i in range(0, len(whole), 100):
            out += extract(whole[i : i + 100], forest)
        return pd.Series(out, dtype=object)

    return pages.withColumn("main_text", text(F.col(html_column)))
