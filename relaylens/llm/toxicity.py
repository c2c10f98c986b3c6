"""Toxicity scores from a learned lexicon, misspellings and context windows.

Learning: on a bounded, documented sample of labelled rows, words and word stems
(prefixes) are counted per class, copies of a text once (by a one-value MinHash of
the text's words). An entry is kept when its share of toxic texts is above the base
rate beyond chance (Chernoff bound, corrected for all words tried). Entries stand in
a trie; a Levenshtein automaton of each text word is intersected with it, so a
misspelt term is found without listing variants. How far a match of a term at a
distance can be trusted is measured on all words of the sample, those shorter than the term apart.

Scoring: each hit's trust is scaled by its context: a window of words around it
that quotes or reports (quotation marks around it, reporting verbs, words about
words) lowers it, address (second person) or further hits raise it. The chance that
not all hits are false, 1 - prod(1 - trust), is weighed against the number of hits
and the text's length by a logistic fit on the sample's texts that have hits, held
near "no change" by a prior: one hit in a long text may be chance, several aren't.

Defined results: a null or empty text scores the ``FLOOR``; labels that are null
are not learned from; repeated rows score alike; without toxic labels the lexicon is
empty and every text scores the floor; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaylens.llm.common import kept_by, saved, small_batches

#: Labelled rows learned from at most (a uniform sample by hash beyond that).
SAMPLE_ROWS = 20_000
#: Rows of words after which a task hands on what it has, so that a batch of texts isn't held with all of its words.
WORD_ROWS = 20_000
ERROR = 1e-3
MIN_STEM, MAX_STEM = 4, 8
#: A stem is one only if so many words have it and none makes up half of them.
STEM_WORDS = 5
#: Toxic texts to each clean one that an entry needs at least.
PURE = 4
#: Lengths of terms from which one and two edits are forgiven.
ONE_EDIT, TWO_EDITS = 5, 9
#: Trust in a misspelt match before evidence, and the evidence that this stands for.
PRIOR_TRUST, PRIOR_WEIGHT = 0.8, 4.0
CONTEXT_WORDS = 6
FLOOR = 0.01
REJECT_AT = 0.7
_WORD = re.compile(r"[^\W\d_]+")
_QUOTES = {'"': '"', "“": "”", "„": "“", "«": "»", "‘": "’"}
# Words that report or discuss speech, and words of address.
REPORTING = frozenset("said says say quoted quote quotes wrote writes called calls word words term slur insult insults reported alleged sagte schrieb zitat wort nannte dit écrit mot citation appelé dijo escribió palabra cita llamó".split())
ADDRESS = frozenset("you your you're u ur du dich dein ihr tu toi ton vous votre tú te usted ustedes".split())


class Trie:
    """Lexicon terms; ``stem`` nodes accept any ending. ``least`` and ``most`` bound the lengths of the whole terms below."""

    __slots__ = ("next", "term", "stem", "least", "most")

    def __init__(self):
        self.next: dict[str, Trie] = {}
        self.term: str | None = None
        self.stem: str | None = None
        self.least, self.most = math.inf, 0

    def add(self, term: str, stem: bool) -> None:
        node = self
        for c in term:
            if not stem:
                node.least, node.most = min(node.least, len(term)), max(node.most, len(term))
            node = node.next.setdefault(c, Trie())
        if stem:
            node.stem = term
        else:
            node.term = term
            node.least, node.most = min(node.least, len(term)), max(node.most, len(term))


class Automaton:
    """Levenshtein automaton of one word, its state sets held as bits: bit i of ``rows[e]`` means that i letters of
    the word are read with e edits. Two neighbours swapped count as one edit."""

    def __init__(self, word: str, edits: int):
        self.places: dict[str, int] = {}
        for i, c in enumerate(word):
            self.places[c] = self.places.get(c, 0) | 1 << i
        self.edits, self.accept = edits, 1 << len(word)
        self.all = (self.accept << 1) - 1
        self.start = tuple((1 << e + 1) - 1 & self.all for e in range(edits + 1))

    def step(self, rows: tuple[int, ...], c: str, before: tuple[tuple[int, ...], str] | None) -> tuple[int, ...]:
        """State after reading c; ``before`` is the state and the letter one step ago."""
        at = self.places.get(c, 0)
        last = (rows[0] & at) << 1
        out = [last]
        for e in range(1, self.edits + 1):
            low = rows[e - 1]
            # read as in the word, or an extra letter, another letter, a letter of the word left out
            last = (rows[e] & at) << 1 | low | low << 1 | last << 1
            if before and at:
                last |= ((before[0][e - 1] & at) << 1 & self.places.get(before[1], 0)) << 1
            last &= self.all
            out.append(last)
        return tuple(out)


def edits_allowed(length: int) -> int:
    return 2 if length >= TWO_EDITS else 1 if length >= ONE_EDIT else 0


def matches(word: str, trie: Trie) -> tuple[str, int] | None:
    """(term, edits) of the nearest term; of a stem that starts the word, the longest, at 0 edits."""
    node, stem = trie, None
    for c in word:
        node = node.next.get(c)
        if node is None:
            break
        stem = node.stem or stem
    if node is not None and node.term:
        return node.term, 0
    if stem:
        return stem, 0
    n = len(word)
    k = edits_allowed(n + 2 if n + 2 >= TWO_EDITS else n + 1)  # of the longest term in reach
    if not k or n + k < trie.least or n - k > trie.most:
        return None
    automaton, best = Automaton(word, k), None
    accept, step = automaton.accept, automaton.step
    stack = [(trie, automaton.start, None, 0)]
    while stack:
        node, rows, before, depth = stack.pop()
        if node.term and rows[k] & accept:
            edits = next(e for e in range(k + 1) if rows[e] & accept)
            if edits <= edits_allowed(depth) and (best is None or (edits, node.term) < (best[1], best[0])):
                best = (node.term, edits)
        for c, child in node.next.items():
            e = min(k, edits_allowed(child.most))  # no term below the child forgives more
            if child.least <= n + e and child.most >= n - e:
                new = step(rows, c, before)
                if new[e]:
                    stack.append((child, new, (rows, c), depth + 1))
    return best


#: Weights of (1, log odds of the hits, ln(1 + hits), ln(1 + words)) that leave the odds as they are.
NO_CHANGE = (0.0, 1.0, 0.0, 0.0)


@dataclass
class Lexicon:
    """Terms with their trust; ``trust`` maps (term, edits, whether the word is shorter) to the chance that a hit is real:
    short words are more often words of their own."""

    terms: dict[str, bool]
    trust: dict[tuple[str, int, bool], float]
    weights: tuple[float, ...] = NO_CHANGE

    def trie(self) -> Trie:
        root = Trie()
        for term, stem in self.terms.items():
            root.add(term, stem)
        return root


class Scorer:
    def __init__(self, lexicon: Lexicon):
        self.trust, self.root, self.weights = lexicon.trust, lexicon.trie(), lexicon.weights
        self.memo: dict[str, float] = {}

    def word(self, w: str) -> float:
        found = matches(w, self.root)
        got = 0.0 if found is None else self.trust.get((*found, len(w) < len(found[0])), 0.0)
        if len(self.memo) >= 400_000:
            self.memo.clear()
        self.memo[w] = got
        return got

    def score(self, text: str) -> float:
        found = self.evidence(text)
        if found is None:
            return FLOOR
        return max(FLOOR, 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w * x for w, x in zip(self.weights, found)))))))

    def evidence(self, text: str) -> tuple[float, ...] | None:
        """(1, log odds of the hits, ln(1 + hits), ln(1 + words)); None without hits."""
        low = text.lower()
        get, word = self.memo.get, self.word
        hot = {}
        for w in set(_WORD.findall(low)):
            t = get(w)
            if t is None:
                t = word(w)
            if t:
                hot[w] = t
        if not hot:
            return None
        spans = [(m.start(), m.end(), m.group()) for m in _WORD.finditer(low)]
        quoted = quoted_spans(low)
        miss = 1.0 - FLOOR
        hits = [i for i, s in enumerate(spans) if s[2] in hot]
        for i in hits:
            window = [s[2] for s in spans[max(0, i - CONTEXT_WORDS) : i + CONTEXT_WORDS + 1]]
            miss *= 1.0 - hot[spans[i][2]] * context_weight(window, hot, inside(spans[i], quoted))
        miss = max(miss, 1e-6)
        return 1.0, math.log((1 - miss) / miss), math.log1p(len(hits)), math.log1p(len(spans))


def quoted_spans(text: str) -> list[tuple[int, int]]:
    """Stretches between quotation marks within a line, in order, however long."""
    out, at, line, unclosed = [], 0, 0, set()
    for m in re.finditer("[" + "".join(_QUOTES) + "]", text):
        if m.start() < at or m.group() in unclosed and m.start() < line:
            continue
        if m.start() >= line:
            unclosed.clear()
            line = text.find("\n", m.start())
            line = len(text) if line < 0 else line
        end = text.find(_QUOTES[m.group()], m.end(), line)
        if end < 0:
            unclosed.add(m.group())  # nor does a later one of this line close
        else:
            out.append((m.start(), end + 1))
            at = end + 1
    return out


def inside(span: tuple[int, int, str], quoted: list[tuple[int, int]]) -> bool:
    from bisect import bisect_right

    k = bisect_right(quoted, (span[0], math.inf)) - 1
    return k >= 0 and span[1] <= quoted[k][1]


def context_weight(window: list[str], hot: dict[str, float], is_quoted: bool) -> float:
    """Between 0.15 (quoted and reported) and 1 (abuse, or nothing that speaks for quotation)."""
    reported = any(w in REPORTING for w in window)
    addressed = any(w in ADDRESS for w in window)
    more = sum(w in hot for w in window) > 1
    weight = (0.15 if reported else 0.5) if is_quoted else 0.6 if reported else 1.0
    return min(1.0, weight * (1.5 if addressed and not is_quoted else 1.0) * (1.5 if more and not is_quoted else 1.0))


def surely_above(toxic: Column, clean: Column, base: float, tries: float) -> Column:
    """Whether the share k/n of toxic texts is above the base rate beyond chance: exp(-n KL(k/n || base)) * tries < ERROR."""
    n, p = toxic + clean, toxic / (toxic + clean)
    other = F.when(clean == 0, F.lit(0.0)).otherwise((1 - p) * F.log(F.when(clean > 0, (1 - p) / (1 - base))))
    kl = F.when(p > base, p * F.log(p / base) + other).otherwise(0.0)
    return n * kl > math.log(max(tries, 1) / ERROR)


def copy_sign(words: set[str]) -> int:
    """A bigint that copies and near copies mostly share: the least hash of their words."""
    return min(xxhash.xxh3_64_intdigest(w) for w in words) - (1 << 63)


def word_counts(sample: DataFrame) -> DataFrame:
    """(word, toxic, clean): texts of each class that have the word, copies of a text once in either class, so that one
    text's copies prove nothing for a word or against it; the word "" counts all texts with words. ``sample``: (_text, _toxic)."""
    small_batches(sample.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept_by("toxicity")
        for batch in batches:
            rows = []
            for text, toxic in zip(batch["_text"], batch["_toxic"]):
                words = set(_WORD.findall(text.lower()))
                if words:
                    sign = copy_sign(words)
                    rows += [(w, sign, toxic) for w in words | {""}]
                if len(rows) >= WORD_ROWS:
                    yield pd.DataFrame(rows, columns=["word", "sign", "toxic"], dtype=object)
                    rows = []
            yield pd.DataFrame(rows, columns=["word", "sign", "toxic"], dtype=object)

    seen = sample.mapInPandas(run, "word string, sign bigint, toxic int").distinct()
    return seen.groupBy("word").agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean"))


def learn(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Lexicon:
    """Learn from (id hash source ``_key``, _text, _toxic 0/1); rows beyond the sample's bound are left out by hash."""
    n = labelled.count()
    if n > sample_rows:
        cut = int(sample_rows / n * (1 << 31))
        labelled = labelled.where(F.pmod(F.xxhash64("_key"), F.lit(1 << 31)) < cut)
    labelled = saved(labelled, "toxic-sample")
    counts = saved(word_counts(labelled.select("_text", "_toxic")), "toxic-words")
    total = counts.where("word = ''").first()
    counts = counts.where("word != ''")
    toxic_n, all_n = (total["toxic"], total["toxic"] + total["clean"]) if total else (0, 0)
    if not toxic_n or toxic_n == all_n:
        return Lexicon({}, {})
    base = toxic_n / all_n
    stems = counts.select(F.explode(F.expr(f"transform(sequence({MIN_STEM}, {MAX_STEM}), k -> if(length(word) > k, substring(word, 1, k), null))")).alias("word"), "toxic", "clean").where("word IS NOT NULL")
    # a text may have several words of a stem, so their sums bound the stem's texts from above; its share stays
    stems = stems.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.max("toxic").alias("most"), F.count("*").alias("words"))
    stems = stems.where((F.col("words") >= STEM_WORDS) & (2 * F.col("most") < F.col("toxic"))).drop("most", "words")
    least = math.log(1 / ERROR) / -math.log(base)  # fewer texts than this prove nothing
    tries = counts.count() * 2.0
    named = counts.withColumn("stem", F.lit(False)).unionByName(stems.withColumn("stem", F.lit(True)))
    good = named.where((F.col("toxic") >= least) & (F.col("toxic") >= PURE * F.col("clean")))
    # entries are words of the bounded sample, of ``least`` toxic texts each; the sure ones only reach the driver
    rows = good.where(surely_above(F.col("toxic"), F.col("clean"), base, tries)).collect()
    terms: dict[str, bool] = {}
    for r in sorted(rows, key=lambda r: (len(r["word"]), not r["stem"])):
        # a stem takes in the longer entries it starts
        if not any(terms.get(r["word"][:k]) for k in range(MIN_STEM, len(r["word"]) + 1)):
            terms[r["word"]] = r["stem"]
    lexicon = Lexicon(terms, {})
    root_terms = dict(terms)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept_by("toxicity")
        root = Lexicon(root_terms, {}).trie()
        for batch in batches:
            found = [matches(w, root) for w in batch["word"]]
            rows = [(*f, len(w) < len(f[0]), t, c) for w, f, t, c in zip(batch["word"], found, batch["toxic"], batch["clean"]) if f]
            yield pd.DataFrame(rows, columns=["term", "edits", "shorter", "toxic", "clean"], dtype=object)

    if terms:
        seen = counts.mapInPandas(run, "term string, edits int, shorter boolean, toxic bigint, clean bigint").groupBy("term", "edits", "shorter").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).collect()  # at most five rows a term
        known = {(r["term"], r["edits"], r["shorter"]): (r["t"], r["c"]) for r in seen}
        for term in terms:
            for edits in range(edits_allowed(len(term)) + 1):
                for shorter in (False, True)[: 1 + (edits > 0)]:
                    t, c = known.get((term, edits, shorter), (0, 0))
                    lexicon.trust[term, edits, shorter] = (t + PRIOR_WEIGHT * PRIOR_TRUST) / (t + c + PRIOR_WEIGHT)
        lexicon.weights = calibrate(labelled, lexicon)
    return lexicon


def calibrate(labelled: DataFrame, lexicon: Lexicon, prior: float = 2.0) -> tuple[float, ...]:
    """Logistic weights of the evidence, by Newton steps, with a Gaussian prior around ``NO_CHANGE``.

    Fitted on the sample's texts that have hits, where copies share the weight of one text; at most ``SAMPLE_ROWS``
    rows of six numbers reach the driver.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept_by("toxicity")
        scorer = Scorer(lexicon)
        for batch in batches:
            rows = [(copy_sign(set(_WORD.findall(t.lower()))), *e, float(y)) for t, y in zip(batch["_text"], batch["_toxic"]) if (e := scorer.evidence(t))]
            yield pd.DataFrame(rows, columns=["sign", "one", "odds", "hits", "words", "y"])

    found = labelled.select("_text", "_toxic").mapInPandas(run, "sign bigint, one double, odds double, hits double, words double, y double").toPandas()
    start = np.array(NO_CHANGE)
    if found.empty:
        return NO_CHANGE
    x, y, w = found[["one", "odds", "hits", "words"]].to_numpy(), found["y"].to_numpy(), start.copy()
    share = 1 / found.groupby(["sign", "y"])["one"].transform("size").to_numpy()

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((share * (np.logaddexp(0, z) - y * z)).sum() + prior / 2 * ((w - start) ** 2).sum())

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (y - p)) - prior * (w - start)
        bend = (x * (share * p * (1 - p))[:, None]).T @ x + prior * np.eye(4)
        step, size = np.linalg.solve(bend, slope), 1.0
        while size > 1e-4 and loss(w + size * step) > loss(w):
            size /= 2  # a whole step may go too far
        if size <= 1e-4 or np.abs(size * step).max() < 1e-9:
            break
        w = w + size * step
    return tuple(float(v) for v in w)


def held_out(id_column: Column) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> DataFrame:
    """Labelled rows that are not held out, as ``learn`` takes them; a label must be 0 or 1."""
    marks = labels.select(F.col(id_column).alias("_id"), F.col(label_column).cast("int").alias("_toxic")).where("_toxic IN (0, 1)")
    own = marks.where(~held_out(F.col("_id")))
    texts = docs.select(F.col(id_column).alias("_key"), F.col(text_column).alias("_text")).where("_text IS NOT NULL")
    return texts.join(own, F.col("_key") == F.col("_id")).select("_key", "_text", "_toxic")


def score_documents(docs: DataFrame, lexicon: Lexicon, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row with a ``toxicity`` column (0 to 1); a column of that name is replaced."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        kept_by("toxicity")
        scorer = Scorer(lexicon)
        for batch in batches:
            yield pd.Series([scorer.score(t) if isinstance(t, str) else FLOOR for t in batch], dtype=float)

    return docs.withColumn("toxicity", score(F.col(text_column)))


def toxicity(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Learn from the labelled rows that are not held out and score every row."""
    lexicon = learn(training_rows(docs, labels, id_column, text_column))
    return score_documents(docs, lexicon, id_column, text_column)
