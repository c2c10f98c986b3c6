"""Quality rules with risk-controlled thresholds.

Each rule rejects a text whose signal lies beyond a cutoff. The cutoffs tried for
a rule are a fixed sequence from lenient to strict. Per stratum (a column, such as
the language) and rule, labelled good rows are the holdout: a cutoff is certified
when the exact binomial (Clopper-Pearson) upper bound of its false-rejection rate
is at most ``max_false_rejection / number of rules``. The error level is divided
by strata and rules (Bonferroni); within a rule the sequence stops at the first
cutoff that fails (fixed-sequence testing), which needs no further correction. So
with probability 1 - ``error`` all rules together reject at most
``max_false_rejection`` of the good rows of each stratum. Of the certified
cutoffs the one that separates the labelled bad rows best is used, the more
lenient on ties; a stratum with too few labels keeps all its rows.

Defined results: a null text has no words; a null stratum is a stratum of its
own; labels that are null, or name no row, are not used; a row whose id has
several labels counts once for each; repeated rows get equal results; without
labels no rule is certified and the base rules alone decide.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import lgamma

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaylens.llm.common import broadcast_if_small, saved, small_batches

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_FALSE_REJECTION = 0.05
ERROR = 0.05
#: How much a rejected good row weighs against a rejected bad one when a certified cutoff is chosen.
GOOD_WEIGHT = 5.0
#: Threshold rows up to which they are broadcast (some 100 bytes each).
BROADCAST_ROWS = 50_000
_LETTERS = re.compile(r"[^\W\d_]")
_BLANK_CHARS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Rule:
    """Rejects where ``signal`` is above (or, with ``below``, under) the cutoff; ``cutoffs`` run from lenient to strict."""

    name: str
    signal: str
    cutoffs: tuple[float, ...]
    below: bool = False

    def rejects(self, cutoff: Column) -> Column:
        signal = F.expr(self.signal)
        return F.coalesce((signal < cutoff) if self.below else (signal > cutoff), F.lit(False))


RULES = (
    Rule("symbols_per_word", "try_divide(n_symbols, n_words)", (2.0, 1.5, 1.0, 0.7, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1)),
    Rule("upper_share", "try_divide(n_upper, n_letters)", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1)),
    Rule("dup_line_share", "try_divide(n_dup_lines, n_lines)", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2)),
    Rule("word_length_high", "try_divide(word_chars, n_words)", (15.0, 12.0, 10.0, 9.0, 8.5, 8.0, 7.5, 7.0, 6.8, 6.6, 6.4, 6.2, 6.0)),
    Rule("word_length_low", "try_divide(word_chars, n_words)", (2.0, 2.5, 3.0, 3.5, 3.8, 4.0, 4.2, 4.3, 4.4, 4.5, 4.6), below=True),
)


def repeated_words(words: list, window: int = WINDOW) -> int:
    """Words that lie in a window found at least twice in the list (the first place included).

    Windows are ranked exactly by doubling: the rank of a window of 2k words is that
    of its pair of windows of k words. ``window`` is a power of two.
    """
    n = len(words)
    if n <= window:
        return 0
    seen: dict = {}
    put = seen.setdefault
    ranks = np.array([put(w, len(seen)) for w in words], dtype=np.int64)
    width = 1
    if len(seen) == n:
        return 0
    while width < window:
        m = len(ranks) - width
        pairs = ranks[:m] * (int(ranks.max()) + 1) + ranks[width:]
        width *= 2
        if width < window:
            ranks = np.unique(pairs, return_inverse=True)[1]
    order = np.sort(pairs)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(pairs, np.unique(twice)))
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def text_metrics(text: str) -> tuple[int, ...]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_letters, n_upper)."""
    words = text.encode("utf-8").split()  # bytes split at \x20 and \x09-\x0D only
    blank = sum(map(text.count, _BLANK_CHARS))
    symbols = sum(map(text.count, "#*$%&|<>"))
    lines = [x for x in text.split("\n") if x.strip(_BLANK_CHARS)]
    letters = _LETTERS.findall(text) if not text.isascii() else None
    if letters is None:
        data = np.frombuffer(text.encode("ascii"), dtype=np.uint8)
        upper = int(((data >= 65) & (data <= 90)).sum())
        n_letters = upper + int(((data >= 97) & (data <= 122)).sum())
    else:
        n_letters, upper = len(letters), sum(map(str.isupper, letters))
    return len(words), len(text) - blank, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines), n_letters, upper


METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper")


def measure(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", stratum_column: str | None = "lang") -> DataFrame:
    """(id, stratum, the metrics, base_failed) of every whole text."""
    small_batches(docs.sparkSession)
    stratum = F.col(stratum_column).cast("string") if stratum_column else F.lit("all")
    source = docs.select(F.col(id_column), stratum.alias("stratum"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    kind = source.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame([text_metrics(t) for t in batch["_text"]], columns=list(METRICS))
            out.insert(0, id_column, batch[id_column].to_numpy())
            out.insert(1, "stratum", batch["stratum"].to_numpy())
            yield out

    measured = source.mapInPandas(run, f"`{id_column}` {kind}, stratum string, " + ", ".join(f"{m} bigint" for m in METRICS))
    return measured.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial(n, p), by the exact sum."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    whole = lgamma(n + 1)
    log = np.array([whole - lgamma(j + 1) - lgamma(n - j + 1) for j in i]) + i * np.log(p) + (n - i) * np.log1p(-p)
    return float(min(1.0, np.exp(log).sum()))


def choose(counts: pd.DataFrame, rule: Rule, limit: float, level: float) -> pd.DataFrame:
    """Of one rule's counts by stratum (n_good, n_bad, g0, b0, g1, b1, ...) the cutoff chosen: the upper bound is at
    most ``limit`` where P(X <= rejected good) at that rate is at most ``level``."""
    rows = []
    for c in counts.itertuples(index=False):
        best, chosen = 0.0, None
        for i, cutoff in enumerate(rule.cutoffs):
            good, bad = getattr(c, f"g{i}"), getattr(c, f"b{i}")
            if not c.n_good or binomial_tail(int(good), int(c.n_good), limit) > level:
                break
            gain = bad / max(c.n_bad, 1) - GOOD_WEIGHT * good / c.n_good
            if gain > best + 1e-12:
                best, chosen = gain, (cutoff, int(good), int(bad))
        if chosen:
            rows.append((c.stratum, rule.name, chosen[0], chosen[1], int(c.n_good), chosen[2], int(c.n_bad)))
    return pd.DataFrame(rows, columns=["stratum", "rule", "cutoff", "good_rejected", "n_good", "bad_rejected", "n_bad"])


def calibrate(measured: DataFrame, labels: DataFrame, id_column: str = "doc_id", label_column: str = "quality", rules: tuple[Rule, ...] = RULES, max_false_rejection: float = MAX_FALSE_REJECTION, error: float = ERROR) -> DataFrame:
    """Certified cutoffs: (stratum, rule, cutoff, good_rejected, n_good, bad_rejected, n_bad).

    All labelled rows that pass the base rules are the holdout. Counts are summed
    per stratum in one aggregation; the bounds are evaluated where the sums are, on
    one row per stratum and rule.
    """
    spark = measured.sparkSession
    marks = labels.select(F.col(id_column).alias("_id"), F.col(label_column).cast("int").alias("_label")).where("_id IS NOT NULL AND _label IN (0, 1)")
    held = measured.where(~F.col("base_failed")).join(marks, F.col(id_column) == F.col("_id"))
    good, bad = F.col("_label") == 1, F.col("_label") == 0
    sums = [F.count_if(good).alias("n_good"), F.count_if(bad).alias("n_bad")]
    for r, rule in enumerate(rules):
        for i, cutoff in enumerate(rule.cutoffs):
            beyond = rule.rejects(F.lit(cutoff))
            sums += [F.count_if(good & beyond).alias(f"r{r}g{i}"), F.count_if(bad & beyond).alias(f"r{r}b{i}")]
    counts = saved(held.groupBy("stratum").agg(*sums), "quality-counts")
    strata = max(1, counts.count())
    out = None
    for r, rule in enumerate(rules):
        own = counts.select("stratum", "n_good", "n_bad", *[F.col(f"r{r}{s}{i}").alias(f"{s}{i}") for i in range(len(rule.cutoffs)) for s in "gb"])

        def run(batches: Iterator[pd.DataFrame], rule: Rule = rule) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield choose(batch, rule, max_false_rejection / len(rules), error / (strata * len(rules)))

        part = own.mapInPandas(run, "stratum string, rule string, cutoff double, good_rejected bigint, n_good bigint, bad_rejected bigint, n_bad bigint")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "stratum string, rule string, cutoff double")


def apply_rules(measured: DataFrame, thresholds: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add rejected_by (names of the rules that reject the row) and kept."""
    cuts = thresholds.groupBy(F.col("stratum").alias("_stratum")).agg(*[F.max(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(f"_c_{r.name}") for r in rules])
    cuts = saved(cuts, "quality-cutoffs")
    joined = measured.join(broadcast_if_small(cuts, cuts.count(), BROADCAST_ROWS), F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    fired = F.array(*[F.when((F.col("n_words") > 0) & r.rejects(F.col(f"_c_{r.name}")), F.lit(r.name)) for r in rules])
    out = joined.withColumn("rejected_by", F.array_compact(fired))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).drop("_stratum", *[f"_c_{r.name}" for r in rules])


def quality_rules(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", stratum_column: str | None = "lang", **options) -> DataFrame:
    """Measure, calibrate on the labelled rows and decide for every row."""
    measured = saved(measure(docs, id_column, text_column, stratum_column), "quality-metrics")
    return apply_rules(measured, calibrate(measured, labels, id_column, **options))
