"""Periodic run detection by online dyadic square catching.

Words are appended one after the other, in portions of any size. On each level k
every completed aligned block of 2**k words is a catcher. For each appended word
the suffix of 2**k words that ends with it is compared, by hash, with the two live
catchers whose distance p lies in [2**(k+1) - 1, 2**(k+2) - 2]: equality means that
the block returns p words later, a square of period p in the making (any stretch of
p words holds an aligned block of its level, so no period is missed). Catches of
one distance on consecutive blocks belong to one run. When the next block fails,
the chain is extended word by word to both sides, by less than a block, and is then
a maximal stretch of period p. A stretch of at least ``4 * p`` words has at least
four whole blocks at distance p within it, so shorter chains are dropped.
Stretches with equal ends are one run, with the smallest of their periods (a longer
one is then a multiple of it); a chain that lies within a run whose period divides
its own is dropped at once, so that long repeats of one word cost no more.

A stretch is compared word by word before it is reported, so hashes decide only
where to look. Per level only the hashes of the blocks and of one block's worth of
suffixes are kept: memory follows the number of words appended.

``periodic_runs`` applies it to whole texts, one row at a time.

Defined results: a null or blank text has no words and no run; a null id leaves the
text unchanged (see ``planted``); repeated rows give repeated results; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import collections
import hashlib
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from relaylens.llm.common import small_batches

#: A run has at least this many words, and this many times its period.
LEAST_WORDS, LEAST_EXPONENT = 6, 4
#: Whole blocks at one distance that every run of that exponent holds.
CHAIN = 4
#: Words appended at a time, which bounds the arrays of a comparison.
PORTION = 65_536
#: Characters of short texts that share a catcher.
TOGETHER = 400_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Characters that str.split() takes for blanks and the words' pattern doesn't.
_ODD = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_EVEN = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    return _WORD.findall(text) if _ODD.search(text) else text.split()


def _joined(left: np.ndarray, right: np.ndarray, level: int) -> np.ndarray:
    """Hash of two neighbouring stretches of 2**level words, modulo 2**64; the mixing keeps levels apart."""
    x = left * (_EVEN + np.uint64(2 * level)) + right
    return x ^ (x >> np.uint64(29))


class SquareCatcher:
    """Runs of a growing sequence of numbers (equal numbers are equal words); none is longer than ``longest``, if given."""

    def __init__(self, least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT, longest: int | None = None):
        if least_exponent < LEAST_EXPONENT:
            raise ValueError(f"chains of {CHAIN} blocks are sure only for exponents of {LEAST_EXPONENT} or more")
        self.least_words, self.least_exponent, self.longest = least_words, least_exponent, longest
        self.words = np.zeros(0, np.int64)
        self.n = 0
        self.suffixes: list[np.ndarray] = []  # per level the hashes of the newest 2**level suffixes
        self.blocks: list[np.ndarray] = []  # per level the hashes of the completed blocks
        self.counts: list[int] = []
        self.chains: list[np.ndarray] = []  # per level (period, first block, last block) of chains that may grow
        self.found: dict[tuple[int, int], int] = {}  # (start, end) -> smallest period

    def append(self, words: np.ndarray) -> None:
        """Take the next words of the sequence."""
        new, start = len(words), self.n
        if not new:
            return
        if start + new > len(self.words):  # room doubles, as a list's does
            room = np.zeros(start + new if not start else max(2 * len(self.words), start + new), np.int64)
            room[:start] = self.words[:start]
            self.words = room
        self.words[start : start + new] = words
        self.n = start + new
        most = self.n if self.longest is None else min(self.n, self.longest)
        level, size = 0, 1
        # hashes of the suffixes that end with the new words; the first of them starts at ``first``
        first, hashes = start, self.words[start : self.n].astype(np.uint64) * _EVEN
        while True:
            opens = level == len(self.suffixes)
            if opens:
                for kept in (self.suffixes, self.blocks):
                    kept.append(np.zeros(0, np.uint64))
                self.counts.append(0)
                self.chains.append(np.zeros((0, 3), np.int64))
                if first:  # a level's suffixes start with the sequence
                    first, hashes = 0, self._all(level)
            if len(hashes):
                self._complete(level, first, hashes)
                self._catch(level, first, hashes)
            kept = hashes if not first else np.concatenate((self.suffixes[level], hashes))
            self.suffixes[level] = kept[max(0, len(kept) - size) :].copy()
            # a longer block is of use once a run with its shortest period would fit
            if self.least_exponent * (4 * size - 1) > most or len(kept) <= size:
                return
            # a suffix of twice the size: of the kept ones and the new, each with the one that follows it
            hashes = _joined(kept[:-size], kept[size:], level)
            first = max(0, first - size)
            level, size = level + 1, 2 * size

    def _all(self, level: int) -> np.ndarray:
        """Hashes of all suffixes of a level, from the words."""
        hashes = self.words[: self.n].astype(np.uint64) * _EVEN
        for k in range(level):
            hashes = _joined(hashes[: -(1 << k)], hashes[1 << k :], k)
        return hashes

    def _complete(self, level: int, first: int, hashes: np.ndarray) -> None:
        done = hashes[-first % (1 << level) :: 1 << level]
        have, blocks = self.counts[level], self.blocks[level]
        if have + len(done) > len(blocks):
            room = np.zeros(max(2 * len(blocks), have + len(done)), np.uint64)
            room[:have] = blocks[:have]
            self.blocks[level] = blocks = room
        blocks[have : have + len(done)] = done
        self.counts[level] = have + len(done)

    def _catch(self, level: int, first: int, hashes: np.ndarray) -> None:
        """Compare the new suffixes with the live catchers, grow the chains, close those that can't grow."""
        size = 1 << level
        least = 2 * size - 1
        blocks, caught = self.blocks[level], []
        for back in (0, 1):
            skip = max(0, least + back * size - first)  # suffixes with no block at such a distance yet
            if skip >= len(hashes):
                break
            # suffixes of the same remainder share their live catcher
            low = (first + skip - least) >> level
            lead = size - ((first + skip - least) & (size - 1))
            own = hashes[skip:]
            count = 1 + (max(0, len(own) - lead) + size - 1 >> level)
            live = blocks[low - back : low - back + count]
            if size > 1:
                live = np.repeat(live, size)[size - lead : size - lead + len(own)]
            hit = (live == own).nonzero()[0]
            if len(hit):
                at = hit + (first + skip)
                block = ((at - least) >> level) - back
                caught.append(np.stack((at - (block << level), block, block), 1))
        chains = self.chains[level]
        if not caught and not len(chains):
            return
        rows = np.concatenate((chains, *caught))
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        breaks = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 2] + 1)
        starts = np.concatenate(([0], breaks.nonzero()[0] + 1))
        ends = np.concatenate((starts[1:], [len(rows)])) - 1
        chains = np.stack((rows[starts, 0], rows[starts, 1], rows[ends, 2]), 1)
        # the next block's return has been compared once the words reach its end
        grows = ((chains[:, 2] + 2) << level) + chains[:, 0] > self.n
        self.chains[level] = chains[grows]
        self._close(size, chains[~grows])

    def _close(self, size: int, chains: np.ndarray) -> None:
        """Extend chains to runs, short periods first; a chain within a run whose period divides its own is that run."""
        chains = chains[chains[:, 2] - chains[:, 1] + 1 >= CHAIN]
        if not len(chains):
            return

        def apart(start: int, end: int, period: int) -> np.ndarray:
            return (chains[:, 0] % period != 0) | (chains[:, 1] * size < start) | ((chains[:, 2] + 1) * size + chains[:, 0] > end)

        for (start, end), period in self.found.items():
            if end - start >= 6 * size - 1:  # no shorter run holds a chain and its return
                chains = chains[apart(start, end, period)]
        while len(chains):
            period, low, high = (int(x) for x in chains[0])
            chains = chains[1:]
            run = self._stretch(period, low * size, (high + 1) * size)
            if run is not None and run[1] - run[0] >= self.least_exponent * period:
                self.found[run] = min(period, self.found.get(run, period))
                if len(chains):
                    chains = chains[apart(*run, period)]

    def _stretch(self, period: int, low: int, high: int) -> tuple[int, int] | None:
        """The longest stretch of that period around words low to high and their return; None if they differ after all."""
        words, n = self.words, self.n
        if not np.array_equal(words[low:high], words[low + period : high + period]):
            return None  # equal hashes of different words
        step = 64
        while low > 0:
            a = max(0, low - step)
            odd = (words[a:low] != words[a + period : low + period]).nonzero()[0]
            if len(odd):
                low = a + int(odd[-1]) + 1
                break
            low, step = a, 2 * step
        end, step = high + period, 64
        while end < n:
            b = min(n, end + step)
            odd = (words[end:b] != words[end - period : b - period]).nonzero()[0]
            if len(odd):
                end += int(odd[0])
                break
            end, step = b, 2 * step
        return low, end

    def finish(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of every run, by start and then period."""
        for level, chains in enumerate(self.chains):
            self._close(1 << level, chains)
            self.chains[level] = chains[:0]
        long = [(s, e - s, p) for (s, e), p in self.found.items() if e - s >= max(self.least_words, self.least_exponent * p)]
        return sorted(long, key=lambda r: (r[0], r[2]))


def find_runs(words: np.ndarray, portion: int = PORTION, longest: int | None = None) -> list[tuple[int, int, int]]:
    """Runs of a sequence of numbers."""
    catcher = SquareCatcher(longest=longest)
    for at in range(0, len(words), portion):
        catcher.append(words[at : at + portion])
    return catcher.finish()


def planted(n: int, doc_id: object) -> np.ndarray | None:
    """Word numbers of a text of n words after the contract's periodic tail; None if the text stays as it is."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


_NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words", "n_dropped"]
_SCHEMA = "doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, n_words long, n_dropped long"


def _described(words: list[str], at: np.ndarray | None, runs: list[tuple[int, int, int]]) -> tuple:
    n = len(words)
    kept = words if at is None else [words[i] for i in at]
    if runs:
        drops = np.zeros(n, bool)
        for s, length, p in runs:
            drops[s + p : s + length] = True
        kept = [kept[i] for i in (~drops).nonzero()[0]]
    listed = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    digest = hashlib.sha256(" ".join(kept).encode()).hexdigest()
    return (len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(), digest, n, n - len(kept))


def describe(texts: list[str | None], ids: list, plant: bool = False) -> list[tuple]:
    """What ``periodic_runs`` returns of each text, after the id.

    Texts of similar length are appended to one catcher, one after the other: each has its own numbers for its
    words, so nothing in one is equal to anything in another.
    """
    out: list[tuple] = [()] * len(texts)
    order = sorted(range(len(texts)), key=lambda i: len(texts[i] or ""))
    at = 0
    while at < len(order):
        own, chars, count = [], 0, itertools.count()
        while at < len(order) and (not own or chars + len(texts[order[at]] or "") <= TOGETHER):
            i = order[at]
            words = words_of(texts[i])
            numbers = collections.defaultdict(count.__next__)
            row = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
            move = planted(len(words), ids[i]) if plant else None
            own.append((i, words, move, row if move is None else row[move]))
            chars += len(texts[i] or "")
            at += 1
        ends = np.cumsum([len(row) for _, _, _, row in own])
        runs = find_runs(np.concatenate([row for _, _, _, row in own]), longest=max(len(row) for _, _, _, row in own))
        by_text: list[list] = [[] for _ in own]
        for s, length, p in runs:
            k = int(np.searchsorted(ends, s, side="right"))
            by_text[k].append((s - int(ends[k]) + len(own[k][3]), length, p))
        for (i, words, move, _), found in zip(own, by_text):
            out[i] = _described(words, move, found)
    return out


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", plant: bool = False) -> DataFrame:
    """Per row the number of its runs, the longest one, and digests of the runs and of the text without repetitions.

    ``plant`` gives one text in ten a periodic tail first, by a hash of its id, so that long periods occur.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(docs[id_column].alias("doc_id"), docs[text_column].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = describe(batch.column(1).to_pylist(), batch.column(0).to_pylist(), plant)
            columns = list(zip(*found)) if found else [[]] * 9
            arrays = [pa.array(c, pa.string() if name.endswith("sha256") else pa.int64()) for c, name in zip(columns, _NAMES[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], _NAMES)

    return rows.mapInArrow(run, _SCHEMA.format(kind=kind.simpleString()))
