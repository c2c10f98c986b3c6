"""Language-model scores by context-tree weighting over bytes, with a word-unigram base.

A byte is eight binary decisions, each at a node (context of the last d bytes,
leading bits of the byte), d = 0..depth. Training counts zeros and ones per node
over the whole training corpus. Krichevsky-Trofimov estimates of all depths are
mixed by the context-tree weighting: ln Pw = ln(1/2 Pe + 1/2 prod Pw(children)),
Pw = Pe at full depth; the predictive weight of a node's own estimate is
Pe / (2 Pw). Texts are scored against these fixed counts.

Texts are dealt by hash into blocks of bounded bytes. A block names each distinct
n-gram and token it has once, with the times its training texts have it; these are
summed over the blocks by a shuffle. N-grams whose contexts end in the same two
bytes meet in one task: the subtree below them needs no other rows. Above it stand
at most 65,536 nodes, which the driver weights. The values found are joined to the
blocks by key, and a block is scored next to its own answers. A task holds one
block's texts, or the distinct n-grams of one two-byte context (at most
256^(depth-1), however many rows the corpus has).

Defined results: a null text is an empty one (its one token is the end, its bytes
are the end byte alone); a null id is in the training part; repeated rows count and
score as often as they stand; with an empty training part all estimates are those of
no counts (each bit 1/2, N = 0); extra columns are ignored.
"""

from __future__ import annotations

import ctypes
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaylens.llm.common import saved, small_batches

#: Bytes of context at most (1 to 7).
DEPTH = 5
#: Bytes of text in one scoring block, about.
BLOCK_BYTES = 32 * 1024 * 1024
#: Bytes of text, or of counted n-grams, worked on at a time.
CHUNK_BYTES = 1024 * 1024
#: Subtrees of contexts of so many bytes are whole in one task.
SPLIT = 2
#: Words whose hashes a worker remembers.
MEMO_WORDS = 100_000
#: Ends each text; no UTF-8 text holds it. Zero bytes stand before each text.
END_BYTE = b"\xff"
#: Key of the end token; no word is empty.
END_TOKEN = b""
_NGRAM, _TOKEN = 0, 1
_LN_PI, _LN_2 = math.log(math.pi), math.log(2)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def grams(texts: list[bytes], depth: int) -> np.ndarray:
    """One code per byte of the texts and their end byte: the ``depth`` bytes before it (zero bytes before a text),
    nearest first from the top, then the byte itself in the low 8 bits."""
    pad = b"\0" * depth
    data = np.frombuffer(pad + (END_BYTE + pad).join(texts) + END_BYTE, dtype=np.uint8) if texts else np.empty(0, dtype=np.uint8)
    n = len(data) - depth
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    kind = np.uint32 if depth < 4 else np.uint64
    x = np.zeros(n, dtype=kind)
    for i in [*range(depth - 1, -1, -1), depth]:
        x <<= kind(8)
        x |= data[i : i + n]
    # codes whose last byte is padding between two texts predict nothing
    keep = np.ones(n, dtype=bool)
    at = np.cumsum([len(t) + 1 + depth for t in texts])[:-1] - depth
    for i in range(depth):
        keep[at + i] = False
    return x[keep]


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, in order, and how often each stands."""
    if not len(keys):
        return keys.astype(np.uint64), np.empty(0, dtype=np.int64)
    s = np.sort(keys)
    at = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    return s[at].astype(np.uint64), np.diff(np.concatenate((at, [len(s)])))


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, in order, and the sums of their values."""
    if not len(keys):
        return (keys, *values)
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    at = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    return (s[at], *[np.add.reduceat(v[order], at) for v in values])


def token_hashes(text: bytes, hashes: WordHashes) -> list[int]:
    """Hashes of the tokens: words between blanks of the text in lower case (A-Z), then the end."""
    out = [hashes[w] for w in text.lower().split()]
    out.append(hashes[END_TOKEN])
    return out


def held_out(id_column: Column) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def chunks(texts: Iterable[bytes], size: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """Runs of whole texts of about ``size`` bytes."""
    part, held = [], 0
    for t in texts:
        part.append(t)
        held += len(t) + 1
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


def give_back() -> None:
    """Return freed memory to the system: workers live on between tasks, and the next block may run in another one."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


class BlockKeys:
    """Distinct n-grams and tokens of a block's texts, with the times its training texts have them."""

    def __init__(self, depth: int, hashes: WordHashes):
        self.depth, self.hashes = depth, hashes
        self.waiting: dict[bool, list[bytes]] = {False: [], True: []}
        self.bytes = {False: 0, True: 0}
        self.found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {_NGRAM: [], _TOKEN: []}
        self.merged = {_NGRAM: 0, _TOKEN: 0}

    def add(self, text: bytes, held: bool) -> None:
        self.waiting[held].append(text)
        self.bytes[held] += len(text) + 1
        if self.bytes[held] >= CHUNK_BYTES:
            self.count(held)

    def count(self, held: bool) -> None:
        texts, self.waiting[held], self.bytes[held] = self.waiting[held], [], 0
        tokens: list[int] = []
        for t in texts:
            tokens += token_hashes(t, self.hashes)
        for kind, keys in ((_NGRAM, grams(texts, self.depth)), (_TOKEN, np.array(tokens, dtype=np.uint64))):
            distinct, n = _counted(keys)
            self.found[kind].append((distinct, np.zeros_like(n) if held else n))
            if sum(len(p[0]) for p in self.found[kind]) > 2 * self.merged[kind] + 500_000:
                self.merge(kind)

    def merge(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        parts = self.found[kind]
        keys, n = _summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        self.found[kind], self.merged[kind] = [(keys, n)], len(keys)
        return keys, n

    def result(self, block: int) -> pa.RecordBatch:
        for held in (False, True):
            self.count(held)
        kinds, keys, ns = [], [], []
        for kind in self.found:
            k, n = self.merge(kind)
            kinds.append(np.full(len(k), kind, dtype=np.int32))
            keys.append(k)
            ns.append(n)
        key = np.concatenate(keys).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), block, dtype=np.int32)), pa.array(np.concatenate(kinds)), pa.array(key), pa.array(np.concatenate(ns))], ["block", "kind", "key", "n"])


def ln_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the Gamma function for x >= 1/2: Stirling's series after eight steps up (error below 1e-12)."""
    up, steps = x + 8, x.copy()
    for i in range(1, 8):
        steps *= x + i
    return (up - 0.5) * np.log(up) - up + 0.5 * math.log(2 * math.pi) + 1 / (12 * up) - 1 / (360 * up**3) + 1 / (1260 * up**5) - np.log(steps)


def ln_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return ln_gamma(a + 0.5) + ln_gamma(b + 0.5) - ln_gamma(a + b + 1.0) - _LN_PI


def weighted(own: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ln Pw of nodes and the predictive weight of their own estimates."""
    pw = np.logaddexp(own, below) - _LN_2
    return pw, np.exp(own - pw) / 2


def _node(codes: np.ndarray, i: int) -> np.ndarray:
    """Nodes of the i-th bit: the code (context, byte) without its low 8 - i bits."""
    return codes >> np.uint64(8 - i)


def _shorter(codes: np.ndarray) -> np.ndarray:
    """Codes (context, byte) with the context's farthest byte left out."""
    return ((codes >> np.uint64(16)) << np.uint64(8)) | (codes & np.uint64(255))


def _shorter_node(nodes: np.ndarray, i: int) -> np.ndarray:
    """The same for nodes of the i-th bit."""
    low = np.uint64((1 << i) - 1)
    return ((nodes >> np.uint64(8 + i)) << np.uint64(i)) | (nodes & low)


class Subtree:
    """Nodes of depths top..depth over whole contexts of ``top`` bytes: levels[d][i] = (nodes, a, b, ln Pw, weight)."""

    def __init__(self, codes: np.ndarray, n: np.ndarray, depth: int, top: int):
        self.depth, self.top, self.levels = depth, top, {}
        for d in range(depth, top - 1, -1):
            if d < depth:
                codes, n = _summed(_shorter(codes), n)
            self.levels[d] = [self._level(codes, n, d, i) for i in range(8)]

    def _level(self, codes: np.ndarray, n: np.ndarray, d: int, i: int) -> tuple[np.ndarray, ...]:
        ones = n * ((codes >> np.uint64(7 - i)) & np.uint64(1)).astype(np.int64)
        node = _node(codes, i)
        at = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
        nodes, b = node[at], np.add.reduceat(ones, at).astype(np.float64)
        a = np.add.reduceat(n, at) - b
        own = ln_kt(a, b)
        if d == self.depth:
            return nodes, a, b, own, np.ones(len(nodes))
        child, _, _, child_pw, _ = self.levels[d + 1][i]
        below = np.bincount(np.searchsorted(nodes, _shorter_node(child, i)), child_pw, len(nodes))
        return (nodes, a, b, *weighted(own, below))

    def above(self) -> tuple[np.ndarray, ...]:
        """(slot, a, b, below): sums per node of depth top - 1; a slot is (context, 1 and the leading bits)."""
        slots, sums = [], []
        for i, (nodes, a, b, pw, _) in enumerate(self.levels[self.top]):
            up = _shorter_node(nodes, i)
            slots.append(slot_of(up, i))
            sums.append(np.stack((a, b, pw)))
        a, b, below = np.concatenate(sums, axis=1)
        return _summed(np.concatenate(slots), a, b, below)

    def chance(self, codes: np.ndarray, i: int) -> np.ndarray:
        """Chance of a one at the i-th bit of the codes, by the depths from top on; 1/2 where nothing was seen."""
        chains = [_node(codes, i)]
        for _ in range(self.depth - self.top):
            chains.append(_shorter_node(chains[-1], i))
        q = np.full(len(codes), 0.5)
        for d, node in zip(range(self.depth, self.top - 1, -1), chains):
            nodes, a, b, _, w = self.levels[d][i]
            at = np.minimum(np.searchsorted(nodes, node), len(nodes) - 1)
            mixed = w[at] * (b[at] + 0.5) / (a[at] + b[at] + 1.0) + (1 - w[at]) * q
            q = np.where(nodes[at] == node, mixed, 0.5)
        return q


def slot_of(nodes: np.ndarray, i: int) -> np.ndarray:
    """Place of a node of the i-th bit in a full table of its depth."""
    low = np.uint64((1 << i) - 1)
    return (((nodes >> np.uint64(i)) << np.uint64(8)) | np.uint64(1 << i) | (nodes & low)).astype(np.int64)


def mix_above(slots: np.ndarray, a: np.ndarray, b: np.ndarray, below: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Full tables (own, rest) of depth top - 1: the chance of a one is own + rest * that of the depths from top on.

    Nodes never seen take those of the depth above, at the root 0 and 1."""
    levels = []
    for d in range(top - 1, -1, -1):
        own, seen = ln_kt(a, b), slots
        pw, w = weighted(own, below)
        levels.append((d, seen, w, (b + 0.5) / (a + b + 1.0)))
        if d:  # the context's farthest byte is left out
            up = ((slots >> 16) << 8) | (slots & 255)
            slots, a, b, below = _summed(up, a, b, pw)
    own_now, rest_now = np.zeros(256), np.ones(256)
    for d, seen, w, p in reversed(levels):
        if d:
            own_now, rest_now = (np.repeat(t.reshape(-1, 1, 256), 256, axis=1).reshape(-1) for t in (own_now, rest_now))
        own_now[seen] += rest_now[seen] * w * p
        rest_now[seen] *= 1 - w
    return own_now, rest_now


def _whole_contexts(batches: Iterator[pa.RecordBatch], shift: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes, n) of rows sorted by code, cut only where the code above ``shift`` bits changes."""
    codes, ns, held = [], [], 0
    for batch in batches:
        codes.append(batch.column("key").to_numpy().view(np.uint64))
        ns.append(batch.column("n").to_numpy())
        held += len(batch)
        if held * 16 >= CHUNK_BYTES:
            code, n = np.concatenate(codes), np.concatenate(ns)
            others = np.flatnonzero(code >> np.uint64(shift) != code[-1] >> np.uint64(shift))
            cut = int(others[-1]) + 1 if len(others) else 0
            if cut:
                yield code[:cut], n[:cut]
            codes, ns, held = [code[cut:]], [n[cut:]], 0  # a context of more rows than a chunk is gathered whole
    if codes and sum(map(len, codes)):
        yield np.concatenate(codes), np.concatenate(ns)


def gram_values(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(key, value): log10 probability of each n-gram's last byte after its context. ``counts``: distinct (key, n)."""
    top = min(SPLIT, depth)
    shift = 8 * (depth - top + 1)
    by_context = counts.select("key", "n", F.shiftrightunsigned("key", shift).alias("_ctx"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, n in _whole_contexts(batches, shift):
            slot, a, b, below = Subtree(codes, n, depth, top).above()
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(a), pa.array(b), pa.array(below)], ["slot", "a", "b", "below"])

    seen = by_context.where("n > 0").repartition("_ctx").sortWithinPartitions("key").select("key", "n")
    per_node = seen.mapInArrow(sums, "slot int, a double, b double, below double").groupBy("slot").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("below").alias("below"))
    # at most 256^(top-1) * 256 = 65,536 rows, whatever the corpus
    nodes = per_node.toPandas().sort_values("slot")
    own, rest = mix_above(nodes["slot"].to_numpy(dtype=np.int64), *(nodes[c].to_numpy(dtype=np.float64) for c in ("a", "b", "below")), top)

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, n in _whole_contexts(batches, shift):
            known = n > 0
            subtree = Subtree(codes[known], n[known], depth, top) if known.any() else None
            total = np.zeros(len(codes))
            for i in range(8):
                q = np.full(len(codes), 0.5) if subtree is None else subtree.chance(codes, i)
                node = _node(codes, i)
                for _ in range(depth - top + 1):
                    node = _shorter_node(node, i)
                slot = slot_of(node, i)
                p = own[slot] + rest[slot] * q
                one = (codes >> np.uint64(7 - i)) & np.uint64(1) == 1
                total += np.log10(np.where(one, p, 1 - p))
            yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(total)], ["key", "value"])

    return by_context.repartition("_ctx").sortWithinPartitions("key").select("key", "n").mapInArrow(values, "key bigint, value double")


class Places:
    """Index of keys among sorted known keys, some other index where they aren't there, by a table of hashed slots."""

    def __init__(self, known: np.ndarray):
        self.known, self.gold = known, np.uint64(0x9E3779B97F4A7C15)
        bits = max(10, int(len(known) * 2).bit_length())
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, dtype=np.int32)
        self.table[((known * self.gold) >> self.shift).astype(np.int64)] = np.arange(len(known), dtype=np.int32)

    def of(self, keys: np.ndarray) -> np.ndarray:
        at = self.table[((keys * self.gold) >> self.shift).astype(np.int64)]
        miss = np.flatnonzero(self.known[at] != keys)
        if len(miss):
            at[miss] = np.minimum(np.searchsorted(self.known, keys[miss]), len(self.known) - 1)
        return at


def _sorted(found: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of a kind and their values, taken batch by batch."""
    keys, values = [np.empty(0, dtype=np.uint64)], [np.empty(0)]
    for batch in found.to_batches():
        own = batch.column("kind").to_numpy() == kind
        keys.append(batch.column("key").to_numpy()[own].view(np.uint64))
        values.append(batch.column("value").to_numpy()[own])
    key, value = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(key)
    return key[order], value[order]


def lm_scores(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", depth: int = DEPTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10), n_bytes, bits_per_byte."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("_text"), held_out(F.col(id_column)).alias("held_out"))
    kind = rows.schema["_id"].dataType.simpleString()

    size = rows.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0)).alias("b")).first()["b"]
    blocks = max(1, math.ceil(size / block_bytes))
    placed = rows.withColumn("block", F.pmod(F.xxhash64("_id", "_text"), F.lit(blocks)).cast("int"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by block
        hashes, now, keys = WordHashes(), None, None
        for batch in batches:
            for b, text, held in zip(*(batch.column(c).to_pylist() for c in ("block", "_text", "held_out"))):
                if b != now:
                    if keys is not None:
                        yield keys.result(now)
                        give_back()
                    now, keys = b, BlockKeys(depth, hashes)
                keys.add(text, held)
        if keys is not None:
            yield keys.result(now)
        del keys, hashes
        give_back()

    dealt = placed.repartition(blocks, "block").sortWithinPartitions("block")
    asked = saved(dealt.select("block", "_text", "held_out").mapInArrow(ask, "block int, kind int, key bigint, n bigint"), "lm-asked")
    counts = saved(asked.groupBy("kind", "key").agg(F.sum("n").alias("n")), "lm-counts")
    tokens = counts.where((F.col("kind") == _TOKEN) & (F.col("n") > 0))
    total = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_train, vocabulary = total["n"], total["v"]

    values = gram_values(counts.where(F.col("kind") == _NGRAM).select("key", "n"), depth)
    known = values.select(F.lit(_NGRAM).alias("kind"), "key", "value").unionByName(tokens.select("kind", "key", F.col("n").cast("double").alias("value")))
    answers = asked.join(known, ["kind", "key"]).select("block", "kind", "key", "value")

    base = math.log10(n_train + 0.5 * (vocabulary + 1))
    rest = math.log10(0.5) - base  # of a token that the training part lacks
    fields = f"_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, n_bytes bigint, bits_per_byte double"

    def score(texts: pa.Table, found: pa.Table) -> pa.Table:
        gram_keys, per_gram = _sorted(found, _NGRAM)
        token_keys, per_known = _sorted(found, _TOKEN)
        logs = np.log10(per_known + 0.5) - base
        gram_places, token_places, hashes = Places(gram_keys), Places(token_keys), WordHashes()
        out: list[tuple[np.ndarray, ...]] = []
        for data in chunks(t.as_py() for t in texts.column("_text")):
            n_bytes = np.array([len(t) for t in data], dtype=np.int64)
            per_byte = per_gram[gram_places.of(grams(data, depth).astype(np.uint64))]
            scores = np.add.reduceat(per_byte, np.concatenate(([0], np.cumsum(n_bytes + 1)[:-1])))
            lengths, flat = [], []
            for t in data:
                h = token_hashes(t, hashes)
                lengths.append(len(h))
                flat.append(np.array(h, dtype=np.uint64))
            n_tokens, hashed = np.array(lengths, dtype=np.int64), np.concatenate(flat)
            starts = np.concatenate(([0], np.cumsum(n_tokens)[:-1]))
            per_token, is_known = np.full(len(hashed), rest), np.zeros(len(hashed), dtype=np.int64)
            if len(token_keys):
                at = token_places.of(hashed)
                hit = token_keys[at] == hashed
                per_token[hit] = logs[at[hit]]
                is_known[hit] = 1
            out.append((n_tokens, np.add.reduceat(is_known, starts), np.add.reduceat(per_token, starts), scores, n_bytes))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0)] * 5
        del gram_keys, per_gram, gram_places, token_keys, per_known, token_places, hashes, out
        give_back()
        per_text = [pa.array(c) for c in (*columns[:2], np.full(len(columns[0]), n_train), *columns[2:], -columns[3] * math.log2(10) / (columns[4] + 1))]
        named = ["_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"]
        return pa.table([texts.column("_id"), texts.column("held_out"), *per_text], names=named)

    together = placed.groupBy("block").cogroup(answers.groupBy("block"))
    scored = together.applyInArrow(score, fields)
    return scored.withColumnRenamed("_id", id_column)
