"""Byte-pair encoding and decoding with a public vocabulary.

A word's symbols form a doubly linked list; a priority queue holds (merge rank,
position) of neighbouring pairs. The lowest rank is merged first; an entry whose
pair has changed since it was queued is skipped. Decoding joins the vocabulary
strings of the ids. Vocabulary files are read by path inside each task and never
copied.

Defined results: a null text is an empty one, which has no ids and decodes to an
empty text; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaylens.llm.common import kept_by, small_batches

DEFAULT_VOCABULARY = "word_bpe_49k.json"
#: Entries of each of a worker's two generations of remembered runs and words.
MEMO_WORDS = 200_000
#: Longer runs and words are not remembered, so that the memo's size in bytes is bounded too.
MEMO_CHARS = 40
#: Characters that str.split() takes for blanks and the vocabulary's pattern doesn't.
_ODD_BLANKS = regex.compile("[\x1c-\x1f]")
_RUNS = regex.compile(r"[^\p{White_Space}]+")
#: ASCII marks: neither letters, digits nor blanks.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_POSITION_BITS = 40
_POSITION = (1 << _POSITION_BITS) - 1


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary: the printable
    Latin-1 bytes stand for themselves, the others follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in set(plain)]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(odd)}
    return [letters[b] for b in range(256)]


class WordBPE:
    """Encoder of one vocabulary file in the JSON form with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.strings = {i: s for s, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + self.end] for c in letters]
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, (a, b) in enumerate(model["merges"]):
            self.ranks[vocab[a] << 32 | vocab[b]] = rank
            self.merged.append(vocab[a + b])
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merge(self, word: str) -> list[int]:
        """Ids of one word (a match of the vocabulary's pattern)."""
        data = word.encode("utf-8")
        inner = self.inner
        ids = [inner[b] for b in data]
        ids[-1] = self.last[data[-1]]
        n = len(ids)
        if n == 1:
            return ids
        rank_of, merged = self.ranks.get, self.merged
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        queue = [r << _POSITION_BITS | i for i, r in enumerate([rank_of(a << 32 | b) for a, b in zip(ids, ids[1:])]) if r is not None]
        heapq.heapify(queue)
        pop, push = heapq.heappop, heapq.heappush
        while queue:
            top = pop(queue)
            i, r = top & _POSITION, top >> _POSITION_BITS
            a, j = ids[i], after[i]
            if a < 0 or j == n or rank_of(a << 32 | ids[j]) != r:
                continue  # stale: one of the two has been merged away or changed
            new = ids[i] = merged[r]
            ids[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank_of(new << 32 | ids[k])
                if r is not None:
                    push(queue, r << _POSITION_BITS | i)
            h = before[i]
            if h >= 0:
                r = rank_of(ids[h] << 32 | new)
                if r is not None:
                    push(queue, r << _POSITION_BITS | h)
        return [x for x in ids if x >= 0]

    def _keep(self, key: str, found: bytes) -> bytes:
        """Remember a result; a full generation becomes the old one."""
        if len(key) <= MEMO_CHARS:
            if len(self.young) >= MEMO_WORDS:
                self.old, self.young = self.young, {}
            self.young[key] = found
        return found

    def _packed(self, word: str) -> bytes:
        ids = self.merge(word)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        """Packed ids of one word; a word of plain lower-case letters is remembered as the run that it also is."""
        if not (word.isascii() and word.isalpha()):
            return self._packed(word)
        found = self.young.get(word)
        if found is None:
            found = self._keep(word, self.old.get(word) or self._packed(word))
        return found

    def _chunk(self, chunk: str) -> bytes:
        """Packed ids of a run without blanks; memoised in two generations of bounded size."""
        found = self.old.get(chunk)
        if found is None:
            # NFC, then each character in lower case by itself (a final sigma is no special case)
            text = chunk.lower() if chunk.isascii() else unicodedata_nfc(chunk).replace("Σ", "σ").lower()
            word = text.rstrip(_MARKS)
            if word.isalpha():  # letters and then, perhaps, marks: what the pattern finds in most runs
                found = self._word(word)
                if len(word) < len(text):
                    found += self._word(text[len(word) :])
            else:
                found = b"".join([self._word(w) for w in self.pieces.findall(text)])
        return self._keep(chunk, found)

    def packed(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if self.specials is not None and "<|" in text and self.specials.search(text):
            pieces = self.specials.split(text)
            return b"".join([struct.pack("<I", self.special[p]) if p in self.special else self.packed(p) for p in pieces if p])
        runs = _RUNS.findall(text) if _ODD_BLANKS.search(text) else text.split()
        get, chunk = self.young.get, self._chunk
        out = []
        for run in runs:
            got = get(run)
            if got is None:
                got = chunk(run)
                get = self.young.get
            out.append(got)
        return b"".join(out)

    def encode(self, text: str | None) -> list[int]:
        return unpacked(self.packed(text or ""))

    def decode(self, ids: list[int]) -> str:
        """The vocabulary strings of the ids; without a decoder in the file a blank stands between them."""
        return " ".join([self.strings[i] for i in ids])


def unpacked(data: bytes) -> list[int]:
    return list(struct.unpack(f"<{len(data) // 4}I", data))


def unicodedata_nfc(text: str) -> str:
    if text.isascii():
        return text
    import unicodedata

    return unicodedata.normalize("NFC", text)


def load(vocabulary: str) -> WordBPE:
    """The encoder of a vocabulary path, or of a name that ``public_tokenizers`` knows; once per worker, until another
    operator's task begins there."""
    loaded = kept_by("bpe")
    if vocabulary not in loaded:
        path = vocabulary
        if "/" not in vocabulary:
            import public_tokenizers

            path = public_tokenizers.path(vocabulary)
        loaded[vocabulary] = WordBPE(path)
    return loaded[vocabulary]


def encode_documents(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = True) -> DataFrame:
    """(id, ids array<int>, n_tokens, ids_sha256, decoded, decoded_sha256) of every whole text.

    ``with_ids=False`` leaves out the ids and the decoded text (their digests stay).
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_column), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    id_type = source.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(vocabulary)
        for batch in batches:
            rows = []
            for text in batch["_text"]:
                data = bpe.packed(text)
                ids = unpacked(data)
                decoded = bpe.decode(ids)
                row = (len(data) // 4, hashlib.sha256(data).hexdigest(), hashlib.sha256(decoded.encode("utf-8")).hexdigest())
                if with_ids:
                    row += (ids, decoded)
                rows.append(row)
            names = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * with_ids
            out = pd.DataFrame(rows, columns=names, dtype=object)
            out.insert(0, id_column, batch[id_column].to_numpy())
            yield out

    schema = f"`{id_column}` {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<int>, decoded string"
    return source.mapInPandas(run, schema)
