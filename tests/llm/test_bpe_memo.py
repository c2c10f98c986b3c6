"""The bounded memo of runs and words (bpe)."""

import random

import public_tokenizers

from relaylens.llm import bpe

rnd = random.Random(7)


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 20)
    encoder = bpe.WordBPE(public_tokenizers.path(bpe.DEFAULT_VOCABULARY))
    texts = [" ".join("".join(rnd.choice("abE,.9éΣ") for _ in range(rnd.randint(1, 6))) for _ in range(100)) for _ in range(20)] + ["z" * 5000]
    for text in texts:
        encoder.packed(text)
        assert len(encoder.young) <= 20 and len(encoder.old) <= 20
        assert max(map(len, [*encoder.young, *encoder.old])) <= bpe.MEMO_CHARS
    fresh = bpe.load(bpe.DEFAULT_VOCABULARY)
    for text in texts:
        assert encoder.packed(text) == fresh.packed(text)
