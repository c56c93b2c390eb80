"""Encoding of odd texts, and how much work the encoder and Re-Pair do."""

from __future__ import annotations

import collections
import random

import numpy as np
import pytest

from batchlens.llm import token_files

ODD = "abcxyzABC ßµªºÀÖØéÿÃ\n\t\x85\xa0'sdtlm.,;<>|_#$%*&12345½²œŒΣςİıﬁ̧́가각한fiǅ中’“"


@pytest.fixture(scope="module")
def tokenizer_path():
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def test_encoder_equals_the_tokenizer(monkeypatch, tokenizer_path):
    monkeypatch.setattr(token_files, "CACHE", 500)
    encoder, rng = token_files.Encoder(tokenizer_path), random.Random(5)
    texts = ["".join(rng.choice(ODD if k % 3 else ODD[:45]) for _ in range(rng.randint(0, 60))) for k in range(6000)]
    texts += ["<|startoftext|> a<|endoftext|>b", "the<|endoftext|>,", "it's they're word's, İ Σς ΑΣ", "", " ", "\n\n"]
    for k in range(0, len(texts), 257):
        some = texts[k:k + 257]
        for text, ids in zip(some, encoder.encode(some), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder.encode([]) == []


def test_plain_words_skip_the_steps_that_leave_them_alone(tokenizer_path):
    """Only chunks that are no words take the whole tokenizer, and none twice."""
    encoder, taken = token_files.Encoder(tokenizer_path), collections.Counter()
    whole = encoder.tokenizer

    class Counting:
        def encode(self, chunks, **how):
            taken.update(chunks)
            return whole.encode(chunks, **how)

    encoder.tokenizer = Counting()
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}é" for i in range(600)]
    text = " ".join([*words, *(f"{w.title()}, x7 {w}..." for w in words), "x7"])
    got = encoder.encode([text, text])
    assert got == encoder.encode([text]) * 2
    assert np.frombuffer(got[0], "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert taken == {",": 1, "...": 1, "x7": 1}


def test_pairs_are_not_counted_anew_each_round(monkeypatch):
    """After the first rounds only the places beside new symbols are counted, and no frequent pair is left."""
    counted, frequent = [], token_files._frequent
    monkeypatch.setattr(token_files, "_frequent", lambda pair, *a: counted.append(len(pair)) or frequent(pair, *a))
    rng = np.random.default_rng(3)
    phrases = [rng.integers(0, 3000, 40) for _ in range(30)]
    docs = [np.concatenate([rng.integers(0, 3000, 160), phrases[int(rng.integers(0, 30))]]) for _ in range(1000)]
    ids = np.concatenate(docs)
    last = np.zeros(len(ids), bool)
    last[np.cumsum([len(d) for d in docs]) - 1] = True
    symbols, ends, rules = token_files.repair(ids, last, 3000)
    assert (token_files.expand(symbols, rules, 3000) == ids).all() and ends.sum() == len(docs)
    assert len(counted) > 5 and sum(counted) < 3 * len(ids)
    pairs = collections.Counter(zip(symbols[:-1][~ends[:-1]].tolist(), symbols[1:][~ends[:-1]].tolist(), strict=True))
    assert max(pairs.values()) < token_files.LEAST_USES
    data = token_files.pack(list(range(len(docs))), [d.astype("<u4").tobytes() for d in docs], 3000)
    for short in (64, 2):  # rules longer than that are expanded by levels
        monkeypatch.setattr(token_files, "SHORT", short)
        assert (token_files.TokenFile(data).all() == ids).all()
