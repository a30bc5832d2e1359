"""The packing's token ids against the tokenizer's own, on odd characters."""

import random

import numpy as np
import pytest

from tarnlake.llm import packing
from tarnlake.llm.queries import TOKENIZER

ODD = ["'s", "'LL", "don't", " ", "  ", "\n", "<|endoftext|>", "<|startoftext|>", "<|", "İ", "Σ", "ς", "é", " "]
ODD += ["\x85", "\xa0", "\xad", "漢", "Ⱥ", "Ⱦ", "½", "²", "ª", "\x1c", "ﬁ", "ͅ", "\x00", "😀"]


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(TOKENIZER)


@pytest.mark.parametrize("stretch", [packing.STRETCH, 7])
def test_odd_characters(encoder, monkeypatch, stretch):
    monkeypatch.setattr(packing, "STRETCH", stretch)
    rng = random.Random(stretch)
    every, letters = [chr(c) for c in range(0x2D0)] + ODD, [chr(c) for c in range(0x61, 0x7B)]
    for _ in range(4000):
        kinds = [every] * rng.randint(0, 3) + [ODD] * rng.randint(0, 2) + [letters]
        text = "".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randint(0, 60)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_a_full_memory_changes_nothing(encoder, monkeypatch):
    text = "Some words, some more: don't count 12 words' ends. " * 3
    want = encoder.encode(text)
    monkeypatch.setattr(packing, "CACHED_PIECES", 2)
    assert packing.Encoder(TOKENIZER).encode(text) == want
