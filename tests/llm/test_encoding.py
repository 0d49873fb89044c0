"""Ids of the encoder beside those of the tokenizer, and what it asks the tokenizer for."""

import random

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import encoding
from tidemark.llm.encoding import PieceEncoder

NAMES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
BITS = [
    *" \n\t\r\x0b\x0c\x1c\x85\xa0 　",
    *["  ", "\n\n", " \n", "\n ", ".\n", "-\n", "'", "'s", "'ll", "n't", "’", "0", "00", "10", "a0", "0 a", "_"],
    *["the", "The", "word", "É", "éa", "é", "́", "İ", "ı", "ß", "ǆ", "ʰ", "×", "ª", "中文", "жук", "٣", "\x00"],
    *["<|endoftext|>", "<|startoftext|>", "<|", "<|endof", "text|>", ".", ",", "(", "--", "😀", "x" * 60],
]


class Asked:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, []

    def encode_batch_fast(self, texts, **options):
        self.texts += texts
        return self.tokenizer.encode_batch_fast(texts, **options)


def words(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choices("abdeiknorstéÈ", k=8)) for _ in range(n)]


@pytest.mark.parametrize("name", NAMES)
def test_ids_are_those_of_the_tokenizer(name, monkeypatch):
    draw = random.Random(7)
    encoder = PieceEncoder(public_tokenizers.path(name))
    full = PieceEncoder(public_tokenizers.path(name))
    for turn in range(6000):
        if turn == 4000:
            monkeypatch.setattr(encoding, "KEPT", 0)
            encoder = PieceEncoder(public_tokenizers.path(name))
        text = "".join(draw.choices([*BITS, " ", " ", " "], k=draw.randint(0, 9)))
        want = full.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode([text])[0], "<u2").tolist() == want, repr(text)


@pytest.mark.parametrize("name", NAMES)
def test_new_words_of_a_text_are_encoded_as_one_string(name):
    encoder = PieceEncoder(public_tokenizers.path(name))
    encoder.tokenizer = asked = Asked(encoder.tokenizer)
    text = "first " + " ".join(words(200, 1))
    got = np.frombuffer(encoder.encode([text])[0], "<u2").tolist()
    assert got == asked.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(asked.texts) <= 2


@pytest.mark.parametrize("name", NAMES)
def test_no_word_is_remembered_twice(name):
    encoder = PieceEncoder(public_tokenizers.path(name))
    new = sorted(set(words(200, 2)))
    encoder.encode(["first " + " ".join(new)])
    held = [key.strip() for known in vars(encoder).values() if isinstance(known, dict) for key in known]
    assert sorted(held) == sorted([*new, "first"])
