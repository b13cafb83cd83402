"""Piece-wise encoding against the tokenizer itself."""

import random

import numpy as np
import public_tokenizers
import pytest

from panelspark.llm.encoding import PieceEncoder

CHARS = ["a", "B", "é", "ß", "İ", "ŉ", "ɏ", "1", " ", " ", "\n", "\t", ".", "'s", "<", "<|endoftext|>", "-", "中", "́", "ﬁ", "_", "😀"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_ids_of_whole_texts(name):
    rng = random.Random(3)
    texts = ["", "word", " word  word\n\nword ", "x" * 5000, None]
    texts += ["".join(rng.choice(CHARS) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    texts.append(" ".join("".join(rng.choice("abcdeé") for _ in range(6)) for _ in range(3000)) + ".\nEnd")
    e = PieceEncoder(public_tokenizers.path(name), max_entries=500)  # small: what is remembered is forgotten in between
    got = list(e.encode_many(texts))
    assert len(got) == len(texts)
    for text, data in zip(texts, got):
        assert np.frombuffer(data, "<u4").tolist() == e.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_at_hand_are_not_learned_again(monkeypatch):
    e = PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"), max_entries=100)
    learned, words = [], PieceEncoder._words
    monkeypatch.setattr(PieceEncoder, "_words", lambda self, some, lead: learned.extend(some) or words(self, some, lead))
    rare = ["".join(random.Random(i).choice("abcdefgh") for _ in range(9)) for i in range(400)]
    for i in range(4):
        list(e.encode_many([" ".join(["the", "often", "used", *rare[100 * i:100 * i + 100], "word", "word."])]))
        assert len(e.pieces) <= 203 and len(e.runs) <= 110
    assert learned.count("often") == learned.count("used") == learned.count("word") == 1
