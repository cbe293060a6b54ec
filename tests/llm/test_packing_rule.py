"""Packing against the rule replayed piece by piece, and ids of texts of every kind against the library."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from gridspan.llm import packing
from gridspan.llm.queries import tokenizer_file

BYTE, WORD = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("word_bpe_49k.json")
LETTERS = "aZ'sTéÀß09.,!- \t\n\u0301\xad\u2019\x1f\x85\xa0İſΣ日"


def texts(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choice(LETTERS) for _ in range(draw.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_ids_of_random_texts_equal_the_library(path):
    library = Tokenizer.from_file(path)
    some = texts(3000, 3) + ["x<|endoftext|>y", "x <|EndOfText|>", "It's the DON'T, 12.5%...", "À la carte, ÿ!"]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in some]
    assert packing.Encoder(path).ids(some) == want


def test_only_a_vocabulary_with_the_known_pattern_is_split_here():
    assert packing.Encoder(WORD).known_pattern and not packing.Encoder(BYTE).known_pattern


def test_small_table_of_parts_gives_the_same():
    small = packing.Encoder(WORD)
    small.parts.limit = 3
    some = texts(200, 4)
    assert [small.ids([t])[0] for t in some] == packing.Encoder(WORD).ids(some)


@pytest.mark.parametrize("capacity", [
    packing.Capacity(),
    packing.Capacity(tokens=100, documents=3, attention=6000, weights=(1, 1, 1)),
    packing.Capacity(tokens=100, documents=4, attention=5000, weights=(1, 0.5, 2), rule="dot")])
def test_every_choice_is_the_best_fit_of_all_open_sequences(capacity):
    lengths = np.random.default_rng(5).integers(1, min(90, capacity.tokens), 400)
    lengths[::7] = lengths[0]
    bins, offsets = packing.best_fit(lengths, capacity)
    full = (capacity.tokens, capacity.documents, capacity.attention)
    left = {}
    for i in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        n = int(lengths[i])
        need = (n, 1, n * n)
        score = {}
        for b, rest in left.items():
            if all(r >= d for r, d in zip(rest, need)):
                after = [(r - d) / f * w for r, d, f, w in zip(rest, need, full, capacity.weights)]
                if capacity.rule == "norm":
                    score[b] = sum(a * a for a in after)
                else:
                    score[b] = sum(r * d / f / f * w for r, d, f, w in zip(rest, need, full, capacity.weights))
        b = int(bins[i])
        if score:
            assert b in score and score[b] <= min(score.values()) + 1e-12
        else:
            assert b not in left
            left[b] = full
        assert offsets[i] == capacity.tokens - left[b][0]
        left[b] = tuple(r - d for r, d in zip(left[b], need))
