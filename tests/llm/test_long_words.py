"""Words of any length are encoded as the library encodes them."""

import random
import time

import numpy as np
import pytest

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")

from kestrel.llm import bpe  # noqa: E402

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
rng = random.Random(1)
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def letters(n, some=LETTERS):
    return "".join(rng.choice(some) for _ in range(n))


WORDS = {
    "random": letters(20_000),
    "two letters": letters(3_000, "ab"),
    "equal": "a" * 20_000,
    "periodic": "abc" * 3_000,
    "words": ("the" * 37 + "ation") * 60,
    "two bytes": letters(3_000, "éèüöñ"),
    "joined": "a" * 3_001 + letters(3_000) + "é" * 501,
    **{f"{n} letters": letters(n, "eta") for n in (95, 96, 97, 191, 192, 193, 288, 289)},
}


@pytest.fixture(scope="module")
def both():
    ranks = bpe.read_ranks(RANKS)
    return bpe.tokenizer(RANKS, PATTERN), tiktoken.Encoding("x", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("name", list(WORDS))
def test_long_words_equal_the_library(both, name):
    ours, library = both
    word = WORDS[name]
    assert ours.find(word) == [word]
    ours.learn({word})
    assert np.frombuffer(ours.ids[word], "<u4").tolist() == library.encode_ordinary(word)
    assert ours.decoded([word, word]) == (word + word).encode()


def test_a_word_of_a_hundred_thousand_random_letters_ends_soon(both):
    ours, library = both
    word = letters(100_000)
    start = time.process_time()
    ours.learn({word})
    assert time.process_time() - start < 60
    assert np.frombuffer(ours.ids[word], "<u4").tolist() == library.encode_ordinary(word)


def test_pieces_without_a_shared_token_are_not_joined(both):
    """A run of equal letters may be cut differently in each piece: then the word is contracted as a whole."""
    ours, library = both
    for n in (200, 500, 1_001):
        word = "z" * n
        ours.learn({word})
        assert np.frombuffer(ours.ids[word], "<u4").tolist() == library.encode_ordinary(word)
