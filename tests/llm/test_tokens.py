import functools
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from detour.llm import textbytes as tb
from detour.llm.tokens import PieceTokenizer, SentencePieces

from .helpers import ODD_TEXTS

FILES = [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)]


@functools.cache
def library(name):
    t = Tokenizer.from_file(P.path(name))
    t.encode_special_tokens = True
    return lambda s: t.encode(s or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("name,drop", FILES)
@pytest.mark.parametrize("cache", [50, 2_000_000])
def test_same_ids_as_the_library(name, drop, cache):
    rng = random.Random(5)
    alphabet = list("aZéß'’.,!_-09 \n\t¨") + ["́", "×", "語", "😀", " ", " ", "\u0085", "\x1c", "Σ", "İ", "'s", "'LL"]
    texts = ODD_TEXTS + ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(400)]
    ids, sizes = PieceTokenizer(P.path(name), drop, cache).ids(pa.array(texts, pa.string()), 1)
    want = [library(name)(t) for t in texts]
    assert sizes.tolist() == [len(w) for w in want]
    for text, w, got in zip(texts, want, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
        assert got.tolist() == w, text


@pytest.mark.parametrize("name,drop", FILES)
def test_literals_of_added_tokens(name, drop):
    """Against the library left at its defaults."""
    lib, rng = Tokenizer.from_file(P.path(name)), random.Random(7)
    alphabet = ["<|endoftext|>", "<|startoftext|>", "<|endof", "text|>", "<|", "|>", " ", "  ", "\n", "one", "'s", "é", "語", ",", "12", "a"]
    texts = (ODD_TEXTS + ["one <|endoftext|> two", "<|endoftext|>", "cut <|endof", "text|> here", "<|endoftext|><|endoftext|>"]
             + ["".join(rng.choices(alphabet, k=rng.randrange(20))) for _ in range(400)])
    ids, sizes = PieceTokenizer(P.path(name), drop, literals=True).ids(pa.array(texts, pa.string()), 1)
    for text, got in zip(texts, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
        assert got.tolist() == lib.encode(text or "", add_special_tokens=False).ids + [1], text


def thue_morse(n, a, b):
    return "".join((a, b)[bin(i).count("1") & 1] for i in range(n))


ONE_HASH = [thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")]  # equal under any polynomial hash modulo 2**64 with an odd base


@pytest.mark.parametrize("name,drop", FILES)
def test_pieces_that_share_a_hash(name, drop):
    assert len(set(tb.span_hashes(np.frombuffer("".join(ONE_HASH).encode(), np.uint8), np.array([0, 1024]), np.array([1024, 2048])))) == 1
    texts = [*ONE_HASH, " ".join(ONE_HASH), "x " + ONE_HASH[1] + " y"] * 2
    ids, sizes = PieceTokenizer(P.path(name), drop).ids(pa.array(texts), 1)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [library(name)(t) for t in texts]


def test_same_ids_as_sentencepiece():
    lib, rng = SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model")), random.Random(3)
    alphabet = list("aZéß'’.,!_-09 \n\t(){}") + ["  ", "▁", " ▁", "語", "😀", " ", "ing", " the", "\r\n", "<0x0A>", "<s>"]
    texts = [*[t for t in ODD_TEXTS if t], *ONE_HASH, " ".join(ONE_HASH), *["".join(rng.choices(alphabet, k=rng.randrange(1, 40))) for _ in range(600)]]
    for cache in (50, 1_000_000):
        ids, sizes = SentencePieces(P.path("piece_bpe_32k.model"), cache).ids(pa.array([" " + t for t in texts]), None)
        for t, got in zip(texts, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
            assert got.tolist() == lib.encode(t), t
