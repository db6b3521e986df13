import heapq
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from detour.llm import common, huffman

from .helpers import DOCS, SMALL, clashing, odd_docs, table
from .test_tokens import library

WORD = P.path("word_bpe_49k.json")


def huffman_bits(counts):
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        total += a
        heapq.heappush(heap, a)
    return total


def test_code_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(3)
    for n in (2, 3, 17, 300):
        counts = rng.integers(0, 50, n) ** 2 + 1
        lengths = huffman.code_lengths(counts, 40)
        assert (counts * lengths).sum() == huffman_bits(counts) and (2.0 ** -lengths.astype(float)).sum() == 1
    fib = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144])
    short = huffman.code_lengths(fib, 5)
    assert short.max() == 5 and (2.0 ** -short.astype(float)).sum() <= 1 and (fib * short).sum() >= huffman_bits(fib)
    assert huffman.code_lengths(np.array([0, 7, 0]), 16).tolist() == [0, 1, 0]
    assert huffman.code_lengths(np.zeros(4, int), 16).tolist() == [0] * 4
    assert len(set(huffman.code_lengths(np.ones(1 << 16, int), 16).tolist())) == 1
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9, int), 3)


def test_canonical_codes_count_up():
    lengths = np.array([2, 0, 3, 3, 1], np.uint8)
    assert [format(int(c), f"0{n}b") for c, n in zip(huffman.canonical(lengths), lengths, strict=True) if n] == ["10", "110", "111", "0"]


def test_bits_round_trip_from_any_checkpoint():
    rng = np.random.default_rng(4)
    for n_blocks, size in ((1, 1), (3, 700), (5, 2000)):
        ids = (rng.zipf(1.3, size) % 65536).astype(np.uint16)
        lengths = huffman.code_lengths(np.bincount(ids, minlength=1 << 16))
        block = np.sort(rng.integers(0, n_blocks, size))
        block = np.unique(block, return_inverse=True)[1]
        k = int(block[-1]) + 1
        words, word_at, local = huffman.pack_bits(ids, block, lengths, huffman.canonical(lengths), k)
        symbol, length = huffman.decode_table(lengths)
        for b in range(k):
            own, at = ids[block == b], local[block == b]
            for first in range(0, len(own), 97):
                got = huffman.unpack_bits(words[word_at[b]:word_at[b + 1]], at[first:first + 1].copy(), np.array([len(own) - first]), symbol, length)
                assert (got == own[first:]).all()


def check(spark, docs):
    rows = docs.collect()
    lib = library("word_bpe_49k.json")
    path = huffman.write_tokens(docs, common.scratch(spark, "huffman-test"), WORD, drop_space=True)
    got = huffman.read_tokens(spark, path).collect()
    digests = huffman.read_tokens(spark, path, digests=True).collect()
    assert sorted((repr(r.doc_id), r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in got) == sorted((repr(r.doc_id), *r[1:]) for r in digests)
    at = 0
    order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in order] == sorted((r.doc_id for r in rows), key=lambda i: (i is not None, i or 0))
    for r in order:
        assert r.start == at
        at += r.n_tokens
    assert sorted((repr(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in got) == sorted((repr(r.doc_id), lib(r.text)) for r in rows)


def test_documents_come_back(spark):
    check(spark, spark.read.parquet(f"{SMALL}/documents.parquet"))


def test_odd_documents_come_back(spark):
    check(spark, clashing(odd_docs(spark), "ids", "tie", "row", "part"))


def test_empty(spark):
    path = huffman.write_tokens(table(spark, [], DOCS), common.scratch(spark, "huffman-test"), WORD, drop_space=True)
    assert huffman.read_tokens(spark, path).count() == 0


def test_large_blocks_and_documents_over_a_block(spark):
    rng = random.Random(2)
    text = " ".join(rng.choice("alpha beta gamma delta".split()) for _ in range(40_000))
    check(spark, table(spark, [(i, text[:n], "en", "s", n) for i, n in enumerate((10, len(text), 0, 5000))], DOCS, 1))
