import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from detour.llm import completion, queries

from .helpers import DOCS, SMALL, clashing, doc, odd_docs, table

WORD = public_tokenizers.path("word_bpe_49k.json")


def optimum(items, size):
    """By trying every window for every piece."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= items[i]}.values():
            rooms[j] -= items[i]
            go(i + 1, rooms)
            rooms[j] += items[i]
        go(i + 1, [*rooms, size - items[i]])
    go(0, [])
    return best[0]


def holds(counts, plan, size):
    got = np.zeros(len(counts), np.int64)
    for filling, n in plan:
        assert n > 0 and 0 < sum(s * k for s, k in filling) <= size
        for s, k in filling:
            got[s] += k * n
    assert (got == counts).all()


def test_search_is_optimal_on_small_cases():
    rng, better = np.random.default_rng(5), 0
    for t in range(300):
        size = int(rng.integers(10, 90))
        items = rng.integers(1, size + 1, int(rng.integers(0, 12))) if t % 2 else rng.integers(size // 6 + 1, size // 2 + 1, int(rng.integers(4, 14)))
        counts = np.bincount(items, minlength=size + 1)
        plan, simple = completion.search(counts, size), completion.best_fit(counts, size)
        holds(counts, plan, size)
        holds(counts, simple, size)
        best = optimum(items.tolist(), size)
        assert completion.lower_bound(counts, size) <= best == completion.windows(plan) <= completion.windows(simple)
        better += best < completion.windows(simple)
    assert better


def test_search_with_many_copies_of_each_length():
    rng = np.random.default_rng(3)
    for lengths, most in ((40, 2000), (200, 20), (1500, 5)):
        counts = np.zeros(2049, np.int64)
        counts[rng.integers(300, 1100, lengths)] = rng.integers(1, most, lengths)
        plan = completion.search(counts, nodes=60)
        holds(counts, plan, 2048)
        assert completion.lower_bound(counts, 2048) <= completion.windows(plan) <= completion.windows(completion.best_fit(counts, 2048))


def test_fillings_are_undominated():
    rng = np.random.default_rng(8)
    for _ in range(60):
        counts = np.bincount(rng.integers(3, 30, 8), minlength=61)
        room = int(rng.integers(5, 60))
        found = completion.completions(counts, room)
        every = [[]]
        for s in np.repeat(np.arange(61), counts).tolist():
            every += [[*x, s] for x in every if sum(x) + s <= room]
        for x in every:  # each is dominated by one that was found
            assert any(completion._fits(sorted(x, reverse=True), completion._pieces(f)) for f in found)


def check(rows, docs, window=2048):
    lib, left, bins = Tokenizer.from_file(WORD), defaultdict(list), defaultdict(list)
    for d in docs:
        ids = [*lib.encode(d.text or "", add_special_tokens=False).ids, 0]
        left[d.doc_id].append(tuple((i, s, len(ids[s:s + window]), zlib.crc32(np.array(ids[s:s + window], "<u4").tobytes()))
                                    for i, s in enumerate(range(0, len(ids), window))))
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id, r.row].append((r.piece, r.start, r.length, r.ids_crc32))
        bins[r.sequence_id].append((r.offset, r.length))
    by_id = defaultdict(list)
    for (name, _), p in got.items():
        by_id[name].append(tuple(sorted(p)))
    assert {k: sorted(v) for k, v in by_id.items()} == {k: sorted(v) for k, v in left.items()}
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= window
    return len(bins), sum(r.length for r in rows)


def test_registered_query_meets_the_bound(spark):
    rows = queries.op12_bin_completion(spark, SMALL).collect()
    n, total = check(rows, spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    assert n == -(-total // 2048)


@pytest.mark.parametrize("window", [7, 64])
def test_odd_rows_and_small_windows(spark, window):
    docs = odd_docs(spark, [doc(5, "copy of one")] * 60)
    rows = completion.pack(clashing(docs, "row", "length", "pid", "piece"), WORD, window=window).collect()
    n, total = check(rows, docs.collect(), window)
    counts = np.bincount([r.length for r in rows], minlength=window + 1)
    assert n <= completion.windows(completion.best_fit(counts, window)) and n >= total / window


def test_empty(spark):
    assert completion.pack(table(spark, [], DOCS), WORD).count() == 0
