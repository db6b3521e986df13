import random
import zlib
from collections import defaultdict
from itertools import pairwise

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from detour.llm import common, packing, tokens
from detour.session import fresh_path

from .helpers import DOCS, SMALL, clashing, doc, odd_docs, reread, table
from .test_tokens import library

BYTE = P.path("byte_bpe_50k.json")


def check(docs, pieces):
    """Every id of every row lies in one piece; sequences have no gaps and need no padding."""
    lib = library("byte_bpe_50k.json")
    of_row, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        of_row[p.row].append(p)
        sequences[p.sequence_id].append(p)
        assert p.seed == (p.offset == 0)
    rebuilt = []
    for parts in of_row.values():
        parts.sort(key=lambda p: p.start)
        assert [p.start for p in parts] == [0, *np.cumsum([p.length for p in parts])[:-1].tolist()]
        assert sum(p.length for p in parts) == parts[0].doc_tokens
        rebuilt.append((repr(parts[0].doc_id), tuple((p.start, p.length, p.ids_crc32) for p in parts)))
    want = defaultdict(list)
    for d in docs:
        want[repr(d.doc_id)].append(np.array(lib(d.text), "<u4"))
    assert len(rebuilt) == len(docs)
    for name, parts in rebuilt:
        hit = [i for i, ids in enumerate(want[name]) if all(zlib.crc32(ids[s:s + n].tobytes()) == c for s, n, c in parts) and sum(n for _, n, _ in parts) == len(ids)]
        want[name].pop(hit[0])
    for parts in sequences.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == [0, *np.cumsum([p.length for p in parts])[:-1].tolist()]
        n = sum(p.length for p in parts)
        assert n <= 2048 and n & (n - 1) == 0


def test_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    check(docs.collect(), packing.pack(docs, BYTE).collect())


def test_odd_documents(spark):
    docs = odd_docs(spark, [doc(50, "copy of this")] * 30)
    check(docs.collect(), packing.pack(clashing(docs, "ids", "row", "k1", "start"), BYTE).collect())


def test_empty(spark):
    assert packing.pack(table(spark, [], DOCS), BYTE).count() == 0


def test_statistics_cover_the_corpus(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ids = packing.tokenised(docs, BYTE, False)
    idf, mean = packing.corpus_statistics(ids)
    rows = [np.frombuffer(bytes(r.ids), np.uint16) for r in ids.collect()]
    df = np.bincount(np.concatenate([np.unique(r[r != 1]) for r in rows]), minlength=1 << 16)
    assert np.allclose(idf, np.log1p((len(rows) - df + 0.5) / (df + 0.5)), atol=1e-5)
    assert mean == np.mean([len(r) for r in rows])


def _bm25(rows, idf, mean):
    """row -> {term: weight}, document by document."""
    out = {}
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), np.uint16)
        term, n = np.unique(ids[ids != 1], return_counts=True)
        out[r.row] = dict(zip(term.tolist(), idf[term] * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(ids) / mean)), strict=True))
    return out


def test_scores_are_bm25_with_all_terms():
    """The index against BM25 computed document by document."""
    rng = np.random.default_rng(1)
    texts = [rng.integers(2, 60, rng.integers(5, 40)).astype(np.uint16) for _ in range(150)]
    flat, sizes = np.concatenate(texts), np.array([len(t) for t in texts])
    idf = rng.random(1 << 16).astype(np.float32) + 0.1
    shard = packing.Shard([(*packing._terms(flat, sizes, 1), sizes)], idf, float(sizes.mean()))

    def weight(d, t):
        n = int((texts[d] == t).sum())
        return idf[t] * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * sizes[d] / sizes.mean()))
    queries = [np.unique(texts[seed]) for seed in (0, 7, 149)]
    for q, got in shard.scores(queries, np.arange(2, 30)):
        assert np.allclose(got, [sum(weight(d, t) for t in queries[q].tolist()) for d in range(150)], rtol=1e-4)


def test_binary_columns_round_trip():
    flat, sizes = np.arange(10, dtype=np.uint16), np.array([3, 0, 7])
    back, n = tokens.ids_of(pa.chunked_array([tokens.binary(flat, sizes)]))
    assert back.tolist() == flat.tolist() and n.tolist() == sizes.tolist()


def _ordered(spark, docs, monkeypatch, **settings):
    for k, v in settings.items():
        monkeypatch.setattr(packing, k, v)
    path = fresh_path(spark, "test-packing")
    ids = common.written(packing.tokenised(docs, BYTE, False).withColumn("row", F.monotonically_increasing_id()), f"{path}/ids")
    return ids.collect(), packing.ordered(ids, path).collect(), packing.corpus_statistics(ids)


@pytest.mark.parametrize("settings", [{}, {"ROUND_SEEDS": 3, "BLOCK_DOCS": 20, "DENSE_TERMS": 9, "QUERY_ROWS": 2}])
def test_every_document_goes_to_its_best_seed(spark, monkeypatch, settings):
    """Against BM25 of every document with every term of every seed, in rounds and blocks; one row a document."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows, got, (idf, mean) = _ordered(spark, docs, monkeypatch, SEED_EVERY=20, **settings)
    weights, seeds = _bm25(rows, idf, mean), sorted(r.row for r in rows if r.doc_id % 20 == 0)
    assert len(seeds) == 10 and len(got) == len(rows) == len({g.row for g in got})
    for g in got:
        if g.row in seeds:
            assert seeds[g.seed] == g.row
            continue
        score = [sum(v for t, v in weights[g.row].items() if t in weights[s]) for s in seeds]
        fit = [x / len(weights[s]) ** 0.5 for x, s in zip(score, seeds, strict=True)]
        assert np.isclose(fit[g.seed], max(fit), rtol=1e-4) and np.isclose(g.score, score[g.seed], rtol=1e-4)
    got.sort(key=lambda g: g.place + 0.5 * (g.rest > 0))
    assert [g.place for g in got if g.rest] == np.cumsum([0, *[g.rest for g in got if g.rest][:-1]]).tolist()
    runs = [g for g in got if g.rest]
    assert all((a.seed, -a.score) <= (b.seed, -b.score) for a, b in pairwise(runs))


def test_rows_of_the_search_follow_the_documents(spark, monkeypatch):
    """Five times the documents make five times the rows of the search, not a row for each seed and block."""
    made = []

    def nearest(*args, real=packing.nearest):
        made.append(real(*args))
        return made[-1]
    monkeypatch.setattr(packing, "nearest", nearest)
    monkeypatch.setattr(packing, "BLOCK_DOCS", 10)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for times in (1, 5):
        several = reread(spark, docs.selectExpr("doc_id", "text", "lang", "source", "n_chars", f"explode(sequence(1, {times})) as k").selectExpr("doc_id + 1000 * k as doc_id", "text"))
        check(several.collect(), packing.pack(several, BYTE).collect())
        assert sum(x.count() for x in made) == several.count()
        made.clear()


def test_without_seeds(spark):
    """No id that is divisible, ids that lack, and equal texts."""
    docs = odd_docs(spark, [doc(50 + i, "") for i in range(40)] + [doc(101, "copy of this " * 200)] * 30).where("coalesce(doc_id, 1) <> 0")
    check(docs.collect(), packing.pack(docs, BYTE).collect())


def test_equal_seeds_and_documents_without_terms(spark):
    docs = odd_docs(spark, [doc(50 + i, "") for i in range(40)] + [doc(100, "copy of this " * 200)] * 30)
    check(docs.collect(), packing.pack(docs, BYTE).collect())


def test_pieces_cover_what_is_laid_out():
    rng = random.Random(2)
    for total in (0, 1, 2047, 2048, 2049, 5000, 9 * 2048 + 1365):
        at, got = 0, defaultdict(list)
        while at < total:
            n = min(rng.randrange(1, 2048), total - at)
            for length, sequence, offset in packing.pieces(at, n, total):
                assert offset == sum(got[sequence])
                got[sequence].append(length)
            at += n
        assert sorted(got) == list(range(len(got)))
        sizes = [sum(got[s]) for s in sorted(got)]
        assert sum(sizes) == total and sizes[:total // 2048] == [2048] * (total // 2048) and all(x & (x - 1) == 0 for x in sizes)
