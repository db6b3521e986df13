import random
import uuid

import numpy as np
import pyarrow as pa
import pytest

from detour.llm import components, probminhash as pm
from detour.session import fresh_path

from .helpers import DOCS, SMALL, clashing, doc, odd_docs, reread, table
from .test_tokens import ONE_HASH


def find(parent, a):
    while parent[a] != a:
        parent[a] = parent[parent[a]]
        a = parent[a]
    return a


def j_p(a, b):
    """The definition, term by term."""
    a, b = (dict(zip(s.tolist(), w.tolist(), strict=True)) for s, w in (a, b))
    return sum(1 / sum(max(a.get(k, 0) / a[d], b.get(k, 0) / b[d]) for k in a.keys() | b.keys()) for d in a.keys() & b.keys())


def brute(docs, similarity=0.8):
    """Components over all pairs; texts without words only with equal ones."""
    sets = pm._sets(pa.array([d.text or "" for d in docs], pa.string()))
    parent = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            same = (docs[i].text or "") == (docs[j].text or "")
            if same or len(a[0]) and len(b[0]) and pm.probability_jaccard(a, b) >= similarity - 1e-12:
                parent[max(find(parent, i), find(parent, j))] = min(find(parent, i), find(parent, j))
    groups = {}
    for i in range(len(docs)):
        groups.setdefault(find(parent, i), []).append(docs[i].doc_id)
    return [sorted(g, key=repr) for g in groups.values()]


def classes_of(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.class_row, []).append(r)
    for g in groups.values():
        named = [r.doc_id for r in g if r.doc_id is not None]
        assert sum(r.kept for r in g) == 1 and {r.class_size for r in g} == {len(g)} and {r.class_id for r in g} == {min(named, default=None)}
    return [sorted((r.doc_id for r in g), key=repr) for g in groups.values()]


def variants(n, seed, length=120, edits=5):
    rng = random.Random(seed)
    base = [f"v{seed}x{rng.randrange(900)}" for _ in range(length)]
    out = []
    for _ in range(n):
        w = base[:]
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(length)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def key(groups):
    return sorted(map(repr, groups))


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert key(classes_of(pm.classes(docs).collect())) == key(brute(docs.collect()))


@pytest.mark.parametrize("rounds,left", [(6, 4), (0, 4), (2, 0)])
def test_large_groups_of_near_copies(spark, monkeypatch, rounds, left):
    """Pairs that only chains link; with pivots alone, without any, and with few."""
    monkeypatch.setattr(pm, "PIVOT_ROUNDS", rounds)
    monkeypatch.setattr(pm, "PAIRS_PER_MEMBER", left)
    texts = variants(70, 1) + variants(40, 2) + ["w " + t for t in variants(3, 3)]
    docs = odd_docs(spark, [doc(1000 + i, t) for i, t in enumerate(texts)] + [doc(2000 + i, texts[0]) for i in range(50)])
    assert key(classes_of(pm.classes(docs).collect())) == key(brute(docs.collect()))


def test_one_of_each_keeps_columns(spark):
    docs = reread(spark, clashing(odd_docs(spark, [doc(100 + i, t) for i, t in enumerate(variants(9, 5, edits=2))]), "row", "keys", "content", "at_", "node"))
    out = pm.one_of_each(docs)
    assert out.schema == docs.schema and out.count() == len(brute(docs.collect()))


def test_empty(spark):
    docs = table(spark, [], DOCS)
    assert pm.classes(docs).count() == 0 and pm.one_of_each(docs).columns == docs.columns


def test_probability_jaccard_is_its_definition():
    rng = random.Random(9)
    for _ in range(200):
        a, b = ({rng.randrange(12): rng.randrange(1, 5) for _ in range(rng.randrange(1, 9))} for _ in range(2))
        a, b = ((np.array(sorted(x), np.uint64), np.array([x[k] for k in sorted(x)])) for x in (a, b))
        assert pm.probability_jaccard(a, b) == pytest.approx(j_p(a, b))


def test_sketch_estimates_without_bias():
    got = []
    for seed in range(150):
        rng = random.Random(seed)
        words = [f"w{rng.randrange(400)}" for _ in range(200)]
        other = words[:rng.randrange(120, 200)] + words[:rng.randrange(40)]
        sets = pm._sets(pa.array([" ".join(words), " ".join(other)]))
        doc_ = np.repeat([0, 1], [len(s[0]) for s in sets])
        reg = pm.sketch(doc_, np.concatenate([s[0] for s in sets]), np.concatenate([s[1] for s in sets]), 2)
        got.append((reg[0] == reg[1]).mean() - j_p(*sets))
    assert abs(np.mean(got)) < 0.015 and np.std(got) < 0.08


def test_sketch_of_few_shingles_fills_all_registers():
    reg = pm.sketch(np.array([0, 2]), np.array([5, 9], np.uint64), np.array([1, 300]), 3)
    assert (reg[0] == 5).all() and (reg[1] == 0).all() and (reg[2] == 9).all()


def test_components_against_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(1, 90)]
    parent = {n: n for e in edges for n in e}
    for a, b in edges:
        parent[max(find(parent, a), find(parent, b))] = min(find(parent, a), find(parent, b))
    got = components.components(spark.createDataFrame(edges, "u long, v long"), fresh_path(spark, uuid.uuid4().hex)).collect()
    want = {n: find(parent, n) for e in edges if e[0] != e[1] for n in e}
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


def test_words_that_share_a_plain_hash_stay_apart(spark):
    """Regular patterns of two letters, equal under a polynomial hash modulo 2**64."""
    few = " ".join(f"z{i}" for i in range(5))
    docs = table(spark, [doc(i, f"{few} {w} {few}") for i, w in enumerate(ONE_HASH)], DOCS)
    assert sorted(r.class_size for r in pm.classes(docs).collect()) == [1, 1]


def test_copies_that_only_their_original_is_like(spark):
    """Edited copies of one text: nearly all pairs of them are too far apart, most are near the original."""
    rng, base = random.Random(6), [f"b{i}" for i in range(150)]
    rows = []
    for i in range(200):
        w = base[:]
        for _ in range(0 if i == 7 else rng.randrange(1, 9)):
            w[rng.randrange(150)] = f"e{rng.randrange(10**7)}"
        rows.append(doc(i, " ".join(w)))
    docs = table(spark, rows, DOCS)
    assert key(classes_of(pm.classes(docs).collect())) == key(brute(docs.collect()))


def test_a_text_is_taken_apart_once_for_its_pairs(monkeypatch):
    """All pairs of 40 texts, in one task: the sets of each text are computed once, however many pairs it has."""
    texts = variants(40, 8)
    taken = []
    monkeypatch.setattr(pm, "_sets", lambda column, real=pm._sets: taken.append(len(column)) or real(column))

    pairs = [{"u": i, "v": j, "a": texts[i], "b": texts[j]} for i in range(40) for j in range(i)]
    got = [r for b in pm._checked(0.8)(iter(pa.Table.from_pylist(pairs).to_batches(max_chunksize=100))) for r in b.to_pylist()]
    sets = pm._sets(pa.array(texts))
    assert [(r["u"], r["v"], r["linked"]) for r in got] == [(p["u"], p["v"], pm.probability_jaccard(sets[p["u"]], sets[p["v"]]) >= 0.8 - 1e-12) for p in pairs]
    assert sum(taken[:-1]) == 40


def test_few_edges_need_no_shuffle(spark):
    """A component's rounds over few edges are one stage each: none of them is dealt among tasks."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)], "u long, v long").coalesce(1)
    plan = components._small_star(components._large_star(edges, 60), 60)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastExchange" in plan
