import hashlib
import re

import duckdb
import pytest

from detour.llm import winnowing
from detour.llm.oracle import ORACLE_SQL

from .helpers import DOCS, SMALL, clashing, doc, odd_docs, reread, table

ITEMS = "item_id long, text string"


def words(text):
    fold = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold)


def brute(docs, items):
    windows = {}
    for i in items:
        w = words(i.text)
        n = min(len(w), 10)
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add("" if i.item_id is None else str(i.item_id))
    out = []
    for d in docs:
        w, hit, found = words(d.text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[k:k + n]))):
                    hit |= set(range(k, k + n))
                    found |= own
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d.doc_id, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=repr)


def check(docs, items):
    got = winnowing.contamination(docs, items)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs.collect(), items.collect())


def items_of(spark):
    long = " ".join(f"w{i}" for i in range(25))
    return table(spark, [(1, long), (2, "Just FOUR words, here"), (3, None), (4, "!!!"), (5, "the the the the the the the the the the the"), (6, long),
                         (None, "nameless"), (7, "é É ß x y z q r s t u"), (10, "same same same")], ITEMS, 1)


def docs_of(spark):
    w = [f"w{i}" for i in range(25)]
    texts = [" ".join(["a", *w[3:13], "b"]), " ".join(["a", *w[3:12], "b"]), " ".join(w + w), "x just four. WORDS here y", "the " * 40, "nameless NAMELESS",
             "é É ß x y z q r s t", "é é ß x y z q r s t", "same " * 7, " ".join(w[:12] + ["gap"] + w[2:14])]
    return odd_docs(spark, [doc(200 + i, t) for i, t in enumerate(texts)] + [doc(200, texts[0])])


@pytest.mark.parametrize("bits", [64, 1 << 28])
def test_odd_documents_and_short_items(spark, monkeypatch, bits):
    """With a Bloom filter that lets nearly all pass, and with one of full size."""
    monkeypatch.setattr(winnowing, "MAX_BITS", bits)
    check(docs_of(spark), items_of(spark))


def test_given_tables(spark):
    docs, items = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "benchmark"))
    check(docs, items)
    con = duckdb.connect()
    for n in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{SMALL}/{n}.parquet'")
    rel = con.sql(ORACLE_SQL["op4_winnowing"])
    assert sorted(rel.fetchall(), key=repr) == brute(docs.collect(), items.collect())


def test_every_shared_span_is_found(spark):
    """The guarantee: a span of ten words at any place, whatever stands around it."""
    from random import Random
    rng = Random(3)
    base = [f"b{i}" for i in range(60)]
    docs = []
    for i in range(50):
        noise = [f"n{rng.randrange(9)}" for _ in range(40)]
        at, put = rng.randrange(51), rng.randrange(41)
        docs.append(doc(i, " ".join(noise[:put] + base[at:at + 10] + noise[put:])))
    got = winnowing.contamination(table(spark, docs, DOCS), table(spark, [(1, " ".join(base))], ITEMS, 1)).collect()
    assert {r.n_hit for r in got} == {10} and all(r.contaminated for r in got)


def test_clean_documents_keep_their_columns(spark):
    docs = reread(spark, clashing(docs_of(spark), "row_", "words_", "digest_", "n_words", "c1_"))
    clean = winnowing.decontaminate(docs, items_of(spark))
    hit = {(r[0], r[1]) for r in brute(docs.collect(), items_of(spark).collect()) if r[5]}
    assert clean.schema == docs.schema
    want = [d for d in docs.collect() if (d.doc_id, len(words(d.text))) not in hit]
    assert sorted(map(repr, clean.collect())) == sorted(map(repr, want))


def test_empty_tables(spark):
    none_docs, none_items = table(spark, [], DOCS), table(spark, [], ITEMS)
    check(none_docs, items_of(spark))
    check(odd_docs(spark), none_items)
    assert winnowing.decontaminate(none_docs, none_items).count() == 0
