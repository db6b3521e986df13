import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from detour.llm import merkle, queries

from .helpers import DOCS, SMALL, clashing, doc, odd_docs, table


def H(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r, text) -> str:
    out = ""
    for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text):
        v = None if v is None else str(v)
        out += "-" if v is None else f"{len(v.encode())}:{v}"
    return H(out)


def levels_of(nodes, fanout=3):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [H("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)]
        out.append(nodes)
    return out


def siblings(levels, at, fanout=3):
    out = []
    for nodes in levels[:-1]:
        lo = at // fanout * fanout
        out.append(("".join(nodes[lo:at]), "".join(nodes[at + 1:lo + fanout])))
        at //= fanout
    return out


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded_root, verified) by the plain definition."""
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda x: x[:3])
        trees[s] = levels_of([x[2] for x in groups[s]])
    top = levels_of([trees[s][-1][0] for s in names])
    out = []
    for g, s in enumerate(names):
        for i, (_, _, own, r) in enumerate(groups[s]):
            path = siblings(trees[s], i) + siblings(top, g)
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None
            now = leaf(r, r["text"].replace("\n", "")) if tampered else own
            for left, right in path:
                now = H(left + now + right)
            out.append((r["doc_id"], own, trees[s][-1][0], top[-1][0], H("".join(a + b for a, b in path)), now, now == top[-1][0]))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect()), key=repr)


def test_registered_query(spark):
    want = brute(r.asDict() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    assert got(queries.op13_butterfly_manifest(spark, SMALL)) == want
    assert {w[-1] for w in want} == {True, False}


@pytest.mark.parametrize("levels", [0, 1, 2])
def test_rounds_of_many_blocks(spark, levels):
    """Groups of every size around the powers of three, in small blocks: many rounds, with stand-ins."""
    rows = []
    for n in (1, 2, 3, 4, 8, 9, 10, 26, 28, 82):
        rows += [(1000 * n + i, f"line\n{i % 7}", "en", f"s{n}", i) for i in range(n)]
    docs = table(spark, rows, DOCS)
    assert got(queries.manifest_rows(docs, levels=levels)) == brute(r.asDict() for r in docs.collect())


def test_many_groups(spark):
    rows = [(i, "a\nb", "en", f"s{i}", 1) for i in range(95)] + [(200, "x", None, None, None)]
    docs = table(spark, rows, DOCS)
    assert got(queries.manifest_rows(docs, levels=1)) == brute(r.asDict() for r in docs.collect())


def test_odd_rows(spark):
    docs = odd_docs(spark, [(None, None, None, None, None), (77, "only\n", None, "", 5), (78, "ü\n", "de", "é", -1), doc(5, "same"), doc(5, "same")])
    want = brute(r.asDict() for r in docs.collect())
    assert got(queries.manifest_rows(clashing(docs, "leaf", "group_", "key_", "block", "path"))) == want


def test_one_row_and_none(spark):
    docs = table(spark, [doc(4, "a\nb")], DOCS)
    (row,) = queries.manifest_rows(docs).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == H("")
    assert got(queries.manifest_rows(docs)) == brute(r.asDict() for r in docs.collect())
    assert queries.manifest_rows(table(spark, [], DOCS)).count() == 0


def test_other_fanout(spark):
    leaves = [H(str(i)) for i in range(23)]
    for fanout in (2, 3, 5):
        root, paths = merkle.subtree(leaves, None, fanout)
        assert root == levels_of(leaves, fanout)[-1][0]
        assert paths == [siblings(levels_of(leaves, fanout), i, fanout) for i in range(23)]


def test_every_row_is_folded(spark, monkeypatch):
    """The root of an unchanged row is recomputed from its leaf and siblings as well, not copied."""
    monkeypatch.setattr(merkle, "folded", lambda start, path="path": F.concat(F.lit("folded "), start))
    docs = table(spark, [doc(4, "a"), doc(5, "b")], DOCS)
    rows = merkle.manifest(docs).collect()
    assert len(rows) == 2 and all(r.other_root == f"folded {r.leaf}" for r in rows)
