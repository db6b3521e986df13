import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from tokenizers import Tokenizer

from detour.llm import alignment, queries

from .helpers import DOCS, SMALL, clashing, doc, odd_docs, table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_of():
    """The published byte-level alphabet."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def brute(docs):
    """By the plain definition, from the libraries' ids of whole texts."""
    a, b, byte = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), byte_of()
    a.encode_special_tokens = True
    found = []
    for d in docs:
        groups = []
        if d.text:
            whole = (" " + d.text).encode()
            ids_a, ids_b = a.encode(" " + d.text, add_special_tokens=False).ids, b.encode(d.text)
            bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
            bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
            if b"".join(bytes_a) == whole == b"".join(bytes_b):
                i = j = at_a = at_b = 0
                now = ([], [])
                while i < len(ids_a) or j < len(ids_b):
                    if j == len(ids_b) or i < len(ids_a) and at_a <= at_b:
                        now[0].append(ids_a[i])
                        at_a += len(bytes_a[i])
                        i += 1
                    else:
                        now[1].append(ids_b[j])
                        at_b += len(bytes_b[j])
                        j += 1
                    if at_a == at_b and now[0] and now[1]:
                        groups.append(now)
                        now = ([], [])
        found.append((d.doc_id, groups))
    links = [Counter((x, y) for g in groups for x in g[0] for y in g[1]) for _, groups in found]
    count = Counter(p for c in links for p in c)
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for (name, groups), c in zip(found, links, strict=True):
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((name, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(c.values()),
                    sum(n for p, n in c.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in c.items()),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()), key=repr)


def test_registered_query(spark):
    assert got(queries.op11_token_alignment(spark, SMALL)) == brute(spark.read.parquet(f"{SMALL}/documents.parquet").collect())


def test_odd_rows(spark):
    docs = odd_docs(spark, [doc(50, "holds ▁ itself"), doc(51, "▁"), doc(52, "<s>x</s> <unk> <0x0A>"), doc(53, "\0 \r\n\t"), doc(54, "  two  spaces\n\n \n"),
                            doc(55, "\U0001F600 emoji \U0001F600\U0001F600"), doc(56, "ab" * 400 + "ba" * 700), doc(57, " " * 300), *[doc(60, "one copy of many")] * 40])
    docs = clashing(docs, "row", "pairs", "pair", "n")
    rows = got(alignment.align(docs, A, B))
    assert rows == brute(docs.collect())
    assert any(r[-1] == "" and r[0] in (50, 51) for r in rows)


def test_empty(spark):
    assert alignment.align(table(spark, [], DOCS), A, B).count() == 0


def test_crowded_groups_and_shuffled_counts(spark, monkeypatch):
    """Groups of many tokens are paired by id; counts too many for a broadcast are joined by a shuffle."""
    monkeypatch.setattr(alignment, "COUNT_BYTES", 1 << 30)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    assert got(alignment.align(docs, A, B)) == brute(docs.collect())
    rng = np.random.default_rng(2)
    a, b = [rng.integers(0, 9, n) for n in (150, 90)]
    lists = [pa.LargeListArray.from_arrays(pa.array([0, 0, len(x)]), pa.array(x.astype(np.int32))) for x in (a, b)]
    sizes = np.ones(9, np.int64)
    ends_b = np.concatenate([np.ones(89), [61]]).astype(np.int64)  # the last of B is long: one group at its end
    held = alignment.Aligned(lists[0], pa.LargeListArray.from_arrays(pa.array([0, 0, 90]), pa.array(np.concatenate([b[:89], [9]]).astype(np.int32))),
                             sizes, np.concatenate([sizes, ends_b[-1:]]))
    doc_, pair, times = held.pairs()
    want = Counter((int(x) << 16 | int(y)) for x, y in zip(a[:89], b[:89])) + Counter(int(x) << 16 | 9 for x in a[89:])
    assert dict(zip(pair.tolist(), times.tolist(), strict=True)) == dict(want) and set(doc_.tolist()) == {1}
