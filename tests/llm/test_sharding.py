import hashlib
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from detour.llm import sharding

from .helpers import DOCS, SMALL, doc, odd_docs, table


def jump(key: int, shards: int) -> int:
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def key_of(value) -> int:
    return int(hashlib.md5(("" if value is None else str(value)).encode()).hexdigest()[:16], 16)


def check(rows, docs, shards):
    assert sorted(map(repr, ((r.doc_id, r.text) for r in docs))) == sorted(map(repr, ((r.doc_id, r.text) for r in docs)))
    want = sorted(((d.doc_id is None, d.doc_id, len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode()), jump(key_of(d.doc_id), shards),
                    jump(key_of(d.doc_id), shards + 1)) for d in docs), key=repr)
    assert sorted(((r.doc_id is None, r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in rows), key=repr) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "key" and r.grown_shard in (r.shard, shards)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


def test_published_values(spark):
    """The published algorithm's shards of given 64-bit keys, for small and large counts."""
    df = spark.range(300)
    for n in (1, 2, 7, 64, 1000):
        got = df.select("id", sharding.jump_shard(F.col("id"), n).alias("s")).collect()
        assert [r.s for r in sorted(got)] == [jump(key_of(i), n) for i in range(300)]


def test_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    check(sharding.shard_rows(docs, 8).collect(), docs.collect(), 8)


def test_odd_rows_and_hot_key(spark):
    docs = odd_docs(spark, [doc(5, "copy")] * 200)
    check(sharding.shard_rows(docs.selectExpr("*", "lang as shard", "lang as row", "lang as pid"), 3).collect(), docs.collect(), 3)


def test_empty(spark):
    assert sharding.shard_rows(table(spark, [], DOCS), 8).count() == 0
