import hashlib

from pyspark.sql import functions as F

from detour.llm import common, dedup

from .helpers import DOCS, clashing, doc, odd_docs, table


def key(r):
    return (r.doc_id is not None, r.doc_id or 0)


def check(got, docs):
    groups = {}
    for d in docs:
        groups.setdefault(d.text or "", []).append(d)
    best = {t: max(g, key=key).doc_id for t, g in groups.items()}
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert len(got) == len(docs)
    for r in got:
        t = sha[r.text_sha256]
        assert (r.keep_id, r.group_size) == (best[t], len(groups[t]))
    for s, t in sha.items():
        kept = [r for r in got if r.text_sha256 == s and r.kept]
        assert len(kept) == 1 and kept[0].doc_id == best[t]


def test_odd_texts_and_a_large_group(spark):
    docs = odd_docs(spark, [doc(100 + i, "many copies") for i in range(2500)])
    check(dedup.dedup(docs).collect(), docs.collect())


def test_texts_that_share_a_digest_are_told_apart(spark):
    docs = odd_docs(spark, [doc(100 + i, f"t{i % 40}") for i in range(400)])
    weak = lambda t: F.substring(F.md5(t.cast("binary")), 1, 1)
    check(dedup.dedup(docs, digest=weak, batch_bytes=4000).collect(), docs.collect())


def test_state_goes_on_from_its_checkpoint(spark):
    path = common.scratch(spark, "dedup-test")
    def arrive(ids):
        rows = spark.createDataFrame([(i, ("f", i), f"d{i % 3}") for i in ids], "id_ long, at_ struct<file:string,row:long>, digest string")
        rows.write.mode("append").parquet(f"{path}/arrivals")
        return {r.digest: (r.group_size, r.kept.id_) for r in dedup.fold(spark, f"{path}/arrivals", f"{path}/state").collect()}
    assert arrive([0, 1, 2, 3]) == {"d0": (2, 3), "d1": (1, 1), "d2": (1, 2)}
    assert arrive([4]) == {"d0": (2, 3), "d1": (2, 4), "d2": (1, 2)}


def test_rows_that_stay_keep_their_columns(spark):
    docs = clashing(odd_docs(spark), "at_", "id_", "kept", "c0_", "file_", "row_", "digest")
    from .helpers import reread
    docs = reread(spark, docs)
    out = dedup.deduplicated(docs)
    assert out.schema == docs.schema
    assert out.count() == docs.select(F.coalesce("text", F.lit(""))).distinct().count()


def test_empty(spark):
    docs = table(spark, [], DOCS)
    assert dedup.dedup(docs).count() == 0 and dedup.deduplicated(docs).columns == docs.columns
