"""K3 / K4 onto bucketed tables, and U2 enforced."""

import random

import pytest
from pyspark.sql import functions as F

from detour import jobs
from detour.operators import buckets as B
from detour.operators.constraints import LACKS_KEY, REPEATED, ConstraintViolation, audit
from detour.operators.upsert import upsert
from detour.session import fresh_path
from detour.streaming.processor import current_snapshot, publish_snapshot
from tests.test_intake import seed_files

EDGE = "a long, b string, v double, seq long"


def files(df):
    return set(df.inputFiles())


def rows(df):
    return sorted((tuple(r) for r in df.select("a", "b", "v").collect()), key=repr)


def test_upserts_equal_the_plain_ones(spark):
    rnd, root, plain = random.Random(4), fresh_path(spark, "test", "buckets"), None
    for step in range(4):
        data = [(rnd.choice([None, *range(30)]), rnd.choice([None, "x", "y"]), rnd.choice([None, 1.0, 2.0]), 1000 * step + i)
                for i in range(60 if step < 3 else 0)]
        inc = spark.createDataFrame(data, EDGE)
        B.upsert_buckets(spark, root, inc, ["a", "b"], ["seq"], buckets=5)
        got = upsert(plain, inc, ["a", "b"], ["seq"]).drop("is_updated")
        plain = spark.createDataFrame(got.collect(), got.schema)
        assert rows(B.read_buckets(spark, root)) == rows(plain)
    with pytest.raises(ValueError):
        B.upsert_buckets(spark, root, inc, ["a"], ["seq"])


def test_untouched_buckets_keep_their_files(spark):
    root = fresh_path(spark, "test", "buckets")
    B.upsert_buckets(spark, root, spark.range(400).select(F.col("id").alias("a"), F.lit("x").alias("b"), F.lit(1.0).alias("v"), F.lit(0).alias("seq")),
                     ["a", "b"], ["seq"], buckets=8)
    before = B.read_buckets(spark, root)
    old = files(before)
    touched = B.upsert_buckets(spark, root, spark.createDataFrame([(7, "x", 9.0, 1), (9999, "x", 9.0, 1)], EDGE), ["a", "b"], ["seq"])
    after = B.read_buckets(spark, root)
    assert 1 <= len(touched) <= 2 and len(files(after) & old) == 8 - len(touched)
    assert all(f"_bucket={b}/" in f for f in files(after) - old for b in touched if f"_bucket={b}/" in f)
    assert rows(after.filter("v = 9.0")) == [(7, "x", 9.0), (9999, "x", 9.0)] and after.count() == 401
    assert before.count() == 400                                   # a reader of the old version still finds it


def test_no_table(spark):
    with pytest.raises(ValueError):
        B.read_buckets(spark, fresh_path(spark, "test", "buckets"))


def test_audit_tells_why(spark):
    t = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, None, 3), (None, None, 4), (3, "c", 5)], "k long, l string, v int")
    kept, bad = audit(t, ["k", "l"])
    assert [r.v for r in kept.collect()] == [5]
    assert sorted((r.v, r.reason) for r in bad.collect()) == [(1, REPEATED), (2, REPEATED), (3, LACKS_KEY), (4, LACKS_KEY)]
    assert audit(t.limit(0), ["k"])[1].count() == 0


def test_a_bad_seed_leaves_the_old_snapshot_current(spark, tmp_path):
    root, good, bad, best = (fresh_path(spark, "test", x) for x in ("root", "good", "bad", "best"))
    paths = seed_files(tmp_path)
    jobs.seed(spark, *paths, good, publish_root=root)
    assert current_snapshot(spark, root) == f"{good}/options"
    copy = fresh_path(spark, "test", "copy")                       # a current graph with a station twice and one without id
    for t in jobs.GRAPH_TABLES:
        df = spark.read.parquet(f"{good}/{t}")
        extra = spark.createDataFrame([("S7", "x", 1.0, 1.0), ("S7", "y", 1.0, 1.0), (None, "z", 1.0, 1.0)], df.schema) if t == "stations" else df.limit(0)
        df.unionByName(extra).write.parquet(f"{copy}/{t}")
    with pytest.raises(ConstraintViolation):
        jobs.seed(spark, *paths, bad, current_dir=copy, publish_root=root)
    assert current_snapshot(spark, root) == f"{good}/options"
    found = spark.read.parquet(f"{bad}/quarantine").collect()
    assert sorted((r.table, r.reason) for r in found) == [("stations", REPEATED), ("stations", REPEATED), ("stations", LACKS_KEY)]
    jobs.seed(spark, *paths, best, current_dir=good, publish_root=root)
    assert current_snapshot(spark, root) == f"{best}/options"
    publish_snapshot(spark, root, "later")
    assert current_snapshot(spark, root) == "later"
