from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import FMClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from detour.llm import labelled, quality, toxicity
from detour.llm import textbytes as tb
from detour.llm.queries import op2_factorisation_machine, op9_boosted_toxicity

from .helpers import DOCS, clashing, doc, odd_docs, reread, table

MIDDLE = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def auc(pairs):
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])


def held_out(spark, rows, label):
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    return [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]


def test_quality_held_out(spark):
    assert auc(held_out(spark, op2_factorisation_machine(spark, MIDDLE).collect(), "quality")) > 0.85


def test_toxicity_held_out(spark):
    """300 labels teach little of the invented insults; see the README for larger tables."""
    assert auc(held_out(spark, op9_boosted_toxicity(spark, MIDDLE).collect(), "toxic")) > 0.75


def few(spark):
    docs = [doc(i, f"you are an idiot and a moron number {i}" if i % 3 == 0 else f"a calm remark about the weather {i}, and rain") for i in range(300)]
    labels = [(i, 1 - int(i % 3 == 0), int(i % 3 == 0)) for i in range(300)] + [(None, 1, 1), (5, None, None)]
    return odd_docs(spark, docs[20:]), table(spark, labels, LABELS, 1)


def test_toxic_documents_go_and_columns_stay(spark):
    docs, labels = few(spark)
    docs = reread(spark, clashing(docs, "score_", "features_", "label", "probability", "dense"))
    out = toxicity.clean(docs, docs, labels, F.lit(True), 0.3)
    assert out.schema == docs.schema
    left = {r.doc_id for r in out.collect()}
    assert not {i for i in range(21, 300) if i % 3 == 0} & left and {i for i in range(20, 300) if i % 3} <= left
    assert out.where("text is null or text = ''").count() == 2


def test_without_labels_of_both_classes(spark):
    docs, _ = few(spark)
    for rows, share in (([], 0.0), ([(i, 1, 1) for i in range(20, 60)], 1.0)):
        labels = table(spark, rows, LABELS, 1)
        got = toxicity.fit(docs, labels, F.lit(True))(docs.select("doc_id", "text"))
        assert {r.score_ for r in got.collect()} == {share}
        got = quality.fit(docs, labels, F.lit(True))(docs).collect()
        assert {r.score for r in got} == {share if rows else 0.5} and len(got) == docs.count()


def test_empty_documents(spark):
    docs, labels = few(spark)
    none = table(spark, [], DOCS)
    assert toxicity.fit(docs, labels, F.lit(True))(none.select("doc_id", "text")).count() == 0
    assert quality.fit(none, labels, F.lit(True))(none).count() == 0


def test_sample_is_bounded_and_keeps_its_rows(spark):
    docs, labels = few(spark)
    learn = labelled.remainder(F.col("doc_id"), 4) != 2
    got = labelled.sample(docs.select("doc_id", "text"), labels, "toxic", learn, 50)
    rows = got.collect()
    assert len({r.doc_id for r in rows}) <= 50 and sorted(rows) == sorted(got.collect())
    import zlib
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 != 2 for r in rows)


def test_features_are_the_same_in_any_chunking():
    texts = ["", "You IDIOT!!", "1d10t and st*pid, sooo bad", "plain words\nand more", "Ünï you are stupid"] * 3
    seed, second = toxicity._of_words(toxicity.SEED), toxicity._of_words(toxicity.SECOND)
    none = toxicity.lexicon(np.zeros(1, np.uint64), np.zeros(1))
    whole = toxicity.features(*tb.flat(pa.array(texts)), seed, second, none)
    each = np.concatenate([toxicity.features(*tb.flat(pa.array([t])), seed, second, none) for t in texts])
    assert np.allclose(whole, each)
    at = dict(zip(toxicity.FEATURES, each[1], strict=True))
    assert at["seed"] == 0.5 and at["near_you"] == 0.5 and at["you"] == 0.5 and at["shouted"] == 0.5 and at["exclaimed"] > 0
    assert dict(zip(toxicity.FEATURES, each[2], strict=True))["disguised"] > 0 and (each[0] == 0).all()
    raw, at = tb.flat(pa.array(texts))
    chars = np.array([len(t) for t in texts], float)
    doc_, index, value = quality.vectors(raw, at, chars)
    one = [quality.vectors(*tb.flat(pa.array([t])), np.array([float(len(t))])) for t in texts]
    assert index.tolist() == np.concatenate([o[1] for o in one]).tolist() and np.allclose(value, np.concatenate([o[2] for o in one]))


def test_sum_of_squares_identity():
    rng = np.random.default_rng(2)
    doc_ = np.repeat([0, 1, 2], [4, 1, 6])
    index, value = rng.integers(0, 20, 11), rng.random(11)
    linear, factors = rng.normal(size=20), rng.normal(size=(20, 3))
    got = quality.machine(doc_, index, value, 3, 0.5, linear, factors)
    for d in range(3):
        own = [(i, x) for i, x, o in zip(index, value, doc_, strict=True) if o == d]
        pairs = sum(factors[i] @ factors[j] * x * y for (i, x), (j, y) in combinations(own, 2))
        assert np.isclose(got[d], 0.5 + sum(linear[i] * x for i, x in own) + pairs)


def test_scores_are_mllibs(spark):
    """The numpy scores equal those of MLlib's own prediction."""
    docs, labels = few(spark)
    sample = quality._sparse(labelled.sample(docs.select("doc_id", "text", "n_chars"), labels, "quality", F.lit(True), 60))
    rows = reread(spark, sample)
    model = FMClassifier(factorSize=4, maxIter=5, seed=1).fit(rows)
    for r in model.transform(rows).select("features", vector_to_array("rawPrediction")[1].alias("raw")).collect():
        v = r.features
        got = quality.machine(np.zeros(len(v.indices), int), v.indices, v.values, 1, model.intercept, model.linear.toArray(), model.factors.toArray())
        assert np.isclose(got[0], r.raw)


def test_the_sample_is_bounded_in_rows(spark):
    """A key that many rows share gives one of them, always the same."""
    docs = table(spark, [doc(1, f"text {i}") for i in range(500)] + [doc(i, "one") for i in range(2, 40)], DOCS)
    labels = table(spark, [(i, 1, i % 2) for i in range(1, 40)] + [(1, 0, 0)], LABELS, 1)
    got = [labelled.sample(docs.select("doc_id", "text"), labels, "toxic", F.lit(True), 25).collect() for _ in range(2)]
    assert len(got[0]) == 25 and len({r.doc_id for r in got[0]}) == 25 and sorted(got[0]) == sorted(got[1])
    everything = labelled.sample(docs.repartition(7).select("doc_id", "text"), labels, "toxic", F.lit(True), 1000).collect()
    assert len(everything) == 39 and {tuple(r) for r in got[0]} <= {tuple(r) for r in everything}
