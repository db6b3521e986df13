import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F

import corpus_pipeline
from detour.llm import labelled, toxicity
from detour.llm.queries import ORACLE_SQL, QUERIES

from .helpers import SMALL, reread
from .test_packing import check as check_packing
from .test_probminhash import brute as near_classes
from .test_winnowing import brute as contaminated


def test_stages_against_brute_force(spark):
    """Each stage on its own input: what it keeps, and that its rows keep their columns."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    schema, bench = docs.schema, spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = reread(spark, stage(spark, docs, SMALL))
        assert out.schema == schema
        before, after = docs.collect(), out.collect()
        ids = {r.doc_id for r in after}
        assert set(after) <= set(before) and len(after) == len(ids)
        if name == "toxicity":
            labels = spark.read.parquet(f"{SMALL}/labels.parquet")
            rated = toxicity.fit(docs, labels, labelled.remainder(F.col("doc_id"), 4) != 2)(docs.select("doc_id", "text")).collect()
            assert ids == {r.doc_id for r in rated if r.score_ < 0.3}
        elif name == "exact_dedup":
            best = {}
            for r in before:
                best[r.text] = max(best.get(r.text, -1), r.doc_id)
            assert ids == set(best.values())
        elif name == "near_dedup":
            groups = near_classes(before)
            assert len(ids) == len(groups) and all(len(ids & set(g)) == 1 for g in groups)
        else:
            assert ids == {r[0] for r in contaminated(before, bench) if not r[5]}
        docs = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    check_packing(docs.collect(), pieces)


def test_run_packs_what_the_stages_keep(spark):
    pieces = QUERIES["pipeline"](spark, SMALL).collect()
    assert 0 < len({p.doc_id for p in pieces}) < spark.read.parquet(f"{SMALL}/documents.parquet").count()
    total = {p.doc_id: p.doc_tokens for p in pieces}
    assert sum(p.length for p in pieces) == sum(total.values())


def test_all_queries_are_registered():
    import __spark_entry__ as entry
    registered = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in QUERIES if q != "pipeline"}
    assert set(QUERIES) <= set(registered) and set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert np.all([callable(registered[q]) for q in QUERIES]) and P.path("byte_bpe_50k.json")
