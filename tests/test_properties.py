"""Property tests against plain-Python models of the original semantics."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from detour import schemas as S
from detour.operators.status import events_from_documents, events_from_worst, worst_status_rows
from detour.operators.upsert import upsert

keys = st.integers(0, 6)
vals = st.one_of(st.none(), st.text("abc", max_size=2))


@settings(max_examples=10, deadline=None)
@given(st.dictionaries(keys, vals, max_size=6),
       st.lists(st.tuples(keys, vals), max_size=15),
       st.sampled_from(["upsert", "replace"]))
def test_upsert_is_sequential_set(spark, existing, writes, mode):
    """MERGE by key then SET, applied in order: last write wins, nulls included (D12);
    upsert keeps untouched keys (D11), replace keeps only written keys."""
    model = dict(existing) if mode == "upsert" else {}
    for k, v in writes:
        model[k] = v
    cur = spark.createDataFrame(list(existing.items()), "k int, v string")
    inc = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(writes)], "k int, v string, seq int")
    got = {r.k: r.v for r in upsert(cur, inc, ["k"], ["seq"], mode).collect()}
    assert got == model


status = st.tuples(st.one_of(st.none(), st.integers(0, 12)), st.sampled_from(["a", "b", "c"]))


def py_worst(statuses):
    """min(statuses, key=severity or 99); first on ties; missing severity reported as 10."""
    w = min(statuses, key=lambda s: 99 if s[0] is None else s[0])
    sev = 10 if w[0] is None else w[0]
    return sev, w[1], sev < 10


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(status, min_size=1, max_size=5), min_size=1, max_size=6))
def test_worst_status_forms_match_model(spark, lines):
    want = {f"l{i}": py_worst(s) for i, s in enumerate(lines)}
    docs = spark.createDataFrame(
        [(f"l{i}", f"L{i}", [(sev, d, None) for sev, d in s]) for i, s in enumerate(lines)], S.RAW_LINE)
    ev = events_from_documents(docs, F.lit("t"))
    assert {r.line_id: (r.severity_code, r.severity_desc, r.is_disrupted) for r in ev.collect()} == want
    rows = spark.createDataFrame(
        [(f"l{i}", j, sev, d) for i, s in enumerate(lines) for j, (sev, d) in enumerate(s)],
        "line string, pos int, sev int, descr string").withColumn("detail", F.lit(None).cast("string"))
    w = worst_status_rows(rows, ["line"], "pos", "sev", "descr", "detail")
    ev2 = events_from_worst(w, F.col("line"), F.col("line"), F.lit("t"))
    assert {r.line_id: (r.severity_code, r.severity_desc, r.is_disrupted) for r in ev2.collect()} == want
