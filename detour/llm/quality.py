"""Quality by a factorisation machine over hashed words, structure statistics and metadata.

A document is a sparse vector: its words, hashed, with the square roots of their counts scaled to unit
length; its structure statistics (shares of capitals, marks, digits, distinct words, repeated lines and
so on) and metadata (the given number of characters against the real one), each as one of BINS steps. The
machine scores it as w0 + <w, x> + sum of pairwise interactions <v_i, v_j> x_i x_j,
which the identity 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2) gives in time linear in
the document's words. It is fitted by MLlib on one part of a sample of labelled rows bounded by
``TRAIN_ROWS``; a logistic curve fitted on the other part turns its output into a chance. All
texts are scored whole.

Null counts as empty; an empty text is scored from its statistics alone; a null n_chars has a step of its own;
rows that share a doc_id are scored each; an empty table gives no rows; other columns aren't
read. Without labels of both classes the score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import FMClassifier, LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from detour.llm import common, labelled
from detour.llm import textbytes as tb

TRAIN_ROWS = 12_000
WORD_BUCKETS = 1 << 12
BINS = 12
FIT_PART = 75  # of 100; the rest is for calibration
FACTORS = 8

# Each statistic and what its first and last steps stand for (on a square-root scale).
STATISTICS = {"capitals": 1.0, "shouted": 1.0, "marks": 0.6, "exclaimed": 0.2, "piped": 0.2, "symbols": 0.6, "digits": 0.5, "distinct": 1.0,
              "repeated_next": 1.0, "repeated_lines": 1.0, "repeated_runs": 1.0, "top_word": 1.0, "word_length": 20.0, "long_words": 0.5,
              "line_length": 400.0, "spaces": 0.6, "non_ascii": 0.5, "log_words": 12.0, "stops": 0.3}
METADATA = ("n_chars",)
WIDTH = WORD_BUCKETS + (len(STATISTICS) + len(METADATA)) * (BINS + 1)


def _mask(*spans: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for lo, hi in spans:
        out[lo:hi] = True
    return out


_UPPER, _DIGIT, _HIGH = _mask((65, 91)), _mask((48, 58)), _mask((128, 256))
_LETTER = _mask((65, 91), (97, 123), (128, 256))
_MARK = _mask((33, 48), (58, 65), (91, 97), (123, 127))
_SYMBOL = _mask((35, 39), (42, 44), (60, 63), (64, 65), (92, 97), (126, 127))
_STOP = _mask((44, 45), (46, 47), (59, 60), (63, 64))
_SPACE = _mask((9, 14), (32, 33))


def _distinct(doc: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, largest count of one) by document"""
    key = np.sort(doc.astype(np.uint64) << np.uint64(48) | h >> np.uint64(16))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
    count = np.diff(np.concatenate([first, [len(key)]]))
    owner = (key[first] >> np.uint64(48)).astype(np.int64)
    most = np.zeros(n, np.int64)
    begin = np.searchsorted(owner, np.arange(n))
    some = begin < np.searchsorted(owner, np.arange(n), "right")
    if some.any():
        most[some] = np.maximum.reduceat(count, begin[some])
    return np.bincount(owner, minlength=n), most


def _lines(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lines, share of bytes in lines that came before in the same document)"""
    n = len(at) - 1
    cut = np.unique(np.concatenate([at, np.flatnonzero(raw == 10) + 1]))
    starts, ends = cut[:-1], cut[1:]
    doc = np.searchsorted(at, starts, "right") - 1
    size = ends - starts
    h = tb.span_hashes(raw, starts, np.where(raw[ends - 1] == 10, ends - 1, ends)) if len(starts) else np.zeros(0, np.uint64)
    order = np.lexsort((h, doc))
    again = np.zeros(len(h), bool)
    again[order[1:]] = (doc[order[1:]] == doc[order[:-1]]) & (h[order[1:]] == h[order[:-1]])
    return np.bincount(doc, minlength=n), np.bincount(doc, size * again, n) / np.maximum(np.diff(at), 1)


def vectors(raw: np.ndarray, at: np.ndarray, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, index, value) of the non-zero entries, by document and index; ``n_chars`` may hold NaN."""
    h, starts, ends, counts = tb.words(raw, at)
    n, size = len(counts), np.maximum(np.diff(at), 1)
    per, doc = np.maximum(counts, 1), np.repeat(np.arange(n), counts)
    edge = np.concatenate([[0], np.cumsum(counts)])
    byte = lambda mask: tb.by_document(mask, at)
    word = lambda values: tb.by_document(values, edge)
    ups = np.concatenate([[0], np.cumsum(_UPPER[raw])])
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    runs, of = tb.run_hashes(h, counts, 5)
    kinds, most = _distinct(doc, h, n)
    run_kinds, _ = _distinct(np.repeat(np.arange(n), of), runs, n)
    lines, again = _lines(raw, at)
    letters = np.maximum(byte(_LETTER[raw]), 1)
    length = ends - starts
    stats = {
        "capitals": byte(_UPPER[raw]) / letters, "shouted": word((ups[ends] - ups[starts] == length) & (length > 1)) / per,
        "marks": byte(_MARK[raw]) / size, "exclaimed": byte(raw == 33) / size, "piped": byte(raw == 124) / size,
        "symbols": byte(_SYMBOL[raw]) / size, "digits": byte(_DIGIT[raw]) / size, "distinct": kinds / per,
        "repeated_next": word(same) / per, "repeated_lines": again, "repeated_runs": 1 - run_kinds / np.maximum(of, 1), "top_word": most / per,
        "word_length": word(length) / per, "long_words": word(length > 20) / per, "line_length": counts / np.maximum(lines, 1),
        "spaces": byte(_SPACE[raw]) / size, "non_ascii": byte(_HIGH[raw]) / size, "log_words": np.log1p(counts), "stops": byte(_STOP[raw]) / size}
    chars = byte((raw & 0xC0) != 0x80)
    steps = [np.minimum(np.sqrt(np.clip(v / STATISTICS[k], 0, 1)) * BINS, BINS - 1).astype(np.int64) for k, v in stats.items()]
    ratio = np.nan_to_num(np.log2((n_chars + 1) / (chars + 1)), nan=99.0)
    steps.append(np.where(ratio == 99.0, BINS, np.clip(np.round(ratio * 2) + BINS // 2, 0, BINS - 1)).astype(np.int64))
    base = WORD_BUCKETS + np.arange(len(steps)) * (BINS + 1)

    pair, times = np.unique(doc * WORD_BUCKETS + (h % np.uint64(WORD_BUCKETS)).astype(np.int64), return_counts=True)
    owner = pair // WORD_BUCKETS
    value = np.sqrt(times / per[owner])
    docs = np.concatenate([owner, np.repeat(np.arange(n), len(steps))])
    index = np.concatenate([pair % WORD_BUCKETS, (np.stack(steps, axis=1) + base).ravel()])
    values = np.concatenate([value, np.full(n * len(steps), 1 / np.sqrt(len(steps)))])
    order = np.argsort(docs, kind="stable")
    return docs[order], index[order], values[order]


def machine(doc: np.ndarray, index: np.ndarray, value: np.ndarray, n: int, bias: float, linear: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The raw scores: linear in the entries, by the sum-of-squares identity. ``doc`` ascends and misses none."""
    begin = np.searchsorted(doc, np.arange(n))
    vx = factors[index] * value[:, None]
    if not n:
        return np.zeros(0)
    total, squares = np.add.reduceat(vx, begin, axis=0), np.add.reduceat(vx * vx, begin, axis=0)
    return bias + np.add.reduceat(linear[index] * value, begin) + 0.5 * (total * total - squares).sum(axis=1)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False).astype(np.float64)


def _sparse(sample: DataFrame) -> DataFrame:
    """(part_, label, features) of a bounded sample, for MLlib."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            chars = _numbers(b.column("n_chars"))
            index, value = [], []
            for lo, hi, raw, at in tb.chunks(b.column("text")):
                doc, i, x = vectors(raw, at, chars[lo:hi])
                edge = np.searchsorted(doc, np.arange(hi - lo + 1))
                index += [i[s:e].astype(np.int32) for s, e in zip(edge[:-1], edge[1:], strict=True)]
                value += [x[s:e] for s, e in zip(edge[:-1], edge[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("part_"), b.column("label_").cast(pa.float64()), pa.array(index, pa.list_(pa.int32())),
                                              pa.array(value, pa.list_(pa.float64()))], names=["part_", "label", "index", "value"])

    @F.udf(VectorUDT())
    def vector(index, value):
        return SparseVector(WIDTH, index, value)

    found = (sample.select("part_", "label_", "text", "n_chars")
             .mapInArrow(run, "part_ int, label double, index array<int>, value array<double>"))
    return found.select("part_", "label", vector("index", "value").alias("features"))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = TRAIN_ROWS) -> Callable[[DataFrame], DataFrame]:
    """Learn from the rows of ``labels`` for which ``learn`` holds; the returned function takes (doc_id, text,
    n_chars) to (doc_id, score)."""
    spark, path = docs.sparkSession, common.scratch(docs.sparkSession, "quality")
    common.python_tasks(spark)
    chosen = labelled.sample(docs.select("doc_id", "text", "n_chars"), labels, "quality", learn, rows)
    sample = common.written(_sparse(chosen), f"{path}/sample")
    learned, rest = sample.where(F.col("part_") < FIT_PART), sample.where(F.col("part_") >= FIT_PART)
    if min(f.select("label").distinct().count() for f in (learned, rest)) < 2:
        share = sample.agg(F.coalesce(F.avg("label"), F.lit(0.5))).first()[0]
        return lambda df: df.select("doc_id", F.lit(float(share)).alias("score"))
    model = FMClassifier(factorSize=FACTORS, maxIter=60, stepSize=0.05, regParam=1e-3, initStd=0.05, seed=7).fit(learned)
    bias, linear, factors = float(model.intercept), model.linear.toArray(), model.factors.toArray()
    output = array_to_vector(F.array(vector_to_array("rawPrediction")[1])).alias("features")
    curve = LogisticRegression(regParam=1e-3).fit(model.transform(rest).select("label", output))
    slope, shift = max(float(curve.coefficients[0]), 0.0), float(curve.intercept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            chars, got = _numbers(b.column("n_chars")), []
            for lo, hi, raw, at in tb.chunks(b.column("text")):
                doc, index, value = vectors(raw, at, chars[lo:hi])
                got.append(machine(doc, index, value, hi - lo, bias, linear, factors))
            raw_score = np.clip(slope * (np.concatenate(got) if got else np.zeros(0)) + shift, -700, 700)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(1 / (1 + np.exp(-raw_score)))], names=["doc_id", "score"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return lambda df: df.select("doc_id", "text", "n_chars").mapInArrow(run, schema)
