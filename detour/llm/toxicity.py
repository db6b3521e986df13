"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of a seed lexicon and of a learned one, how near second-person
words stand to lexicon words, capitals, punctuation and obfuscation (digits and symbols inside words, drawn-out
letters, lexicon words that appear only once look-alike digits and symbols are read as letters). The learned
lexicon holds words and word beginnings (inflected forms share them) that the toxic documents of
one part of the labelled sample use more than the clean ones, by the lower confidence bound of
their log-odds; trees are fitted on a second part, the isotonic calibration on a third.

Only the labelled sample is bounded (``TRAIN_ROWS``); all texts are scored whole. Null counts as empty; an empty text
is scored like others, from features that are all zero; rows that share a doc_id are
scored each; an empty table gives no rows; other columns aren't read. Without labels of both
classes the score is the share of toxic labels (0 without labels).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from detour.llm import common, labelled
from detour.llm import textbytes as tb

TRAIN_ROWS = 12_000
LEXICON_PART, TREE_PART = 45, 75  # of 100: up to the first the lexicon, up to the second the trees, the rest calibration
MIN_DOCS = 4
CONFIDENCE = 1.64  # standard errors taken off the log-odds
MIN_ODDS = 1.0
STRONG_ODDS = 3.0
LEXICON_SIZE = 20_000
NEAR = 3
STEMS = (3, 4, 5, 6, 7, 8)  # bytes of a word's beginning

# A general seed lexicon and second-person words of the four languages, in plain alphabetical order.
SEED = ("abschaum asshole bastard bitch clown crap cretin crétin damn degenerate disgusting dumb dummkopf escoria fool garbage "
        "hate idiot idiota idiote imbecile imbécil imbécile jerk loser lunatic moron müll pathetic patético pathétique "
        "scum shit shut stupid stupide stupido trash ugly vermin worthless").split()
SECOND = ("deine dich dir du euch eure ihr su te ti toi tu tus tú u ur usted ustedes vos votre vous you your yours yourself").split()

FEATURES = ("seed", "learned", "strong", "strong_any", "top", "mean", "near_you", "you", "disguised", "capitals", "shouted",
            "exclaimed", "asked", "marks", "inner_digits", "inner_symbols", "drawn_out", "length")

_LEET = tb.FOLD.copy()
for _a, _b in zip(b"013457@$", b"oieast" + b"as", strict=True):
    _LEET[_a] = _b
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = ~(_LETTER | _DIGIT)
_MARK[:33] = False


@dataclass
class Lexicon:
    keys: np.ndarray  # sorted hashes
    odds: np.ndarray

    def __post_init__(self) -> None:
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.keys & np.uint64(0xFFFF)).astype(np.int64)] = True

    def score(self, h: np.ndarray) -> np.ndarray:
        """The weight of each hash, 0 for those that aren't in the lexicon."""
        out = np.zeros(len(h))
        may = np.flatnonzero(self.maybe[(h & np.uint64(0xFFFF)).astype(np.int64)])
        if len(may):
            where = np.minimum(np.searchsorted(self.keys, h[may]), len(self.keys) - 1)
            hit = self.keys[where] == h[may]
            out[may[hit]] = self.odds[where[hit]]
        return out


def lexicon(keys: np.ndarray, odds: np.ndarray) -> Lexicon:
    order = np.argsort(keys)
    return Lexicon(keys[order], odds[order])


def _of_words(listed: list[str]) -> Lexicon:
    raw, at = tb.flat(pa.array(listed))
    keys = np.unique(tb.span_hashes(tb.FOLD[raw], at[:-1], at[1:]))
    return Lexicon(keys, np.ones(len(keys)))


def units(raw: np.ndarray, at: np.ndarray, fold: np.ndarray = tb.FOLD) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray, np.ndarray]:
    """([(word number, hash) for whole words, then for each length of stem], start, end, count by document)"""
    codes, starts, ends, counts = tb.word_spans(raw, at, fold)
    spans = tb.Spans(codes)
    out = [(np.arange(len(starts)), spans.hash(starts, ends))]
    for k in STEMS:
        long = np.flatnonzero(ends - starts > k)
        out.append((long, spans.hash(starts[long], starts[long] + k)))
    return out, starts, ends, counts


def features(raw: np.ndarray, at: np.ndarray, seed: Lexicon, second: Lexicon, learned: Lexicon) -> np.ndarray:
    """A row of FEATURES for each document of a chunk."""
    found, starts, ends, counts = units(raw, at)
    n = len(counts)
    edge = np.concatenate([[0], np.cumsum(counts)])
    sums = lambda x: tb.by_document(x, edge)
    per = np.maximum(counts, 1)
    odds = np.zeros(len(starts))  # of a word: the most of its own and its stems'
    for of, h in found:
        np.maximum(odds, _spread(of, learned.score(h), len(odds)), out=odds)
    is_seed = seed.score(found[0][1]) > 0
    you = second.score(found[0][1]) > 0
    strong = (odds >= STRONG_ODDS) | is_seed
    doc = np.repeat(np.arange(n), counts)
    total = np.concatenate([[0], np.cumsum(you)])
    place = np.arange(len(starts))
    near = total[np.minimum(place + NEAR + 1, edge[doc + 1])] > total[np.maximum(place - NEAR, edge[doc])]
    top, some = np.zeros(n), counts > 0
    if some.any():
        top[some] = np.maximum.reduceat(odds, edge[:-1][some])

    # Look-alikes read as letters, at words that change by it.
    leet_codes, s2, e2, c2 = tb.word_spans(raw, at, _LEET)
    changed = np.concatenate([[0], np.cumsum(leet_codes != tb.FOLD[raw])])
    odd = np.flatnonzero(changed[e2] > changed[s2])
    odd_hash = tb.Spans(leet_codes).hash(s2[odd], e2[odd]) if len(odd) else np.zeros(0, np.uint64)
    hidden = np.zeros(len(s2))
    hidden[odd] = (seed.score(odd_hash) > 0) | (learned.score(odd_hash) >= STRONG_ODDS)

    byte = lambda mask: tb.by_document(mask, at)
    letter, upper = _LETTER[raw], _UPPER[raw]
    letters, size = np.maximum(byte(letter), 1), np.maximum(np.diff(at), 1)
    ups = np.concatenate([[0], np.cumsum(upper)])
    shouted = (ups[ends] - ups[starts] == ends - starts) & (ends - starts > 1)
    inner = np.zeros(len(raw), bool)
    inner[1:-1] = letter[:-2] & letter[2:]
    drawn = np.zeros(len(raw), bool)
    drawn[2:] = (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2]) & letter[2:]
    hit = sums(strong)
    cols = [sums(is_seed) / per, sums(odds >= MIN_ODDS) / per, hit / per, np.minimum(hit, 3), top, sums(odds) / per, sums(strong & near) / per,
            sums(you) / per, tb.by_document(hidden, np.concatenate([[0], np.cumsum(c2)])) / per, byte(upper) / letters, sums(shouted) / per,
            byte(raw == 33) / size, byte(raw == 63) / size, byte(_MARK[raw]) / size, byte(inner & _DIGIT[raw]) / letters,
            byte(inner & _MARK[raw]) / letters, byte(drawn) / letters, np.log1p(counts)]
    return np.stack(cols, axis=1)


def _spread(of: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n)
    out[of] = values
    return out


def _unit_counts(texts: DataFrame, among: np.ndarray | None) -> DataFrame:
    """(unit, n): in how many texts each word or stem occurs, of those in ``among`` if given."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = []
            for _, _, raw, at in tb.chunks(b.column(0)):
                found, _, _, counts = units(raw, at)
                doc = np.repeat(np.arange(len(counts), dtype=np.int64), counts)
                owner, h = np.concatenate([doc[of] for of, _ in found]), np.concatenate([h for _, h in found])
                if among is not None:
                    keep = np.isin(h, among)
                    owner, h = owner[keep], h[keep]
                order = np.lexsort((h, owner))
                owner, h = owner[order], h[order]
                new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])])[:len(h)]
                seen.append(h[new])
            unit, n = np.unique(np.concatenate(seen) if seen else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(unit.view(np.int64)), pa.array(n)], names=["unit", "n"])

    return texts.select("text").mapInArrow(common.lean(count), "unit long, n long").groupBy("unit").agg(F.sum("n").alias("n"))


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """The words and stems of the toxic texts of a (bounded) sample by the least likely log-odds."""
    n = {r["label_"]: r["n"] for r in sample.groupBy("label_").agg(F.count(F.lit(1)).alias("n")).collect()}
    empty = lexicon(np.zeros(1, np.uint64), np.zeros(1))
    if not n.get(1) or not n.get(0):
        return empty
    toxic = _unit_counts(sample.where("label_ = 1"), None).where(F.col("n") >= MIN_DOCS).toPandas()  # units of a bounded sample
    keys, bad = toxic["unit"].to_numpy(np.int64).view(np.uint64), toxic["n"].to_numpy(np.float64)
    if not len(keys):
        return empty
    order = np.argsort(keys)
    keys, bad, good = keys[order], bad[order], np.zeros(len(keys))
    clean = _unit_counts(sample.where("label_ = 0"), keys).toPandas()
    good[np.searchsorted(keys, clean["unit"].to_numpy(np.int64).view(np.uint64))] = clean["n"]
    odds = np.log((bad + 0.5) / (n[1] - bad + 0.5)) - np.log((good + 0.5) / (n[0] - good + 0.5))
    least = odds - CONFIDENCE * np.sqrt(1 / (bad + 0.5) + 1 / (good + 0.5))
    best = np.argsort(-least, kind="stable")[:LEXICON_SIZE]
    best = best[least[best] >= MIN_ODDS]
    return lexicon(keys[best], least[best]) if len(best) else empty


def featured(docs: DataFrame, learned: Lexicon, text: str = "text", carry_text: bool = False) -> DataFrame:
    """``docs`` with its features as ``dense``; the text goes unless it is to be carried."""
    rest = [f for f in docs.schema.fields if carry_text or f.name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed, second = _of_words(SEED), _of_words(SECOND)
        for b in batches:
            got = [features(raw, at, seed, second, learned) for _, _, raw, at in tb.chunks(b.column(text))]
            x = np.concatenate(got) if got else np.zeros((0, len(FEATURES)))
            dense = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(FEATURES), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in rest], dense], names=[*[f.name for f in rest], "dense"])

    return docs.mapInArrow(common.lean(run), T.StructType([*rest, T.StructField("dense", T.ArrayType(T.DoubleType()))]))


Score = Callable[..., DataFrame]


def fit(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = TRAIN_ROWS) -> Score:
    """Learn from the rows of ``labels`` for which ``learn`` holds; the returned function adds ``score_`` to a
    table, given the name of its text column and whether to carry the text along."""
    spark, path = docs.sparkSession, common.scratch(docs.sparkSession, "toxicity")
    common.python_tasks(spark)
    sample = common.written(labelled.sample(docs.select("doc_id", "text"), labels, "toxic", learn, rows), f"{path}/sample")
    words = learn_lexicon(sample.where(F.col("part_") < LEXICON_PART))
    known = common.written(featured(sample.where(F.col("part_") >= LEXICON_PART).select("part_", "label_", "text"), words), f"{path}/features")
    known = known.withColumns({"features_": array_to_vector("dense"), "label": F.col("label_").cast("double")})
    trees, rest = known.where(F.col("part_") < TREE_PART), known.where(F.col("part_") >= TREE_PART)
    share = sample.agg(F.coalesce(F.avg("label_"), F.lit(0.0)).cast("double")).first()[0]
    if min(f.select("label").distinct().count() for f in (trees, rest)) < 2:
        def constant(df: DataFrame, text: str = "text", carry_text: bool = False) -> DataFrame:
            return (df if carry_text else df.drop(text)).withColumn("score_", F.lit(share))
        return constant
    learner = GBTClassifier(featuresCol="features_", predictionCol="class_", maxIter=20, maxDepth=4, stepSize=0.2, seed=7)
    boosted = learner.setProbabilityCol("probability_").setRawPredictionCol("raw_").fit(trees)
    chance = vector_to_array("probability_")[1].alias("chance_")
    calibration = IsotonicRegression(featuresCol="chance_", predictionCol="calibrated_").fit(boosted.transform(rest).select(chance, "label"))

    def score(df: DataFrame, text: str = "text", carry_text: bool = False) -> DataFrame:
        rated = boosted.transform(featured(df, words, text, carry_text).withColumn("features_", array_to_vector("dense")))
        rated = calibration.transform(rated.withColumn("chance_", chance))
        return (rated.withColumn("score_", F.least(F.greatest("calibrated_", F.lit(0.0)), F.lit(1.0)))
                .drop("dense", "features_", "raw_", "probability_", "class_", "chance_", "calibrated_"))

    return score


def clean(docs: DataFrame, labelled_docs: DataFrame, labels: DataFrame, learn: Column, threshold: float, rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` (all their columns), which must come straight from files, that score below ``threshold``.

    Texts go to the scoring once and don't come back: the rows to drop are known by their place."""
    found = common.located(docs, ["text"])
    bad = fit(labelled_docs, labels, learn, rows)(found).where(F.col("score_") >= threshold).select("at_")
    return common.without(docs, common.written(bad, common.scratch(docs.sparkSession, "toxic_rows")))
