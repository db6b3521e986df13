"""Benchmark decontamination by winnowing.

A document's fingerprints are, for every window of W consecutive k-gram hashes, the least
of them. Two texts that share W + k - 1 = 10 words in a row share the window's hashes, hence its
fingerprint: so every shared span of ten words meets in the join of training and test
fingerprints, and each match is extended to the spans that have the fingerprint and
checked word by word. A test item of fewer words is one window, found by the hash of all its words.

The test side's fingerprints also make a Bloom filter, which keeps other fingerprints of the
documents out of the join. It grows with the test side up to ``MAX_BITS``; beyond two million fingerprints
each has fewer bits and more of the others pass (one in twenty at 32 million). Results don't depend on it.

Null or empty texts have no words and no hits; items without words have no window; a null
item_id counts as ''; repeated rows are judged alike, each for itself; an empty table of items
leaves all documents clean; other columns of the input are carried by ``decontaminate`` only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from detour.llm import common

SPAN = 10
K = 5
W = SPAN - K + 1
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # words have letters of both cases here
BLOOM_BITS = 128     # for each key
MAX_BITS = 1 << 28   # of the filter: 32 MB in each task


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased (no other letters)."""
    fold = lambda w: F.when(F.lower(w) == w, w).otherwise(
        F.translate(w, string.ascii_uppercase, string.ascii_lowercase))
    return F.transform(F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), ""), fold)


def _places(n: Column, size: int) -> Column:
    """0, 1, ... : where runs of ``size`` begin among ``n``."""
    return F.when(n >= size, F.sequence(F.lit(0), n - F.lit(size))).otherwise(F.array().cast("array<int>"))


def _run(values: str, at: Column, size: int) -> list[Column]:
    return [F.get(F.col(values), at + F.lit(j)) for j in range(size)]


def fingerprinted(df: DataFrame, text: str) -> DataFrame:
    """Add words_, n_words, hashes_ (of the words) and least_ (the fingerprint of the span at each place)."""
    out = df.withColumn("words_", words(F.col(text)))
    out = out.withColumn("n_words", F.size("words_")).withColumn("hashes_", F.transform("words_", lambda w: F.xxhash64(w)))
    out = out.withColumn("grams_", F.transform(_places(F.col("n_words"), K), lambda i: F.xxhash64(*_run("hashes_", i, K))))
    return out.withColumn("least_", F.transform(_places(F.col("n_words"), SPAN), lambda i: F.least(*_run("grams_", i, W))))


def _spans(size: int, keep=None) -> Column:
    """The spans of ``size`` words: where, fingerprint, words; all of them or those ``keep`` lets pass."""
    def mark(i: Column) -> Column:
        return F.get(F.col("least_"), i) if size == SPAN else F.xxhash64(F.lit(size), *_run("hashes_", i, size))
    places = _places(F.col("n_words"), size)
    if keep is not None:
        places = F.filter(places, lambda i: keep(mark(i)))
    return F.transform(places, lambda i: F.struct(
        i.alias("at"), F.lit(size).alias("size"), mark(i).alias("mark"),
        F.array_join(F.slice(F.col("words_"), i + F.lit(1), size), " ").alias("span")))


def item_windows(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item, size, mark, span) of the items' windows, each once."""
    found = fingerprinted(items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), F.col(text)), text)
    short = F.when((F.col("n_words") > 0) & (F.col("n_words") < SPAN), F.array(F.struct(
        F.lit(0).alias("at"), F.col("n_words").alias("size"), F.lit(None).cast("long").alias("mark"), F.array_join("words_", " ").alias("span"))))
    windows = found.select("item", F.explode(F.coalesce(short, _spans(SPAN))).alias("w"))
    return windows.select("item", "w.size", "w.mark", "w.span").distinct()


def _short_marks(windows: DataFrame) -> DataFrame:
    """Short windows get the hash of all their words, as the documents' spans of that size do."""
    hashes = F.transform(F.split("span", " "), lambda w: F.xxhash64(w))
    mark = F.lit(None).cast("long")
    for size in range(1, SPAN):
        mark = F.when(F.col("size") == size, F.xxhash64(F.lit(size), *[F.get(hashes, F.lit(j)) for j in range(size)])).otherwise(mark)
    return windows.withColumn("mark", F.coalesce("mark", mark))


def _probes(mark: Column, bits: int) -> list[Column]:
    return [F.pmod(mark, F.lit(bits)), F.pmod(F.xxhash64(mark), F.lit(bits))]


def bloom(marks: DataFrame, bits: int) -> DataFrame:
    """One row: ``filter``, the bits of all marks as an array of longs."""
    ones = marks.select(F.explode(F.array(*_probes(F.col("mark"), bits))).alias("bit"))
    cells = ones.groupBy(F.shiftright("bit", 6).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("set"))
    every = marks.sparkSession.range(bits >> 6).select(F.col("id").alias("cell"), F.lit(0).cast("long").alias("set"))
    whole = cells.unionByName(every).groupBy("cell").agg(F.bit_or("set").alias("set"))
    return whole.agg(F.transform(F.sort_array(F.collect_list(F.struct("cell", "set"))), lambda x: x["set"]).alias("filter"))


def matched(docs: DataFrame, items: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents with ``row_`` and ``n_words``, without their text; the hits: row_, at, size, span; windows) after
    one pass over the texts."""
    spark, path = docs.sparkSession, common.scratch(docs.sparkSession, "winnowing")
    windows = common.written(_short_marks(item_windows(items)), f"{path}/windows")
    marks = windows.select("mark").distinct()
    count = marks.count()
    short = [r["size"] for r in windows.where(F.col("size") < SPAN).select("size").distinct().collect()]  # at most nine
    keep = None
    if count:
        bits = min(MAX_BITS, max(64, 1 << (count * BLOOM_BITS - 1).bit_length()))
        filt = common.written(bloom(marks, bits), f"{path}/bloom").scalar()

        def keep(mark: Column) -> Column:
            tests = [F.getbit(F.get(F.col("filter_"), F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1
                     for p in _probes(mark, bits)]
            return tests[0] & tests[1]
    found = fingerprinted(docs.withColumn("row_", F.monotonically_increasing_id()), text)
    if keep is not None:
        found = found.withColumn("filter_", filt)
    spans = F.concat(*[_spans(s, keep) for s in [SPAN, *short]]) if count else F.array().cast("array<struct<at:int,size:int,mark:bigint,span:string>>")
    slim = [c for c in docs.columns if c != text]
    met = common.written(found.select("row_", *slim, "n_words", spans.alias("spans_")), f"{path}/spans")
    distinct = windows.select("mark", "span").distinct()
    hits = (met.select("row_", F.explode("spans_").alias("s")).select("row_", "s.at", "s.size", "s.mark", "s.span")
            .join(common.broadcast_if_small(distinct, 150), ["mark", "span"]).select("row_", "at", "size", "span"))
    return met.drop("spans_"), common.written(hits, f"{path}/hits"), windows


def covered(spans: Column) -> Column:
    """How many words a sorted array of (at, size) covers."""
    def step(s: Column, x: Column) -> Column:
        end = x["at"] + x["size"]
        return F.struct(F.greatest(s["end"], end).alias("end"),
                        (s["n"] + F.greatest(F.lit(0), end - F.greatest(s["end"], x["at"]))).alias("n"))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(spans, start, step, lambda s: s["n"])


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated) of every row of ``docs``."""
    slim, hits, windows = matched(docs.select(key, text), items, text)
    hit = hits.groupBy("row_").agg(covered(F.sort_array(F.collect_set(F.struct("at", "size")))).cast("long").alias("n_hit"))
    owners = windows.select("span", "item").distinct()
    pairs = hits.select("row_", "span").distinct().join(common.broadcast_if_small(owners, 150), "span").select("row_", "item").distinct()
    of = pairs.groupBy("row_").agg(F.sort_array(F.collect_list("item")).alias("items"))
    out = slim.join(hit, "row_", "left").join(of, "row_", "left")
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(F.col(key), F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"),
                      F.size(items_).cast("long").alias("n_items"), F.sha2(F.array_join(items_, ",").cast("binary"), 256).alias("items_sha256"),
                      (n_hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` (all their columns) that contain no window of an item."""
    rows, names = common.neutral(docs)
    text_ = next(n for n, c in names.items() if c == text)
    # The verdict depends on the text alone, so it is found by the text's digest.
    digest = F.sha2(common.text_or_empty(text_).cast("binary"), 256)
    slim, hits, _ = matched(rows.select(digest.alias("digest_"), text_), items, text_)
    bad = slim.join(hits.select("row_").distinct(), "row_", "left_semi").select("digest_").distinct()
    clean = rows.withColumn("digest_", digest).join(common.broadcast_if_small(bad, 100), "digest_", "left_anti")
    return common.restored(clean, names)
