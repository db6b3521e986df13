"""Near-duplicates by ProbMinHash over weighted word shingles.

A document is the multiset of its runs of five words; a shingle's weight is its count. Every shingle
fires a Poisson process at the rate of its weight; each arrival falls on a random one of M
registers, and a register keeps the shingle that came first. Arrivals are drawn in time order up
to an expected horizon and stop there once all registers are met, else the horizon
doubles. Two documents agree in a register with a probability that is their probability
Jaccard similarity J_P (the Jaccard similarity, if all counts are one).

BANDS bands of ROWS registers make the buckets: at J_P = 0.8 a pair meets in one with probability
1 - (1 - 0.8^4)^24 > 0.999996. J_P of candidates is then computed from the whole texts.
Shingles that no other document in the buckets has bound J_P from above, and so do counts of shingles by class: a document
with too many unshared ones can't reach the similarity with any other of its bucket, and of the rest most pairs that are
below it can't. Members are compared with one pivot of the bucket, the most central one: whose buckets, over all bands, hold the
most documents (an original among its edited copies). Linked ones are merged into components. Each bucket whose pairs left
between different components are at most ``PAIRS_PER_MEMBER`` for each of its own members is then compared pair by pair, as far as the
bounds allow; the others get further pivots, each from outside the components of the former ones, while these link anything. Within a component no
comparison is needed any more, so no class that all pairs would give is lost. A bucket of many documents that the
bounds allow to be similar, but that aren't, comes down to its pairs after a round that links nothing, or ``PIVOT_ROUNDS`` pivots.

Texts with the same words in the same order are copies and are represented by one of them; a class
is a connected component of links. Null counts as empty; texts without words are copies
of equal texts only; a text of one to four words has one shingle. Rows that share a
doc_id are rows of their own; ties go to the least, null last; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from detour.llm import common, components
from detour.llm import textbytes as tb

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
M = BANDS * ROWS
CLASSES = 128  # of shingles, for an upper bound of what two texts share
PIVOT_ROUNDS = 6
HELD_SHINGLES = 1 << 20  # of texts that a task keeps between batches of pairs
PAIRS_PER_MEMBER = 16  # pairs between components that are compared one by one, for each member of their bucket

_GOLD = 0x9E3779B97F4A7C15


def weighted(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(the words, each closed by a zero byte, their offsets by document, words by document, document, shingle, weight) of
    a chunk of texts."""
    codes, starts, ends, counts = tb.word_spans(raw, at)
    h = tb.prime_hashes(codes, starts, ends)
    size = ends - starts + 1
    end = np.cumsum(size)
    joined = np.append(codes, np.uint8(0))[np.arange(end[-1] if len(end) else 0) + np.repeat(starts - (end - size), size)]
    joined[end - 1] = 0
    edge = np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(counts)])]
    shingles, runs = tb.run_hashes(h, counts, SHINGLE)
    doc = np.repeat(np.arange(len(counts), dtype=np.uint64), runs)
    pairs = np.sort(doc << np.uint64(52) | shingles >> np.uint64(12))
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])[:len(pairs)])
    weight = np.diff(np.concatenate([first, [len(pairs)]]))
    pairs = pairs[first]
    return joined, edge, counts, (pairs >> np.uint64(52)).astype(np.int64), pairs & np.uint64((1 << 52) - 1), weight


def sketch(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """n x M registers: the shingle that came first; documents without shingles keep 0."""
    out = np.zeros((n, M), np.uint64)
    rate = np.bincount(doc, weight, n)
    horizon = np.where(rate > 0, (math.log(M) + 3) * M / np.maximum(rate, 1), 0.0)
    todo = np.ones(n, bool)
    key = tb.mix(shingle)
    while True:
        live = np.flatnonzero(todo[doc])
        if not len(live):
            return out
        slots, times, owners = [], [], []
        when, draw = np.zeros(len(live)), 0
        while len(live):
            draw += 1
            x = tb.mix(key[live] + np.uint64(draw * _GOLD % (1 << 64)))
            when = when - np.log(tb.uniform(x)) / weight[live]
            keep = when <= horizon[doc[live]]
            live, when, x = live[keep], when[keep], x[keep]
            slots.append(doc[live] * M + (tb.mix(x + np.uint64(1)) % np.uint64(M)).astype(np.int64))
            times.append(when)
            owners.append(live)
        slot, time, owner = np.concatenate(slots), np.concatenate(times), np.concatenate(owners)
        first = np.full(n * M, -1, np.int64)
        late_first = np.argsort(-time, kind="stable")  # the earliest is written last
        first[slot[late_first]] = owner[late_first]
        first = first.reshape(n, M)
        full = todo & (first >= 0).all(axis=1)
        out[full] = shingle[first[full]]
        todo &= ~full & (rate > 0)
        horizon *= 2


def bands(registers: np.ndarray) -> np.ndarray:
    """n x BANDS bucket keys."""
    n = len(registers)
    by = registers.reshape(n, BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(_GOLD) + np.zeros((n, 1), np.uint64)
    for j in range(ROWS):
        key = tb.mix(key ^ tb.mix(by[:, :, j] + np.uint64(j + 1)))
    return key.view(np.int64)


def sketched(docs: DataFrame) -> DataFrame:
    """``docs`` with, in place of the text, ``content`` (one for copies) and ``keys`` (of the buckets; null: no words)."""
    rest = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            content, keys = [], []
            for _, _, raw, at in tb.chunks(b.column("text")):
                joined, edge, counts, doc, shingle, weight = weighted(raw, at)
                key = bands(sketch(doc, shingle, weight, len(counts)))
                for i, n in enumerate(counts.tolist()):  # words, or a text without any
                    data = joined[edge[i]:edge[i + 1]].tobytes() if n else b"\0" + raw[at[i]:at[i + 1]].tobytes()
                    content.append(hashlib.md5(data).digest())
                    keys.append(key[i] if n else None)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(f.name) for f in rest], pa.array(content, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=[*[f.name for f in rest], "content", "keys"])

    added = [T.StructField("content", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType()))]
    return docs.mapInArrow(common.lean(run), T.StructType([*rest, *added]))


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """J_P of two (sorted shingles, weights): the sum over common d of 1 / sum_k max(a_k / a_d, b_k / b_d)."""
    common_, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common_):
        return 0.0
    wa, wb = a[1][i].astype(np.float64), b[1][j].astype(np.float64)
    only_a, only_b = a[1].sum() - wa.sum(), b[1].sum() - wb.sum()
    order = np.argsort(wa / wb, kind="stable")  # for k above d in this order a decides, else b
    wa, wb = wa[order], wb[order]
    ratio = wa / wb
    first = np.searchsorted(ratio, ratio, "left")  # equal ratios may go either way
    above = wa.sum() - np.concatenate([[0.0], np.cumsum(wa)])[first]
    below = np.concatenate([[0.0], np.cumsum(wb)])[first]
    return float((1 / ((above + only_a) / wa + (below + only_b) / wb)).sum())


def _sets(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for _, _, raw, at in tb.chunks(column):
        _, _, counts, doc, shingle, weight = weighted(raw, at)
        edge = np.searchsorted(doc, np.arange(len(counts) + 1))
        out += [(shingle[s:e], weight[s:e]) for s, e in zip(edge[:-1], edge[1:], strict=True)]
    return out


def _checked(similarity: float) -> common.Work:
    """(u, v, linked) of pairs (u, v) and their texts (a, b). A text is taken apart once for the pairs of a batch, and of the next ones
    while the task holds it."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            if sum(len(s[0]) for s in held.values()) > HELD_SHINGLES:
                held = {}
            sides = [b.column(c).to_numpy() for c in ("u", "v")]
            for nodes, column in zip(sides, ("a", "b"), strict=True):
                node, at = np.unique(nodes, return_index=True)
                new = [k for k, n in enumerate(node.tolist()) if n not in held]
                held.update(zip(node[new].tolist(), _sets(b.column(column).take(pa.array(at[new]))), strict=True))
            got = [probability_jaccard(held[x], held[y]) >= similarity - 1e-12 for x, y in zip(*[s.tolist() for s in sides], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("u"), b.column("v"), pa.array(got, pa.bool_())], names=["u", "v", "linked"])

    return check


def similar(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(u, v, linked) of pairs (u, v): whether J_P of their texts reaches ``similarity``."""
    a = texts.select(F.col("node").alias("u"), F.col("text").alias("a"))
    b = texts.select(F.col("node").alias("v"), F.col("text").alias("b"))
    return pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b").mapInArrow(common.lean(_checked(similarity)), "u long, v long, linked boolean")


def rare(texts: DataFrame) -> DataFrame:
    """(node, n, weight, hist, own, own_weight): the number and weight of a text's shingles, their weight
    by CLASSES classes (null: too large for it), and the number and weight of those that no other text of the table has."""
    def chunked(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            node = b.column("node").to_numpy()
            for lo, hi, raw, at in tb.chunks(b.column("text")):
                yield node[lo:hi], *weighted(raw, at)[3:]

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, doc, shingle, weight in chunked(batches):
            yield pa.RecordBatch.from_arrays([pa.array(node[doc]), pa.array(shingle.view(np.int64)), pa.array(weight)],
                                             names=["node", "shingle", "weight"])

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, doc, shingle, weight in chunked(batches):
            n = len(node)
            cell = doc * CLASSES + (shingle % np.uint64(CLASSES)).astype(np.int64)
            count = np.bincount(cell, weight, n * CLASSES).reshape(n, CLASSES)
            hist = [None if top > 32767 else row for row, top in zip(count.astype(np.int16), count.max(axis=1, initial=0), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), pa.array(np.bincount(doc, minlength=n)), pa.array(np.bincount(doc, weight, n).astype(np.int64)),
                 pa.array(hist, pa.list_(pa.int16()))], names=["node", "n", "weight", "hist"])

    given = texts.select("node", "text")
    by = given.mapInArrow(common.lean(shingles), "node long, shingle long, weight long").groupBy("shingle").agg(
        F.count(F.lit(1)).alias("texts"), F.min("node").alias("node"), F.min("weight").alias("weight"))
    own = by.where("texts = 1").groupBy("node").agg(F.count(F.lit(1)).alias("own"), F.sum("weight").alias("own_weight"))
    whole = given.mapInArrow(common.lean(sizes), "node long, n long, weight long, hist array<smallint>")
    return whole.join(own, "node", "left").select("node", "n", "weight", "hist", F.coalesce("own", F.lit(0)).cast("long").alias("own"),
                                                  F.coalesce("own_weight", F.lit(0)).cast("long").alias("own_weight"))


def _possible(a: str, b: str, similarity: float) -> Column:
    """Whether J_P of two texts, given their columns of :func:`rare` with suffixes, may reach ``similarity``.

    J_P is at most 1 less the weight share of either's own shingles. If all counts are one it is the Jaccard
    similarity, and the texts share at most the shingles that aren't one's own, and in each class of
    shingles at most the fewer of the two."""
    c = lambda name, side: F.col(f"{name}{side}")
    shares = [c("own_weight", x) <= (1 - similarity + 1e-9) * c("weight", x) for x in (a, b)]
    needed = F.lit(similarity) * (c("n", a) + c("n", b)) / F.lit(1 + similarity) - F.lit(1e-6)
    both = F.least(c("n", a) - c("own", a), c("n", b) - c("own", b))
    fewer = F.zip_with(c("hist", a), c("hist", b), lambda x, y: F.least(x, y))
    shared = F.coalesce(F.aggregate(fewer, F.lit(0), lambda s, x: s + x) >= needed, F.lit(True))
    sets = (c("n", a) == c("weight", a)) & (c("n", b) == c("weight", b))
    return shares[0] & shares[1] & F.when(sets, (both >= needed) & shared).otherwise(F.lit(True))


def _pairs_left(members: DataFrame) -> DataFrame:
    """(band, key, few) of the buckets that hold more than one component: whether the pairs between them are few."""
    part = members.groupBy("band", "key", "component").agg(F.count(F.lit(1)).alias("n"))
    whole = part.groupBy("band", "key").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("own"))
    left = (F.col("n") * F.col("n") - F.col("own")) / 2
    return whole.where("parts > 1").select("band", "key", (left <= F.lit(PAIRS_PER_MEMBER) * F.col("n")).alias("few"))


def _able(members: DataFrame, similarity: float) -> DataFrame:
    """Without the members that can't reach ``similarity`` with any other of their bucket: sets (all counts are one) among sets, which
    share fewer shingles with others than even the shortest of them needs."""
    is_set = F.col("n") == F.col("weight")
    least = members.groupBy("band", "key").agg(F.min("n").alias("least_n"), F.min(is_set).alias("all_sets"))
    needed = F.lit(similarity) * (F.col("n") + F.col("least_n")) / F.lit(1 + similarity) - F.lit(1e-6)
    return members.join(least, ["band", "key"]).where(~F.col("all_sets") | (F.col("n") - F.col("own") >= needed)).drop("least_n", "all_sets")


def _merged(of: DataFrame, linked: DataFrame, path: str) -> DataFrame:
    """``of`` (node, component) after the components that ``linked`` (u, v) joins are one."""
    end = lambda c: of.select(F.col("node").alias(c), F.col("component").alias(f"{c}_of"))
    edges = linked.join(end("u"), "u").join(end("v"), "v").select(F.col("u_of").alias("u"), F.col("v_of").alias("v"))
    into = components.components(edges, f"{path}/components").select(F.col("node").alias("component"), F.col("component").alias("into"))
    return common.written(of.join(into, "component", "left").select("node", F.coalesce("into", "component").alias("component")), f"{path}/all")


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id, representative, class_size, kept, class_row, row, at_) of every row of ``docs``, which must
    come straight from files; ``at_`` is the row's locator.

    ``class_id`` is the least doc_id of the class (null only if all are), ``representative`` the least
    among the row's own copies, ``kept`` marks one row of each class, whose number is ``class_row``."""
    spark, path = docs.sparkSession, common.scratch(docs.sparkSession, "probminhash")
    common.python_tasks(spark)
    text = common.text_or_empty()
    keyed = common.located(docs, ["doc_id", "text"]).withColumns({"text": text, "text_key": F.md5(text.cast("binary"))})
    rows = common.written(sketched(keyed.withColumn("row", F.monotonically_increasing_id())), f"{path}/rows")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row", "text_key")).alias("first")
    nodes = common.written(rows.groupBy("content").agg(least, F.first("keys").alias("keys"))
                           .select(F.monotonically_increasing_id().alias("node"), "content", "first", "keys"), f"{path}/nodes")
    buckets = nodes.select("node", F.posexplode("keys").alias("band", "key"))
    full = buckets.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band", "key", F.col("n").alias("held"))
    members = common.written(buckets.join(full, ["band", "key"]), f"{path}/members")
    central = members.groupBy("node").agg(F.sum("held").alias("central"))  # documents of its buckets, over all bands

    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", F.col("first.text_key").alias("text_key"))
    texts = common.written(keyed.select("text_key", "text").join(common.broadcast_if_small(wanted, 100), "text_key")
                           .groupBy("node").agg(F.first("text").alias("text")), f"{path}/texts")

    stats = ["n", "own", "weight", "own_weight", "hist"]
    able = common.written(rare(texts), f"{path}/rare").where(F.col("own_weight") <= (1 - similarity + 1e-9) * F.col("weight"))
    members = common.written(_able(members.drop("held").join(able.join(central, "node"), "node"), similarity), f"{path}/able")

    def sides(df: DataFrame, suffix: str, *more: str) -> DataFrame:
        return df.select("band", "key", *[F.col(c).alias(c + suffix) for c in ("node", "component", *stats, *more)])

    checked = common.written(spark.createDataFrame([], "u long, v long, linked boolean"), f"{path}/checked0")
    every = members.select("node").distinct()
    of = every.withColumn("component", F.col("node"))
    asked = spark.createDataFrame([], "band int, key long, pivot long")  # the former pivots
    pivots = True
    for step in range(1, PIVOT_ROUNDS + 2):
        placed = members.join(of, "node")
        open_ = common.written(_pairs_left(placed), f"{path}/open{step}")
        if open_.isEmpty():
            break
        placed = common.written(placed.join(open_, ["band", "key"]), f"{path}/placed{step}")
        pivots = pivots and step <= PIVOT_ROUNDS
        few = F.lit(True) if not pivots else F.lit(False) if step == 1 else F.col("few")
        # The next pivot is the most central member outside the components of the former ones.
        former = asked.join(of.withColumnRenamed("node", "pivot"), "pivot").select("band", "key", "component").distinct()
        rest = placed.where(~few)
        fresh = rest if step == 1 else rest.join(former, ["band", "key", "component"], "left_anti")
        best = fresh.groupBy("band", "key").agg(F.min(F.struct((-F.col("central")).alias("order"), "node", "component", *stats)).alias("p")).select("band", "key", "p.*")
        best = common.written(best.select("band", "key", "node", "component", *stats), f"{path}/pivots{step}")
        asked = asked.unionByName(best.select("band", "key", F.col("node").alias("pivot")))
        others = sides(best, "_b").withColumn("pivot", F.lit(True))
        if step > 1 or not pivots:  # few pairs, or every member is with a former pivot: all pairs
            others = others.unionByName(sides(placed.join(best.select("band", "key"), ["band", "key"], "left_anti"), "_b").withColumn("pivot", F.lit(False)))
        apart = (F.col("component_a") < F.col("component_b")) | F.col("pivot") & (F.col("component_a") != F.col("component_b"))
        met = sides(placed, "_a").withColumnsRenamed({"band": "band_a", "key": "key_a"})
        pairs = met.join(others, (F.col("band_a") == F.col("band")) & (F.col("key_a") == F.col("key")) & apart & _possible("_a", "_b", similarity))
        pairs = pairs.select(F.greatest("node_a", "node_b").alias("u"), F.least("node_a", "node_b").alias("v")).distinct()
        new = pairs if step == 1 else pairs.join(checked.select("u", "v"), ["u", "v"], "left_anti")
        found = common.written(similar(new, texts, similarity), f"{path}/found{step}")
        checked = checked.unionByName(found)
        linked = found.where("linked").select("u", "v")
        if linked.isEmpty():  # further pivots would rarely link more: all pairs that are left come next
            pivots = pivots and step == 1
        else:
            of = _merged(of, linked, f"{path}/of{step}")
        members = placed.select(*members.columns).join(best.select("band", "key"), ["band", "key"])  # the others are done

    named = nodes.select("node", "content", "first").join(of, "node", "left").select(
        "content", "first", F.coalesce("component", "node").alias("component"))
    sizes = rows.groupBy("content").agg(F.count(F.lit(1)).alias("copies"))
    whole = named.join(sizes, "content").groupBy("component").agg(F.min("first").alias("head"), F.sum("copies").alias("class_size"))
    table = named.join(whole, "component").select(
        "content", F.col("head.doc_id").alias("class_id"), F.col("head.row").alias("class_row"),
        F.col("first.doc_id").alias("representative"), "class_size")
    return rows.select("row", "doc_id", "content", "at_").join(table, "content").select(
        "doc_id", "class_id", "representative", "class_size", (F.col("row") == F.col("class_row")).alias("kept"), "class_row", "row", "at_")


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` (all their columns) but one of each class only."""
    return common.without(docs, classes(docs, similarity).where(~F.col("kept")))
