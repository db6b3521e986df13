"""Alignment of the tokens of two tokenizers, in Arrow tables.

Both tokenizers encode the same bytes. Byte offsets where a token of A and a token of B both end cut a document
into groups; each token of A in a group is linked to each of B in it. A pair of ids counts the documents of the whole table that
hold it linked.

A task works through chunks of documents as Arrow tables: the lists of ids are flattened with the indices of their
parents, token lengths are summed up within each document, and a hash join of A's and B's tokens on (document, end) finds the
common ends. Their running number is the group, on which a second hash join makes the links. ``Table.group_by``
brings these to one row for each document and pair, and to partial counts of each pair, which Spark adds up. The
documents' pairs are kept as lists in a written table and joined with the counts; the counts are
broadcast behind a check of their number (they follow the vocabularies), else the join is left to Spark's shuffle and
its splitting of skewed keys.

Texts that are null, empty, or whose tokens' bytes don't give the text back (such as one that holds U+2581) have no tokens:
zeros, and an empty digest. Literals of special tokens are plain text. Rows that share a doc_id are rows of their own (each a
document in the counts); an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from detour.llm import common, tokens
from detour.llm import textbytes as tb

CHUNK_BYTES = 1 << 19  # of text in the tables of one alignment; a longer document is aligned alone
COUNT_BYTES = 48       # of a row of counts in a broadcast table
CROWDED = 64           # tokens of a group; beyond, its ids are counted before they are paired

ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


class Vocabulary:
    """A tokenizer and the bytes of each of its ids."""

    def __init__(self, path: str):
        self.tok = tokens.tokenizer(path, False)
        self.of = _piece_bytes(self.tok) if isinstance(self.tok, tokens.SentencePieces) else _entry_bytes(self.tok)
        self.size = np.array([len(x) for x in self.of], np.int64)
        self.tok.bytes_of = self.of

    def encode(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(all ids, their number by document, whether their bytes are the document's)"""
        ids, n = self.tok.of_bytes(raw, at)
        good = self.tok.faithful.copy()
        for i in np.flatnonzero(~good):  # a piece isn't given back: the whole text is looked at
            end = int(n[:i + 1].sum())
            good[i] = b"".join(self.of[k] for k in ids[end - n[i]:end].tolist()) == raw[at[i]:at[i + 1]].tobytes()
        return ids, n, good


def _entry_bytes(tok: tokens.PieceTokenizer) -> list[bytes]:
    """Byte-level entries: printable bytes stand for themselves, the others, in order, for characters from U+0100 on."""
    plain = [b for lo, hi in ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)) for b in range(lo, hi + 1)]
    byte = {chr(b): b for b in plain}
    byte |= {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    entry = {i: e for e, i in tok.lib.get_vocab(with_added_tokens=True).items()}
    return [bytes(byte[c] for c in entry.get(i, "") if c in byte) for i in range(max(entry) + 1)]


def _piece_bytes(tok: tokens.SentencePieces) -> list[bytes]:
    lib, out = tok.lib, []
    for i in range(lib.get_piece_size()):
        piece = lib.id_to_piece(i)
        out.append(bytes([int(piece[3:-1], 16)]) if lib.is_byte(i) else piece.replace(tok.BOUNDARY, " ").encode())
    return out


def _documents(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of texts, their bytes with a space before each, offsets) in chunks; null and empty texts stay empty."""
    for lo, hi, raw, at in tb.chunks(column):
        size = np.diff(at)
        edge = at + np.concatenate([[0], np.cumsum(size > 0)])
        spaced = np.full(edge[-1], 32, np.uint8)
        spaced[np.arange(len(raw)) + np.repeat(np.cumsum(size > 0), size)] = raw
        yield hi - lo, spaced, edge


def _lists(ids: np.ndarray, counts: np.ndarray, good: np.ndarray) -> pa.LargeListArray:
    n = np.where(good, counts, 0)
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)])), pa.array(ids[np.repeat(good, counts)].astype(np.int32)))


def _ends(lists: pa.LargeListArray, size: np.ndarray, name: str) -> pa.Table:
    """(document_end, number of the token in the chunk): the byte offset of its end in its document, with the document."""
    flat, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    total = pc.cumulative_sum(pc.take(pa.array(size), flat))
    before = np.concatenate([[0], total.to_numpy(zero_copy_only=False)])[lists.offsets.to_numpy()[:-1]]
    end = pc.subtract(total, pc.take(pa.array(before), doc))  # summed up anew in each document
    return pa.table({"document_end": pc.add(pc.shift_left(doc.cast(pa.int64()), 32), end), name: np.arange(len(flat), dtype=np.int32)})


def _groups(n: int, closing: np.ndarray) -> np.ndarray:
    """The group of each of ``n`` tokens: how many closed before it. The last tokens of a document close, so no group spans two."""
    closes = np.zeros(n, np.int64)
    closes[closing] = 1
    return np.cumsum(closes) - closes


class Aligned:
    """The groups and links of a chunk of documents."""

    def __init__(self, a: pa.LargeListArray, b: pa.LargeListArray, size_a: np.ndarray, size_b: np.ndarray):
        self.a, self.b, self.ids_a, self.ids_b = a, b, pc.list_flatten(a).to_numpy(), pc.list_flatten(b).to_numpy()
        met = _ends(a, size_a, "a").join(_ends(b, size_b, "b"), "document_end", join_type="inner", use_threads=False)
        self.group_a, self.group_b = _groups(len(self.ids_a), met["a"].to_numpy()), _groups(len(self.ids_b), met["b"].to_numpy())
        n_groups = len(met)
        self.in_a, self.in_b = np.bincount(self.group_a, minlength=n_groups), np.bincount(self.group_b, minlength=n_groups)
        self.doc_of = pc.list_parent_indices(a).to_numpy()[np.cumsum(self.in_a) - 1]
        self.n_groups = np.bincount(self.doc_of, minlength=len(a))
        self.n_links = np.bincount(self.doc_of, self.in_a * self.in_b, len(a)).astype(np.int64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, pair, times), in this order: each pair of ids that a document links, with the number of its links there."""
        single = (self.in_a == 1) & (self.in_b == 1)  # the first join has met both tokens
        one_a, one_b = single[self.group_a], single[self.group_b]
        keys = [_pair(np.flatnonzero(single), self.ids_a[one_a], self.ids_b[one_b], self.doc_of)]
        times = [np.ones(len(keys[0]), np.int64)]
        crowded = max(self.in_a.max(initial=0), self.in_b.max(initial=0)) > CROWDED

        def side(name: str, ids: np.ndarray, group: np.ndarray, rest: np.ndarray) -> pa.Table:
            held = pa.table({"group": group[rest].astype(np.int32), name: ids[rest]})
            if crowded:  # ids of one group, each once
                held = held.group_by(["group", name], use_threads=False).aggregate([([], "count_all")]).rename_columns(["group", name, f"n_{name}"])
            return held

        met = side("a", self.ids_a, self.group_a, ~one_a).join(side("b", self.ids_b, self.group_b, ~one_b), "group", join_type="inner", use_threads=False)
        keys.append(_pair(met["group"].to_numpy(), met["a"].to_numpy(), met["b"].to_numpy(), self.doc_of))
        times.append(met["n_a"].to_numpy() * met["n_b"].to_numpy() if crowded else np.ones(len(met), np.int64))
        key, weight = np.concatenate(keys), np.concatenate(times)
        if crowded:
            key, of = np.unique(key, return_inverse=True)
            n = np.zeros(len(key), np.int64)
            np.add.at(n, of, weight)
        else:
            key, n = np.unique(key, return_counts=True)
        return key >> 32, key & 0xFFFFFFFF, n

    def digests(self) -> list[str]:
        """Of each document the sha256 of its groups, as `a1,a2|b1;a3|b2,b3`; '' without tokens."""
        left, right = (_text(lists, group) for lists, group in ((self.a, self.group_a), (self.b, self.group_b)))
        groups = pc.binary_join_element_wise(left, right, "|")
        edge = pa.array(np.concatenate([[0], np.cumsum(self.n_groups)]).astype(np.int32))
        whole = pc.binary_join(pa.ListArray.from_arrays(edge, groups), ";").to_pylist()
        return [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in whole]


def _pair(group: np.ndarray, a: np.ndarray, b: np.ndarray, doc_of: np.ndarray) -> np.ndarray:
    return doc_of[group].astype(np.int64) << 32 | a.astype(np.int64) << 16 | b.astype(np.int64)


def _text(lists: pa.LargeListArray, group: np.ndarray) -> pa.Array:
    """The ids of each group as text, comma-joined."""
    ids = pc.list_flatten(lists)
    edge = np.concatenate([np.flatnonzero(np.diff(group, prepend=-1)), [len(ids)]])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), ids.cast(pa.string())), ",")


def aligned(docs: DataFrame, tokenizer_a: str, tokenizer_b: str) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of every row of ``docs``: ``pairs`` are
    the linked pairs of ids (a * 65536 + b), each once, ``times`` how many links each has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _vocabulary(tokenizer_a), _vocabulary(tokenizer_b)
        for batch in batches:
            done = 0
            for n, raw, at in _documents(batch.column(2)):
                (ids_a, n_a, good_a), (ids_b, n_b, good_b) = a.encode(raw, at), b.encode(raw, at)
                good = good_a & good_b
                got = Aligned(_lists(ids_a, n_a, good), _lists(ids_b, n_b, good), a.size, b.size)
                doc, pair, times = got.pairs()
                edge = pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(done, n), batch.column(1).slice(done, n), pa.array(np.where(good, n_a, 0)),
                    pa.array(np.where(good, n_b, 0)), pa.array(got.n_groups), pa.array(got.n_links), pa.array(got.digests()),
                    pa.ListArray.from_arrays(edge, pa.array(pair)), pa.ListArray.from_arrays(edge, pa.array(times))],
                    names=[c.split()[0] for c in ALIGNED.split(", ")])
                done += n

    common.python_tasks(docs.sparkSession)
    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(run, ALIGNED)


_HELD: dict[str, Vocabulary] = {}


def _vocabulary(path: str) -> Vocabulary:
    if path not in _HELD:
        _HELD[path] = Vocabulary(path)
    return _HELD[path]


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, n): how many documents hold each pair linked; every task sends one row for a pair and batch at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = pa.table({"pair": pc.list_flatten(b.column(0))})  # each pair once a document
            part = held.group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "n"])
            yield from part.combine_chunks().to_batches()

    return found.select("pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def align(docs: DataFrame, tokenizer_a: str, tokenizer_b: str) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``."""
    spark, path = docs.sparkSession, common.scratch(docs.sparkSession, "alignment")
    aligned(docs, tokenizer_a, tokenizer_b).write.option("compression", "zstd").parquet(f"{path}/aligned")
    found = spark.read.schema(ALIGNED).parquet(f"{path}/aligned")
    counts = common.written(pair_counts(found), f"{path}/counts")
    best = counts.groupBy(F.shiftright("pair", 16).alias("a")).agg(F.max("n").alias("most"))
    ranked = counts.join(common.broadcast_if_small(best, COUNT_BYTES), F.shiftright("pair", 16) == F.col("a"))
    ranked = common.written(ranked.select("pair", "n", (F.col("n") == F.col("most")).alias("is_best")), f"{path}/ranked")
    links = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    sums = (links.join(common.broadcast_if_small(ranked, COUNT_BYTES), "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(F.lit(0))).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")))
    zero = F.lit(0).cast("long")
    return found.drop("pairs", "times").join(sums, "row", "left").select(
        "row", "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
