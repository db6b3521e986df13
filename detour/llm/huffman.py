"""Token ids as canonical length-limited Huffman codes, in blocks that decode on their own.

A written folder holds two Parquet tables: ``codebook`` (one row: the code length of
every id, 0 for ids that don't occur, and the end id) and ``blocks``. A block holds
whole documents, about ``BLOCK_IDS`` ids: their doc_ids and sizes, the codes
as big-endian 64-bit words (most significant bit first), and the bit offset of every
``STRIDE``-th id, so that any stretch of ids can be read without what stands before it.
``part`` ascends with doc_id and ``first`` counts the ids of the part that precede the
block; with the parts' totals that gives each document's place among all ids.

Null or empty texts hold the end id alone; null doc_ids come first; rows that share a doc_id
follow each other in a fixed order; an empty table gives an empty table of blocks.
Columns of the input other than id and text are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from detour.llm import common, tokens
from detour.llm import textbytes as tb

MAX_LENGTH = 16
BLOCK_IDS = 16_384
STRIDE = 256
LANES = 1024       # decoded side by side
SLICE_IDS = 1 << 18

BLOCK = ("part int, block int, first long, n_ids long, doc_ids array<bigint>, sizes array<bigint>, "
         "checkpoints array<bigint>, bits binary")


def tokenised(docs: DataFrame, path: str, drop_space: bool, end_id: int = 1, literals: bool = False,
              cache_pieces: int = tokens.CACHE_PIECES) -> DataFrame:
    """(doc_id, ids: 16-bit little-endian, n_ids): the whole text's ids and the end id."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokens.tokenizer(path, drop_space, literals, cache_pieces)
        for b in batches:
            for lo, hi, flat, sizes in tok.slices(b.column(1), end_id):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), tokens.binary(flat, sizes), pa.array(sizes)],
                                                 names=["doc_id", "ids", "n_ids"])

    common.python_tasks(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(common.lean(encode, tokenizes=True), "doc_id long, ids binary, n_ids long")


def id_counts(ids: DataFrame) -> DataFrame:
    """(id, n): how often each id occurs; every task sends one row for an id at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for b in batches:
            total += np.bincount(tokens.ids_of(b.column(0))[0], minlength=1 << 16)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["id", "n"])

    return ids.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, limit: int = MAX_LENGTH) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 where the count is 0."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols don't fit codes of {limit} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.int64)
    n = len(used)
    # Level by level, the sorted mix of symbols (True) and pairs of the level below.
    levels, merged = [np.ones(n, bool)], weights
    for _ in range(limit - 1):
        pairs = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, pairs])
        order = np.argsort(both, kind="stable")
        levels.append(order < n)
        merged = both[order]
    take, depth = 2 * n - 2, np.zeros(n + 1, np.int64)
    for symbols in reversed(levels):
        k = int(symbols[:take].sum())
        depth[0] += 1  # the k lightest symbols get one bit more
        depth[k] -= 1
        take = 2 * (take - k)
    lengths[used] = np.cumsum(depth)[:n]
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each symbol: by length, then by symbol, counting up."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    if len(order):
        step = np.uint64(1) << (np.uint64(63) - lengths[order].astype(np.uint64))
        top = np.concatenate([np.zeros(1, np.uint64), np.cumsum(step)[:-1]])
        codes[order] = top >> (np.uint64(63) - lengths[order].astype(np.uint64))
    return codes


def decode_table(lengths: np.ndarray, limit: int = MAX_LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(symbol, length) for each value of the next ``limit`` bits."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    times = 1 << (limit - lengths[order].astype(np.int64))
    symbol, length = np.zeros(1 << limit, np.uint16), np.ones(1 << limit, np.uint8)
    symbol[:times.sum()] = np.repeat(order, times)
    length[:times.sum()] = np.repeat(lengths[order], times)
    return symbol, length


def pack_bits(ids: np.ndarray, block_of: np.ndarray, lengths: np.ndarray, codes: np.ndarray,
              n_blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of all blocks, first word of each block and the end, bit offset of each id in its block)"""
    size = lengths[ids].astype(np.int64)
    total = np.cumsum(size) - size
    begin = np.searchsorted(block_of, np.arange(n_blocks + 1))
    edge = np.concatenate([total, [int(size.sum())]])[begin]
    word_at = np.concatenate([[0], np.cumsum((np.diff(edge) + 63) // 64)])
    local = total - edge[block_of]
    pos = word_at[block_of] * 64 + local
    word, off = pos >> 6, pos & 63
    over = off + size - 64  # bits that go to the next word
    code = codes[ids]
    here = np.where(over > 0, code >> np.maximum(over, 0).astype(np.uint64),
                    code << np.maximum(-over, 0).astype(np.uint64))
    out = np.zeros(int(word_at[-1]) + 1, np.uint64)
    if len(ids):
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        out[word[first]] = np.add.reduceat(here, first)
        spill = np.flatnonzero(over > 0)
        out[word[spill] + 1] |= code[spill] << (64 - over[spill]).astype(np.uint64)
    return out, word_at, local


def unpack_bits(words: np.ndarray, at: np.ndarray, counts: np.ndarray, symbol: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Decode lanes side by side: lane i holds ``counts[i]`` ids from bit ``at[i]`` of ``words`` on."""
    words = np.concatenate([words, np.zeros(2, np.uint64)])
    order = np.argsort(-counts, kind="stable")
    at, left = at[order].astype(np.int64), counts[order]
    out = np.zeros((len(at), int(left[0]) if len(at) else 0), np.uint16)
    for step in range(out.shape[1]):
        k = int(np.searchsorted(-left, -step, "left"))  # lanes that hold more ids
        w, off = at[:k] >> 6, (at[:k] & 63).astype(np.uint64)
        bits = (words[w] << off) | ((words[w + 1] >> np.uint64(1)) >> (np.uint64(63) - off))
        look = (bits >> np.uint64(64 - MAX_LENGTH)).astype(np.int64)
        out[:k, step] = symbol[look]
        at[:k] += length[look]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return out[back][np.arange(out.shape[1])[None, :] < counts[:, None]]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch of (doc_id, ids) in stretches of about SLICE_IDS ids: packing holds many times an id's bytes."""
    at = tb.flat(batch.column(1))[1][1:] // 2
    lo = 0
    while lo < len(at):
        before = int(at[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(at, before + SLICE_IDS, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def write_tokens(docs: DataFrame, path: str, tokenizer: str, drop_space: bool, end_id: int = 1, literals: bool = False) -> str:
    """Write the ids of ``docs`` (doc_id, text), in ascending doc_id, below ``path``."""
    spark = docs.sparkSession
    ids = common.written(tokenised(docs, tokenizer, drop_space, end_id, literals)
                         .withColumns({"tie": F.xxhash64("ids"), "row": F.monotonically_increasing_id()}),
                         common.scratch(spark, "token_ids"))
    counts = np.zeros(1 << 16, np.int64)
    for r in id_counts(ids).toLocalIterator():  # a row for each id of the vocabulary at most
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts)
    spark.createDataFrame([(bytearray(lengths.tobytes()), end_id)], "lengths binary, end_id int") \
        .coalesce(1).write.parquet(f"{path}/codebook")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, part, block, first = canonical(lengths), TaskContext.get().partitionId(), 0, 0
        for b in (x for batch in batches for x in _slices(batch)):
            flat, sizes = tokens.ids_of(b.column(1))
            start = np.cumsum(sizes) - sizes
            doc_block = np.unique(start // BLOCK_IDS, return_inverse=True)[1]
            n = int(doc_block[-1]) + 1
            words, word_at, local = pack_bits(flat, np.repeat(doc_block, sizes), lengths, codes, n)
            data = words.astype(">u8")
            edge = np.searchsorted(doc_block, np.arange(n + 1))
            id_edge = np.concatenate([start, [len(flat)]])[edge]
            names, rows = b.column(0).to_pylist(), []
            for k in range(n):
                lo, hi = int(id_edge[k]), int(id_edge[k + 1])
                rows.append({"part": part, "block": block + k, "first": first + lo, "n_ids": hi - lo,
                             "doc_ids": names[edge[k]:edge[k + 1]], "sizes": sizes[edge[k]:edge[k + 1]],
                             "checkpoints": local[lo:hi:STRIDE], "bits": data[word_at[k]:word_at[k + 1]].tobytes()})
            block, first = block + n, first + len(flat)
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                ("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
                ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                ("checkpoints", pa.list_(pa.int64())), ("bits", pa.binary())]))

    order = ["doc_id", "tie", "row"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (ids.select(*order, "ids").repartitionByRange(n, *order).sortWithinPartitions(*order)
        .select("doc_id", "ids").mapInArrow(encode, BLOCK).write.parquet(f"{path}/blocks"))
    return path


def read_tokens(spark: SparkSession, path: str, digests: bool = False) -> DataFrame:
    """Documents of a written folder: doc_id, start, n_tokens and ``ids`` (little-endian 32-bit
    integers), or their ``ids_crc32`` in place of the ids if ``digests``."""
    lengths = np.frombuffer(bytes(spark.read.parquet(f"{path}/codebook").select("lengths").first()[0]), np.uint8)
    blocks = spark.read.parquet(f"{path}/blocks")
    totals = {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}  # one row a file part
    parts = sorted(totals)
    offset = dict(zip(parts, np.concatenate([[0], np.cumsum([totals[p] for p in parts])]).tolist(), strict=False))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbol, length = decode_table(lengths)
        for b in batches:
            lanes = np.array([len(x) for x in b.column("checkpoints")], np.int64)
            group = np.cumsum(lanes) // LANES
            for g in np.unique(group):
                rows = np.flatnonzero(group == g)
                yield _decode_rows(b.slice(int(rows[0]), len(rows)), symbol, length, offset, digests)

    kind = "ids_crc32 long" if digests else "ids binary"
    return (blocks.select("part", "first", "n_ids", "doc_ids", "sizes", "checkpoints", "bits")
            .mapInArrow(decode, f"doc_id long, start long, n_tokens long, {kind}"))


def _decode_rows(b: pa.RecordBatch, symbol: np.ndarray, length: np.ndarray, offset: dict[int, int],
                 digests: bool) -> pa.RecordBatch:
    raw = [np.frombuffer(x.as_py(), ">u8") for x in b.column("bits")]
    base = np.cumsum([0] + [len(x) for x in raw])[:-1] * 64
    points = [np.asarray(x.as_py(), np.int64) for x in b.column("checkpoints")]
    at = np.concatenate([p + o for p, o in zip(points, base.tolist(), strict=True)])
    n_ids = b.column("n_ids").to_numpy()
    counts = np.concatenate([np.minimum(STRIDE, n - np.arange(len(p)) * STRIDE) for p, n in zip(points, n_ids, strict=True)])
    ids = unpack_bits(np.concatenate(raw).astype(np.uint64), at, counts, symbol, length)
    names = [d for x in b.column("doc_ids") for d in x.as_py()]
    per = [np.asarray(x.as_py(), np.int64) for x in b.column("sizes")]
    sizes = np.concatenate(per)
    begin = [offset[p] + f for p, f in zip(b.column("part").to_pylist(), b.column("first").to_pylist(), strict=True)]
    start = np.concatenate([np.cumsum(s) - s + o for s, o in zip(per, begin, strict=True)])
    wide = ids.astype("<u4")
    if digests:
        raw, edge = memoryview(wide).cast("B"), (np.concatenate([[0], np.cumsum(sizes)]) * 4).tolist()
        last = pa.array([zlib.crc32(raw[s:e]) for s, e in zip(edge[:-1], edge[1:], strict=True)], pa.int64())
    else:
        last = tokens.binary(wide, sizes)
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(start), pa.array(sizes), last],
                                      names=["doc_id", "start", "n_tokens", "ids_crc32" if digests else "ids"])
