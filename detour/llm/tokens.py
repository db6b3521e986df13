"""Token ids by the tokenizers and sentencepiece libraries, with a bounded cache of word pieces per worker.

A library spends most of its time on splitting and on words it has met before. A text
is therefore cut, with numpy, where the tokenizer is certain to cut as well: before
white space that follows other characters, and between a letter and an ASCII
punctuation mark (apostrophes excepted: contractions). Only pieces that the worker has not met go to
the library; ids of all others come from the cache. Cutting at boundaries of the
tokenizer's own pre-tokens leaves the ids unchanged. The cache is looked up by a hash of the piece, and every
hit is compared with the cached piece byte by byte; pieces that share a hash with another go to the library.

Literals of added tokens (such as <|endoftext|>) are text like any other, or, with ``literals``, get
their ids as by the tokenizer's defaults: what stands between them is then cut on its own.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from detour.llm import textbytes as tb

CACHE_PIECES = 1_000_000
CACHE_BYTES = 64 << 20  # of all cached pieces together
LEARN_PIECES = 4096

_SPACE, _LETTER, _MARK, _OTHER = 1, 2, 3, 0
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[65:91] = _LETTER
_KIND[97:123] = _LETTER
for _lo, _hi in ((33, 39), (40, 48), (58, 65), (91, 97), (123, 127)):
    _KIND[_lo:_hi] = _MARK

_OPEN: dict[tuple[str, bool], "PieceTokenizer"] = {}


class Pool:
    """An array that grows at its end."""

    def __init__(self, kind: type, width: int | None = None):
        self.held, self.used = np.zeros(1 << 16 if width is None else (1 << 14, width), kind), 0

    def add(self, values: np.ndarray) -> int:
        """Where ``values`` begin."""
        at = self.used
        if at + len(values) > len(self.held):  # by a quarter, not double: the pool is most of what a worker holds
            more = max(at + len(values) - len(self.held), len(self.held) // 4)
            self.held = np.concatenate([self.held, np.zeros((more, *self.held.shape[1:]), self.held.dtype)])
        self.used += len(values)
        self.held[at:self.used] = values
        return at

    def kept(self) -> np.ndarray:
        return self.held[:self.used]


def runs(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (count[0] of them), first[1], ..."""
    total = np.cumsum(count)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(first - (total - count), count)


def tokenizer(path: str, drop_space: bool, literals: bool = False, cache_pieces: int = CACHE_PIECES) -> "PieceTokenizer":
    """The worker's tokenizer for ``path``; its cache lives until a step that needs none runs in the worker."""
    if (path, literals) not in _OPEN:
        _OPEN[path, literals] = (SentencePieces(path, cache_pieces) if path.endswith(".model")
                                 else PieceTokenizer(path, drop_space, cache_pieces, literals))
    return _OPEN[path, literals]


def forget() -> None:
    """Drop the worker's tokenizers."""
    _OPEN.clear()


class PieceTokenizer:
    """``drop_space``: the tokenizer drops white space, so pieces can leave it out."""

    def __init__(self, path: str, drop_space: bool, cache_pieces: int = CACHE_PIECES, literals: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = not literals
        self.added = {t.content.encode(): i for i, t in self.lib.get_added_tokens_decoder().items()} if literals else {}
        self.literal = re.compile(b"|".join(re.escape(x) for x in sorted(self.added, key=len, reverse=True))) if self.added else None
        if self.lib.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        self.drop_space = drop_space
        self.cache_pieces = cache_pieces
        self.bytes_of: list[bytes] = []  # of each id; given, ``faithful`` tells which documents of the last call they gave back
        self.faithful = np.zeros(0, bool)
        self._forget()

    def _forget(self) -> None:
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # sorted hashes, and the pieces' rows in where
        self.where = Pool(np.int32, 5)  # first id, number of ids, first byte, number of bytes, whether ids give the bytes
        self.pool, self.bytes = Pool(np.uint16), Pool(np.uint8)

    def _cuts(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kind = _KIND[raw]
        if (raw == 0xC3).any():  # U+00C0 to U+00FF are letters but for two signs
            lead = np.flatnonzero(raw[:-1] == 0xC3)
            lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]
            kind[lead] = _LETTER
            kind[lead + 1] = _LETTER
        cut = np.zeros(len(raw) + 1, bool)
        a, b = kind[:-1], kind[1:]
        space = kind == _SPACE
        cut[1:-1] = ((a != b) & (a >= _LETTER) & (b >= _LETTER)) | (space[1:] & ~space[:-1])
        if self.drop_space:
            cut[1:-1] |= space[:-1] & ~space[1:]
        cut[at] = True
        edges = np.flatnonzero(cut)
        starts, ends = edges[:-1], edges[1:]
        if self.drop_space:
            keep = ~space[starts]
            starts, ends = starts[keep], ends[keep]
        return starts, ends

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids by piece), from the library."""
        ids, counts = [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)]
        for k in range(0, len(pieces), LEARN_PIECES):  # an encoding holds far more than its ids
            some = [x.decode("utf-8") for x in pieces[k:k + LEARN_PIECES]]
            got = self.lib.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.asarray(got.ids, np.uint16))
            of = np.asarray(got.word_ids, np.int64) if len(ids[-1]) else np.zeros(0, np.int64)
            counts.append(np.bincount(of, minlength=len(some)).astype(np.int64))
        return np.concatenate(ids), np.concatenate(counts)

    def _given_back(self, pieces: list[bytes], ids: np.ndarray, count: np.ndarray) -> np.ndarray:
        """1 for the pieces that are the joined bytes of their ids."""
        if not self.bytes_of:
            return np.zeros(len(pieces), np.int64)
        of, edge = [self.bytes_of[i] for i in ids.tolist()], np.cumsum(count).tolist()
        return np.array([b"".join(of[e - n:e]) == x for x, n, e in zip(pieces, count.tolist(), edge, strict=True)], np.int64)

    def _learn(self, raw: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        size = ends - starts
        if len(self.keys) + len(keys) > self.cache_pieces or (self.bytes.used and self.bytes.used + int(size.sum()) > CACHE_BYTES):
            raise OverflowError
        blob = raw.tobytes()
        pieces = [blob[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        ids, count = self._encode(pieces)
        new = np.stack([self.pool.add(ids) + np.cumsum(count) - count, count,
                        self.bytes.add(np.frombuffer(b"".join(pieces), np.uint8)) + np.cumsum(size) - size, size,
                        self._given_back(pieces, ids, count)], axis=1)
        slots = self.where.add(new) + np.arange(len(keys), dtype=np.int32)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.slots = np.insert(self.keys, at, keys), np.insert(self.slots, at, slots)

    def _chunk(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids by document)"""
        self.faithful = np.diff(at) == 0
        if not len(raw):
            return np.zeros(0, np.uint16), np.zeros(len(at) - 1, np.int64)
        starts, ends = self._cuts(raw, at)
        if not len(starts):
            return np.zeros(0, np.uint16), np.zeros(len(at) - 1, np.int64)
        keys, sample, inverse = np.unique(tb.span_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        for _ in range(2):
            where = np.searchsorted(self.keys, keys)
            known = np.zeros(len(keys), bool)
            near = where < len(self.keys)
            known[near] = self.keys[where[near]] == keys[near]
            if known.all():
                break
            new = sample[~known]
            try:
                self._learn(raw, keys[~known], starts[new], ends[new])
            except OverflowError:  # full: start over with this chunk's own pieces
                self._forget()
                self.cache_pieces = max(self.cache_pieces, len(keys))
                self._learn(raw, keys, starts[sample], ends[sample])
        got = self.where.kept()[self.slots[np.searchsorted(self.keys, keys)[inverse]]]
        first, count, back, pool = got[:, 0], got[:, 1], got[:, 4], self.pool.kept()
        wrong = self._differs(raw, starts, ends, got)
        if len(wrong):  # another piece has this one's hash
            blob = raw.tobytes()
            own = [blob[s:e] for s, e in zip(starts[wrong].tolist(), ends[wrong].tolist(), strict=True)]
            ids, n = self._encode(own)
            first, count, back = first.copy(), count.copy(), back.copy()
            first[wrong], count[wrong], back[wrong] = len(pool) + np.cumsum(n) - n, n, self._given_back(own, ids, n)
            pool = np.concatenate([pool, ids])
        total = np.cumsum(count)
        pieces = np.searchsorted(starts, at)  # pieces before each document
        edge = np.concatenate([[0], total])[pieces]
        if self.bytes_of:
            self.faithful = np.diff(np.concatenate([[0], np.cumsum(back == 0)])[pieces]) == 0
        return pool[runs(first, count)], np.diff(edge)

    def _differs(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, got: np.ndarray) -> np.ndarray:
        """The spans whose bytes aren't those of the cached piece."""
        size = ends - starts
        same = size == got[:, 3]
        if not same.all():
            starts, size, got = starts[same], size[same], got[same]
        unlike = raw[runs(starts, size)] != self.bytes.kept()[runs(got[:, 2], size)]
        if unlike.any():
            edge = np.concatenate([[0], np.cumsum(unlike)])[np.concatenate([[0], np.cumsum(size)])]
            same[np.flatnonzero(same)[edge[1:] > edge[:-1]]] = False
        return np.flatnonzero(~same)

    def _split(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As _chunk, with the literals of added tokens as pieces of their own."""
        blob = raw.tobytes() if self.literal else b""
        if not self.literal or not self.literal.search(blob):
            return self._chunk(raw, at)
        ends = at.tolist()
        found = [m for lo, hi in zip(ends, ends[1:]) for m in self.literal.finditer(blob, lo, hi)]
        starts = np.array([m.start() for m in found], np.int64)
        edges = np.unique(np.concatenate([at, starts, np.array([m.end() for m in found], np.int64)]))
        ids, n = self._chunk(raw, edges)
        literal = np.searchsorted(edges, starts)
        text = np.ones(len(n), bool)
        text[literal] = False
        ids, n = ids[np.repeat(text, n)], np.where(text, n, 0)
        ids = np.insert(ids, (np.cumsum(n) - n)[literal], np.array([self.added[m.group()] for m in found], np.uint16))
        n[literal] = 1
        return ids, np.diff(np.concatenate([[0], np.cumsum(n)])[np.searchsorted(edges, at)])

    def of_bytes(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, their number by document) of texts that lie in ``raw`` one after the other."""
        return self._split(raw, at)

    def slices(self, column: pa.Array, end_id: int | None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, last row + 1, ids of their texts with ``end_id``, if any, after each, their numbers), a bounded stretch of
        text at a time; null counts as empty."""
        for lo, hi, raw, at in tb.chunks(column):
            ids, n = self._split(raw, at)
            yield (lo, hi, ids, n) if end_id is None else (lo, hi, np.insert(ids, np.cumsum(n), np.uint16(end_id)), n + 1)

    def ids(self, column: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, their numbers), as by :meth:`slices`."""
        got = [x[2:] for x in self.slices(column, end_id)]
        if not got:
            return np.zeros(0, np.uint16), np.zeros(0, np.int64)
        return np.concatenate([x[0] for x in got]), np.concatenate([x[1] for x in got])


class SentencePieces(PieceTokenizer):
    """A sentencepiece BPE model. Two bytes that stand side by side in no piece of the vocabulary are never merged: texts
    are cut between them, where a character begins."""

    BOUNDARY = "\u2581"

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        from sentencepiece import SentencePieceProcessor
        self.lib = SentencePieceProcessor(model_file=path)
        size = self.lib.get_piece_size()
        if size > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        self.joined = np.zeros((256, 256), bool)
        for p in map(self.lib.id_to_piece, range(size)):
            for text in (p, p.replace(self.BOUNDARY, " ")):  # in a text both stand for a boundary
                raw = np.frombuffer(text.encode(), np.uint8)
                self.joined[raw[:-1], raw[1:]] = True
        first, last = self.BOUNDARY.encode()[0], self.BOUNDARY.encode()[-1]
        self.joined[32, first] = self.joined[last, 32] = True
        if self.joined[10].any() or self.joined[:, 10].any():
            raise ValueError("pieces with line feeds")
        self.lead = len(self.lib.encode("\n"))  # the ids of a first space and a line feed
        self.literal, self.cache_pieces, self.bytes_of, self.faithful = None, cache_pieces, [], np.zeros(0, bool)
        self._forget()

    def _cuts(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = np.zeros(len(raw) + 1, bool)
        cut[1:-1] = ~self.joined[raw[:-1], raw[1:]] & (raw[1:] & 0xC0 != 0x80)
        cut[at] = True
        edges = np.flatnonzero(cut)
        return edges[:-1], edges[1:]

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # The library puts a space before what it is given: the piece's own, or one that a line feed cuts off.
        own = [x[:1] == b" " and len(x) > 1 for x in pieces]
        got = self.lib.encode([(x[1:] if o else b"\n" + x).decode("utf-8") for x, o in zip(pieces, own, strict=True)], num_threads=1)
        got = [x if o else x[self.lead:] for x, o in zip(got, own, strict=True)]
        return np.array([i for x in got for i in x], np.uint16), np.array([len(x) for x in got], np.int64)


def binary(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive runs of ``flat`` as a binary column."""
    width = flat.dtype.itemsize
    edge = np.concatenate([[0], np.cumsum(sizes)]) * width
    if edge[-1] >= 1 << 31:
        raise ValueError("a batch of ids over 2 GB: lower the Arrow batch size")
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(edge.astype(np.int32).tobytes()),
                                                          pa.py_buffer(flat.tobytes())])


def ids_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The reverse of :func:`binary` for 16-bit ids: (all ids, numbers)."""
    raw, at = tb.flat(column)
    return np.frombuffer(raw.tobytes(), np.uint16), np.diff(at) // 2
