"""Vectorised words and hashes over the bytes of an Arrow string column (numpy, in tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
CHUNK_DOCS = 4096

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, hence invertible modulo 2**64
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

# Words: digits, letters (A-Z folded to a-z) and every byte from 0x80 on; other bytes separate.
FOLD = np.zeros(256, np.uint8)
FOLD[48:58] = np.arange(48, 58)
FOLD[65:91] = np.arange(97, 123)
FOLD[97:123] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit values that scatters them."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def uniform(x: np.ndarray) -> np.ndarray:
    """Hashes to numbers in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for i, b in enumerate((_BASE, _BASE_INV)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _POWERS[i] = np.multiply.accumulate(p)
    return _POWERS[0][:n], _POWERS[1][:n]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) in pieces of about ``CHUNK_BYTES``: whole
    texts, at least one a piece, so that what numpy holds at a time doesn't follow the batch."""
    raw, at = flat(column)
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = int(np.searchsorted(at, at[lo] + CHUNK_BYTES, "right")) - 1
        hi = min(max(hi, lo + 1), lo + CHUNK_DOCS, n)
        yield lo, hi, raw[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]
        lo = hi


class Spans:
    """64-bit hashes of byte spans [start, end), all from one prefix sum over the bytes."""

    def __init__(self, codes: np.ndarray):
        up, self.down = _powers(len(codes) + 1)
        self.total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:len(codes)], out=self.total[1:])

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.total[ends] - self.total[starts]) * self.down[starts]
        return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return Spans(codes).hash(starts, ends) if len(starts) else np.zeros(0, np.uint64)


_PRIMES = (2**31 - 1, 2**31 - 19)
_BASES = (1_103_515_245, 1_664_525_291)
_PRIME_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _powers_modulo(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), prime)) % np.uint64(prime)])
    return out[:n]


def prime_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte spans from polynomials modulo two primes. Unlike :class:`Spans`, whose modulus is a power of two, no
    regular pattern of bytes makes spans collide; for keys that aren't compared with their bytes."""
    n = len(codes) + 1
    if not _PRIME_POWERS or len(_PRIME_POWERS[0][0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        _PRIME_POWERS[:] = [(_powers_modulo(b, p, size), _powers_modulo(pow(b, -1, p), p, size)) for b, p in zip(_BASES, _PRIMES, strict=True)]
    both = []
    for (up, down), prime in zip(_PRIME_POWERS, map(np.uint64, _PRIMES), strict=True):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:n - 1] % prime)])
        both.append((total[ends] - total[starts]) % prime * down[starts] % prime)
    return mix((both[0] << np.uint64(31) | both[1]) ^ (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_spans(raw: np.ndarray, at: np.ndarray, fold: np.ndarray = FOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(folded bytes, start, end, count by document) of the words, in the order of the text."""
    codes = fold[raw]
    inside = codes != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = at[(at > 0) & (at < len(raw))]  # words end where documents do
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return codes, starts, ends, np.diff(np.searchsorted(starts, at))


def words(raw: np.ndarray, at: np.ndarray, fold: np.ndarray = FOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end, count by document) of the words, in the order of the text."""
    codes, starts, ends, counts = word_spans(raw, at, fold)
    return span_hashes(codes, starts, ends), starts, ends, counts


def by_document(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The sums of ``values`` between consecutive offsets (0 where nothing is between)."""
    total = np.concatenate([np.zeros(1, np.float64), np.cumsum(values, dtype=np.float64)])
    return total[at[1:]] - total[at[:-1]]


def run_hashes(h: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, count by document) of the runs of ``k`` consecutive words inside a document;
    a document of fewer words, but not none, has one run of all its words."""
    n = len(h)
    short = (counts > 0) & (counts < k)
    doc_of = np.repeat(np.arange(len(counts)), counts)
    begin = np.cumsum(counts) - counts
    runs = np.maximum(counts - k + 1, 0)
    runs[short] = 1
    place = np.arange(n) - begin[doc_of]
    keep = place < runs[doc_of]
    size = np.minimum(counts, k)[doc_of]
    acc = np.zeros(n, np.uint64)
    for j in range(k):
        part = mix(h + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        if j:
            part = np.concatenate([part[j:], np.zeros(min(j, n), np.uint64)])[:n]
        acc += np.where(size > j, part, np.uint64(0))
    return mix(acc)[keep], runs
