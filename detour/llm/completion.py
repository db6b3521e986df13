"""Packing by bin completion: branch and bound over undominated fillings, with best-fit solutions as incumbents.

Every document becomes its ids and an end id; one longer than the window is cut into full windows and a rest. What is packed are
the pieces' lengths, and of these only the number of each counts: the search sees at most WINDOW numbers, whatever the
table holds, and its plan is a list of fillings (how many pieces of which length share a window) with how often each is used.
A piece then finds its place by its number among those of its length, which is a distributed prefix sum. The same search
runs for any number of documents; neither lengths nor documents are gathered.

A node of the search takes the longest piece left and enumerates the fillings of the room beside it: of two fillings one is
dominated if its pieces fit into the places of the other's, and is left out. A filling is used as often as the numbers
allow, or once. A branch is pruned if its waste so far, or the lower bound (Martello and Toth's L2) of the rest, leaves
no way below the incumbent; the best-fit-decreasing solution of the rest makes the next incumbent. The search ends where the
incumbent meets the lower bound of the whole, hence is optimal, or after ``NODES`` nodes; where a node has more than
``FILLINGS`` fillings, the ``WIDTH`` of least waste among those of up to three more pieces (after a greedy
beginning) are tried. So the result is never worse than best fit, and proven optimal when it meets the bound.

Null and empty texts hold the end id alone; repeated rows are packed each; an empty table gives no rows; other columns
aren't read.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from detour.llm import common, tokens

WINDOW = 2048
NODES = 200
FILLINGS = 300
WIDTH = 6

Filling = tuple[tuple[int, int], ...]  # (length, how many), falling
Plan = list[tuple[Filling, int]]       # how many windows hold it


def best_fit(counts: np.ndarray, size: int) -> Plan:
    """Best fit decreasing, all pieces of one length at a time: each goes to the window with the least room for it."""
    open_: list[tuple[int, Filling, int]] = []  # (room, filling, windows), by room
    for s in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[s])
        while left:
            at = bisect.bisect_left(open_, (s,))
            room, filling, n = open_.pop(at) if at < len(open_) else (size, (), left)
            k = room // s  # a window that has got one is still the fullest with room for the next
            whole = min(n, left // k)
            if whole:
                bisect.insort(open_, (room - k * s, (*filling, (s, k)), whole))
            left, n = left - whole * k, n - whole
            if left and not whole:
                bisect.insort(open_, (room - left * s, (*filling, (s, left)), 1))
                left, n = 0, n - 1
            if n and filling:
                bisect.insort(open_, (room, filling, n))
    return [(filling, n) for _, filling, n in open_]


def windows(plan: Plan) -> int:
    return sum(n for _, n in plan)


def lower_bound(counts: np.ndarray, size: int) -> int:
    """Windows that any packing needs: the greatest of the total length's and of L2, over all thresholds."""
    total = counts * np.arange(len(counts))
    n, t = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(total)])
    k = np.arange(size // 2 + 1)
    large, middle = n[-1] - n[size - k + 1], n[size - k + 1] - n[size // 2 + 1]
    free = middle * size - (t[size - k + 1] - t[size // 2 + 1])
    small = t[size // 2 + 1] - t[k]
    return max(-(-int(total.sum()) // size), int((large + middle + np.maximum(0, -(-(small - free) // size))).max()))


def _fits(pieces: list[int], places: list[int]) -> bool:
    """Whether the pieces (falling) can be put into the places."""
    if not pieces:
        return True
    for i in sorted(range(len(places)), key=places.__getitem__):
        if places[i] >= pieces[0]:
            rest = places.copy()
            rest[i] -= pieces[0]
            if _fits(pieces[1:], rest):
                return True
    return False


def _pieces(filling: Filling) -> list[int]:
    return [s for s, n in filling for _ in range(n)]


def _undominated(fillings: list[Filling]) -> list[Filling]:
    """By rising waste, then by the number of pieces; what an earlier one dominates is left out (long ones are not compared)."""
    kept: list[Filling] = []
    for f in sorted(set(fillings), key=lambda f: (-sum(s * n for s, n in f), sum(n for _, n in f), f)):
        own = _pieces(f)
        if len(own) > 6 or not any(len(p := _pieces(k)) <= 6 and _fits(own, p) for k in kept):
            kept.append(f)
    return kept


def _every(lengths: list[int], counts: np.ndarray, room: int, limit: int) -> list[Filling] | None:
    """All fillings of ``room`` to which nothing can be added; None if there are more than ``limit``."""
    found: list[Filling] = []

    def add(at: int, left: int, skipped: int, so_far: Filling) -> bool:
        while at < len(lengths) and lengths[at] > left:
            at += 1
        if at == len(lengths):
            if skipped > left:  # else the shortest piece that was left out fits
                found.append(so_far)
            return len(found) <= limit
        s, most = lengths[at], min(int(counts[lengths[at]]), left // lengths[at])
        for n in range(most, -1, -1):
            short = min(skipped, s) if n < counts[s] else skipped
            if n < most and short <= left - n * s - sum(lengths[at + 1:]):
                continue  # even all that follows leaves room for one that was left out
            if not add(at + 1, left - n * s, short, (*so_far, (s, n)) if n else so_far):
                return False
        return True

    return found if len(lengths) <= FILLINGS and add(0, room, 1 << 30, ()) else None


def completions(counts: np.ndarray, room: int) -> list[Filling]:
    """Undominated fillings of ``room`` by the pieces of ``counts``, by rising waste."""
    lengths = np.flatnonzero(counts[:room + 1])[::-1].tolist()
    if not lengths:
        return [()]
    if counts[room]:
        return [((room, 1),)]  # dominates all others
    if (found := _every(lengths, counts, room, FILLINGS)) is not None:
        return _undominated(found)
    counts, begun, left = counts.copy(), [], room
    for s in lengths:  # a greedy beginning, until three more pieces can fill the rest
        if s > left or left < 4 * s:
            break
        n = min(int(counts[s]), left // s - 2)
        begun.append((s, n))
        counts[s] -= n
        left -= n * s
    some = np.flatnonzero(counts[:left + 1])
    under = np.maximum.accumulate(np.where(counts[:left + 1] > 0, np.arange(left + 1), 0))  # the longest piece that fits
    if not len(some):
        return [tuple(begun)]
    tried = [(int(some[-1]),)]
    b = under[np.minimum(some, left - some)]
    tried += _least(left, some, b)
    for a in some[np.unique(np.linspace(0, len(some) - 1, 64).astype(int))].tolist():
        second = some[some <= min(a, left - a)]
        tried += [(a, *x) for x in _least(left - a, second, under[np.minimum(second, left - a - second)])]
    out = []
    for lengths_ in tried:
        size, n = np.unique([x for x in lengths_ if x], return_counts=True)
        if (n <= counts[size]).all():
            own = dict(begun)
            for s, k in zip(size.tolist(), n.tolist(), strict=True):
                own[s] = own.get(s, 0) + k
            out.append(tuple(sorted(own.items(), reverse=True)))
    return _undominated(out)[:WIDTH] or [tuple(begun)]


def _least(room: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """The pairs that waste least."""
    best = np.argsort(room - a - b, kind="stable")[:WIDTH]
    return list(zip(a[best].tolist(), b[best].tolist(), strict=True))


def search(counts: np.ndarray, size: int = WINDOW, nodes: int = NODES) -> Plan:
    """A plan that packs ``counts[s]`` pieces of each length s into as few windows as it can."""
    counts = counts.astype(np.int64)
    bound, best, seen = lower_bound(counts, size), best_fit(counts, size), 0
    fewest = windows(best)
    stack: list[tuple[np.ndarray, Filling, int, int, tuple | None]] = [(counts, (), 0, 0, None)]
    while stack and seen < nodes and fewest > bound:
        before, filling, n, used, plan = stack.pop()  # a plan is (its last filling, windows, the plan before)
        counts = before.copy()
        for s, k in filling:
            counts[s] -= k * n
        used, seen = used + n, seen + 1
        plan = (filling, n, plan) if n else plan
        spare = (fewest - 1 - used) * size - int((counts * np.arange(size + 1)).sum())  # waste that is left for a better plan
        if spare < 0 or used + lower_bound(counts, size) >= fewest:
            continue
        own = best_fit(counts, size)
        if used + windows(own) < fewest:
            fewest, best, at = used + windows(own), own, plan
            while at:
                best, at = [*best, (at[0], at[1])], at[2]
            spare -= size
        if not counts.any():
            continue
        longest = int(np.flatnonzero(counts)[-1])
        counts[longest] -= 1
        fillings = completions(counts, size - longest)
        counts[longest] += 1
        for f in reversed(fillings):
            if size - longest - sum(s * k for s, k in f) <= spare:
                need = dict(f)
                need[longest] = need.get(longest, 0) + 1
                whole = tuple(sorted(need.items(), reverse=True))
                most = min(int(counts[s]) // k for s, k in whole)
                stack += [(counts, whole, times, used, plan) for times in sorted({1, most})]
    return best


PIECE = "doc_id long, row long, piece long, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, window: int, literals: bool) -> DataFrame:
    """A row for each piece of each document, with the digest of its ids; the ids themselves go no further."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokens.tokenizer(tokenizer, True, literals)
        for b in batches:
            for lo, hi, ids, sizes in tok.slices(b.column(2), end_id):
                n = -(-sizes // window)
                of = np.repeat(np.arange(hi - lo), n)
                piece = tokens.runs(np.zeros(hi - lo, np.int64), n)
                start = piece * window
                length = np.minimum(sizes[of] - start, window)
                raw, edge = memoryview(ids.astype("<u4")).cast("B"), (np.cumsum(sizes) - sizes)[of] + start
                crc = [zlib.crc32(raw[4 * s:4 * (s + k)]) for s, k in zip(edge.tolist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo).take(pa.array(of)), b.column(1).slice(lo, hi - lo).take(pa.array(of)),
                                                  pa.array(piece), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                                                 names=[c.split()[0] for c in PIECE.split(", ")])

    common.python_tasks(docs.sparkSession)
    return docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text").mapInArrow(cut, PIECE)


class Places:
    """Of the pieces of one length, numbered from 0, the window and the place in it of each."""

    def __init__(self, plan: Plan, size: int):
        first, found = np.zeros(size + 1, np.int64), []
        sequence = 0
        for filling, n in plan:
            offset = 0
            for s, k in filling:
                found.append((s, first[s], k, sequence, offset))
                first[s] += n * k
                offset += s * k
            sequence += n
        self.runs = np.array(sorted(found), np.int64).reshape(-1, 5)
        self.key = self.runs[:, 0] << 44 | self.runs[:, 1]

    def of(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset)"""
        _, first, k, sequence, offset = self.runs[np.searchsorted(self.key, length << 44 | number, "right") - 1].T
        return sequence + (number - first) // k, offset + (number - first) % k * length


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, window: int = WINDOW, literals: bool = True, nodes: int = NODES) -> DataFrame:
    """(doc_id, row, piece, start, length, ids_crc32, sequence_id, offset) of every piece of ``docs``; ``row`` tells rows
    that share a doc_id apart."""
    spark, path = docs.sparkSession, common.scratch(docs.sparkSession, "completion")
    found = common.written(pieces(docs, tokenizer, end_id, window, literals), f"{path}/pieces")  # a range's bounds are sampled first
    dealt = common.ranged(found, ["length", "row", "piece"], f"{path}/ranges")
    counts = np.zeros(window + 1, np.int64)
    for r in dealt.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # a row for each length up to the window
        counts[r["length"]] = r["n"]
    places = Places(search(counts, window, nodes), window)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = places.of(b.column("length").to_numpy(), b.column("number").to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sequence), pa.array(offset)], names=[*b.schema.names[:-1], "sequence_id", "offset"])

    numbered = common.prefix_sums(dealt, ["row", "piece"], {"number": F.lit(1).cast("long")}, group=["length"])
    cols = [c.split()[0] for c in PIECE.split(", ")]
    return numbered.select(*cols, "number").mapInArrow(put, f"{PIECE}, sequence_id long, offset long")
