"""Jump consistent hashing: a stable key and a shard count decide the shard, without a ring table.

The generator is a 64-bit linear congruential one, started from the first 64 bits of the
key's MD5; a step jumps from shard b to floor((b + 1) * 2^31 / (top 31 bits + 1)), and the last
jump below the shard count is the shard. One more shard only takes rows into itself.

A null key is hashed as the empty string, equal keys share a shard, a null text has no
bytes, an empty table gives no rows; columns of the input may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from detour.llm import common

# Fixed values of the published generator: next = key * 2862933555777941757 + 1 (mod 2^64).
MULTIPLIER = 2862933555777941757
_C0, _C1 = MULTIPLIER & 0x7FFFFFFF, MULTIPLIER >> 31
_M32 = 0xFFFFFFFF

# A key makes ln(n) jumps on average; more than this many has a chance below 10^-70 at a million shards.
MAX_JUMPS = 128


def _next(hi: Column, lo: Column) -> tuple[Column, Column]:
    """The generator's step on 32-bit halves: every product stays below 2^63."""
    m = F.lit(_M32)
    a, b, c = lo * F.lit(_C0), lo * F.lit(_C1), hi * F.lit(_C0)
    d = (hi * F.lit(_C1)).bitwiseAND(F.lit(1))
    low = a.bitwiseAND(m) + F.shiftleft(b, 31).bitwiseAND(m) + F.lit(1)
    high = (F.shiftright(a, 32) + F.shiftright(b, 1).bitwiseAND(m) + c.bitwiseAND(m)
            + F.shiftleft(d, 31) + F.shiftright(low, 32))
    return high.bitwiseAND(m), low.bitwiseAND(m)


def jump_shard(key: Column, shards: int) -> Column:
    """The shard, 0 to ``shards`` - 1, of a key of any type."""
    if shards < 1:
        raise ValueError("at least one shard")
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    word = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("long")
    start = F.struct(word(1).alias("hi"), word(9).alias("lo"), F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(s: Column, _: Column) -> Column:
        hi, lo = _next(s["hi"], s["lo"])
        # top 31 bits of the 64 are the high half without its last bit
        jump = F.floor((s["j"] + F.lit(1)) * (F.lit(float(1 << 31)) / (F.shiftright(hi, 1) + F.lit(1)))).cast("long")
        return F.when(s["j"] >= F.lit(shards), s).otherwise(
            F.struct(hi.alias("hi"), lo.alias("lo"), s["j"].alias("b"), jump.alias("j")))

    end = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, MAX_JUMPS))), start, step)
    if shards > MAX_JUMPS:
        return F.when(F.assert_true(end["j"] >= F.lit(shards), F.lit("more jumps than MAX_JUMPS")).isNull(), end["b"]).cast("int")
    return end["b"].cast("int")


def shard_rows(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) of every row.

    ``slot`` numbers a shard's rows without gaps: the slim rows are dealt into ranges of
    (shard, key), numbered inside a range, and moved by the ranges' totals. ``row`` splits even
    rows that share one key.
    """
    utf8 = common.text_or_empty(text).cast("binary")
    slim = docs.select(
        F.col(key), (F.length(utf8) + F.lit(1)).cast("long").alias("size"), F.crc32(utf8).alias("text_crc32"),
        F.lit("key").alias("law"), jump_shard(F.col(key), shards).alias("shard"),
        jump_shard(F.col(key), shards + 1).alias("grown_shard"))
    path = common.scratch(docs.sparkSession, "shard_rows")
    rows = common.written(slim.withColumn("row", F.monotonically_increasing_id()), f"{path}/rows")
    order = ["shard", key, "row"]
    dealt = common.ranged(rows, order, f"{path}/ranges")
    return (common.prefix_sums(dealt, order, {"slot": F.lit(1).cast("long")}, group=["shard"])
            .select(key, "size", "text_crc32", "law", "shard", "slot", "grown_shard"))
