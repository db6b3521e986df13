"""URL filter: rules first, else a character language-model ratio.

Two variable-order Markov models of URL characters, one of URLs that the rules accept, one of those that
they reject, are smoothed by Witten-Bell interpolation from order ``ORDER`` down to a uniform
character: a context that a model never met hands over to the next shorter one. The
log-likelihood difference of a URL, divided by its number of characters, is compared with a
threshold calibrated on rule-labelled URLs (one of ``FOLDS`` by crc32) that
the models didn't see. Each distinct URL is learned and scored once.

A null URL is an empty one: no host, no path, no rule, judged by the model; repeated URLs get one
verdict; without URLs of both kinds the threshold is 0; an empty table gives no rows;
other columns aren't carried.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from detour.llm import common

ORDER = 4
FOLDS = 5
ALPHABET = 256
SCALE = 1_000_000   # log-likelihoods are added up as whole millionths: any order gives the same sum
BIN = 100           # calibration bins for each unit of the normalised difference, up to LIMIT on either side
LIMIT = 20
START, END = "\x02", "\x03"

Rule = tuple[str, str]  # (verdict, host and path such as ``net/es/``)


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path)"""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(verdict, rule) of the longest fitting rule, else null; ``rules`` is a bounded list."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, start = rule.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit(f".{domain}"))) & F.startswith(path, F.lit(slash + start))
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def grams(urls: DataFrame) -> DataFrame:
    """One row for each character of a URL and its end: the character behind its ORDER predecessors."""
    padded = F.concat(F.lit(START * ORDER), F.col("url"), F.lit(END))
    chars = urls.withColumn("chars", F.regexp_extract_all(padded, F.lit("(?s)."), F.lit(0)))
    return chars.select("uid", "label", "held", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("chars") - F.lit(ORDER)), lambda i: F.array_join(F.slice("chars", i, ORDER + 1), ""))).alias("gram"))


def ratios(counts: DataFrame, seen: DataFrame, path: str) -> DataFrame:
    """(gram, ratio): ln P_allow - ln P_block of the last character, for the grams of ``seen``;
    ``counts``: (gram, allow, block)."""
    total = counts.groupBy(F.right("gram", F.lit(1))).agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    sums = total.agg(*[F.coalesce(f(c), F.lit(0)).alias(c + n) for c in ("allow", "block")
                       for n, f in (("_n", F.sum), ("_t", lambda c: F.sum((F.col(c) > 0).cast("long"))))]).first()
    out = seen
    for order in range(ORDER + 1):
        size = order + 1
        cells = counts.groupBy(F.right("gram", F.lit(size)).alias("tail")).agg(F.sum("allow").alias("allow_c"), F.sum("block").alias("block_c"))
        cells = common.written(cells, f"{path}/cells{order}")
        out = out.withColumn("tail", F.right("gram", F.lit(size))).join(common.broadcast_if_small(cells, 60), "tail", "left")
        if order:
            contexts = cells.groupBy(F.expr(f"left(tail, {order})").alias("context")).agg(
                *[f(c).alias(f"{c}_{n}") for c in ("allow", "block")
                  for n, f in (("n", lambda c: F.sum(f"{c}_c")), ("t", lambda c: F.sum((F.col(f"{c}_c") > 0).cast("long"))))])
            contexts = common.written(contexts, f"{path}/contexts{order}")
            out = out.withColumn("context", F.expr(f"left(tail, {order})")).join(common.broadcast_if_small(contexts, 60), "context", "left")
        for c in ("allow", "block"):
            zero = F.lit(0).cast("long")
            n, t = (F.coalesce(f"{c}_n", zero), F.coalesce(f"{c}_t", zero)) if order else (F.lit(sums[f"{c}_n"]), F.lit(sums[f"{c}_t"]))
            lower = F.col(f"{c}_p") if order else F.lit(1.0 / ALPHABET)
            p = F.when(n > 0, (F.coalesce(f"{c}_c", zero) + t * lower) / (n + t)).otherwise(lower)
            out = out.withColumn(f"{c}_p", p)
        out = out.select("gram", "allow_p", "block_p")
    return out.select("gram", F.round(F.log(F.col("allow_p") / F.col("block_p")) * SCALE).cast("long").alias("ratio"))


def threshold(bins: Sequence[tuple[int, int, int]]) -> float:
    """Of (bin, accepted, rejected), ascending: the score below which to reject, with the best mean of
    both kinds' rates of right verdicts; the lowest such, in the middle of the empty bins there."""
    allow, block = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not allow or not block:
        return 0.0
    edge, best, kept, cut = bins[0][0], 1.0, allow, 0
    for b, a, r in bins:
        kept, cut = kept - a, cut + r
        if kept / allow + cut / block > best + 1e-12:
            edge, best = b + 1, kept / allow + cut / block
    after = min((b[0] for b in bins if b[0] >= edge), default=edge)
    return (edge + after) / 2 / BIN


def judge(pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict, score) of every row; score: the normalised difference, null under a rule."""
    spark, path = pages.sparkSession, common.scratch(pages.sparkSession, "urls")
    given = pages.select(F.col(key), common.text_or_empty(url).alias("url"))
    host, way = parts(F.col("url"))
    ruled = lambda df: (df.withColumns({"host": host, "path": way})
                        .withColumn("found", rule_of(F.col("host"), F.col("path"), rules)))
    distinct = ruled(given.select("url").distinct()).select(
        "url", F.col("found.verdict").alias("label"), (F.crc32(F.col("url").cast("binary")) % FOLDS == 0).alias("held"),
        F.monotonically_increasing_id().alias("uid"))
    urls = common.written(distinct, f"{path}/distinct")
    every = grams(urls)
    one = lambda v: F.sum((F.col("label") == v).cast("long")).alias(v)
    counts = common.written(every.where(F.col("label").isNotNull() & ~F.col("held")).groupBy("gram").agg(one("allow"), one("block")), f"{path}/counts")
    needed = every.where(F.col("label").isNull() | F.col("held"))
    table = common.written(ratios(counts, needed.select("gram").distinct(), path), f"{path}/ratios")
    scored = needed.join(common.broadcast_if_small(table, 60), "gram").groupBy("uid").agg(
        (F.sum("ratio") / F.lit(float(SCALE)) / F.count(F.lit(1))).alias("score"))
    scores = common.written(urls.join(scored, "uid"), f"{path}/scores")
    place = F.floor(F.least(F.greatest(F.col("score"), F.lit(-float(LIMIT))), F.lit(float(LIMIT))) * BIN)
    bins = scores.where("label is not null").groupBy(place.alias("bin")).agg(one("allow"), one("block")).orderBy("bin").collect()  # 2 * LIMIT * BIN rows at most
    limit = threshold([(r["bin"], r["allow"], r["block"]) for r in bins])
    open_ = scores.where("label is null").select(F.col("url").alias("url_"), "score")
    out = ruled(given).join(open_, F.col("url") == F.col("url_"), "left")
    return out.select(F.col(key), "host", "path", F.col("found.rule").alias("rule"), F.coalesce(
        F.col("found.verdict"), F.when(F.col("score") < limit, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "score")
