"""A Merkle tree over a dataset, with every row's proof, by butterfly exchange.

Rows are leaves: the sha256 of their fields. Each group's leaves, in order, are cut into aligned blocks of FANOUT**LEVELS;
a block is a group of one task, which hashes its own subtree and the lower part of its rows' proofs. Blocks are then
numbered 0, 1, ... and a round deals with one base-FANOUT digit of that number: the blocks that differ in this digit alone
swap the roots they hold, and each hashes them to their common ancestor, so that all of them hold it, with the
siblings on the way. After as many rounds as the number has digits every block holds the root and the
whole upper proof: nothing is sent down again. A run at the end of a level may be short; the places of its missing blocks are
filled by stand-ins, which the round's senders create, so that later rounds find a holder at each place. A stand-in
holds an ancestor and no rows; there are fewer than FANOUT places for each block. A round is one shuffle of blocks, not of rows.

The groups' roots, in order of the groups, are the leaves of a tree on top, which is built in the same way.

Nulls in any field have a mark of their own; a null group comes first; rows that share group and key are ordered by their leaf and
are leaves of their own; one leaf alone is its group's root, one group alone the dataset's; an empty table gives
no rows; columns that aren't named don't count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from detour.llm import common

FANOUT = 3
LEVELS = 6         # of a block's own subtree: 729 leaves
BLOCK_BYTES = 4000  # of a block's root and path, in a broadcast table

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<l:string,r:string>>"  # for each level the siblings to the left and to the right, joined


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of a row's fields, each as its number of UTF-8 bytes, a colon and the value, or ``-`` for null."""
    parts = []
    for c in fields:
        text = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def subtree(digests: list[str], levels: int | None, fanout: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """(root, for each leaf its siblings (left, right), level by level) after ``levels`` levels, or, if that is None, as
    many as it takes to come down to one node."""
    paths: list[list[tuple[str, str]]] = [[] for _ in digests]
    nodes, width, level = digests, 1, 0
    while level != levels and (levels is not None or len(nodes) > 1):
        runs = [nodes[i:i + fanout] for i in range(0, len(nodes), fanout)]
        for i, path in enumerate(paths):
            run, at = runs[i // width // fanout], i // width % fanout
            path.append(("".join(run[:at]), "".join(run[at + 1:])))
        nodes = [hashlib.sha256("".join(run).encode()).hexdigest() for run in runs]
        width, level = width * fanout, level + 1
    return nodes[0], paths


def _blocks(leaves: DataFrame, levels: int, fanout: int) -> DataFrame:
    """``leaves`` with ``below``, the path up to the root of each one's block, and that root as ``node`` at the first of the block."""
    rest = [f for f in leaves.schema.fields if f.name != "position"]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("position")
        node, paths = subtree(table["leaf"].to_pylist(), None if table["n_blocks"][0].as_py() == 1 else levels, fanout)
        below = pa.array([[{"l": left, "r": right} for left, right in path] for path in paths],
                         pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())])))
        return pa.table([*[table[f.name] for f in rest], below, pa.array([node] + [None] * (len(table) - 1), pa.string())],
                        names=[*[f.name for f in rest], "below", "node"])

    schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in rest], f"below {PATH}", "node string"])
    return leaves.groupBy("group_", "block").applyInArrow(run, schema)


def butterfly(blocks: DataFrame, path: str, fanout: int = FANOUT) -> DataFrame:
    """(group_, block, root, path) of every block of every group, given (group_, block, n_blocks, node): the root of
    the group's nodes, and the siblings on the way there."""
    held = common.written(blocks.select("group_", "block", "n_blocks", "node", F.array().cast(PATH).alias("path")), f"{path}/round0")
    most = held.agg(F.coalesce(F.max("n_blocks"), F.lit(0))).first()[0]
    done, step, turn = [], 1, 0
    while True:
        done.append(held.where(F.col("n_blocks") <= step).where(F.col("block") < F.col("n_blocks")))  # without stand-ins
        if step >= most:
            break
        turn += 1
        held = common.written(_swapped(held.where(F.col("n_blocks") > step), step, fanout), f"{path}/round{turn}")
        step *= fanout
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("group_", "block", F.col("node").alias("root"), "path")


def _swapped(held: DataFrame, step: int, fanout: int) -> DataFrame:
    """One round: the holders whose numbers differ in the digit of weight ``step`` alone swap their nodes and hash them.

    A holder sends to all FANOUT places, whether there is a block or not."""
    def digit(block: Column) -> Column:
        return F.pmod(F.floor(block / F.lit(step)), F.lit(fanout)).cast("long")

    block = F.col("block")
    first = block - digit(block) * F.lit(step)
    sent = held.withColumn("to", F.explode(F.transform(F.sequence(F.lit(0), F.lit(fanout - 1)), lambda d: first + d * F.lit(step))))
    got = sent.groupBy("group_", F.col("to").alias("block"), "n_blocks").agg(
        F.sort_array(F.collect_list(F.struct(digit(block).alias("digit"), "node"))).alias("run"),
        F.max(F.when(F.col("to") == block, F.col("path"))).alias("path"))

    def nodes(keep) -> Column:
        return F.array_join(F.transform(F.filter("run", keep), lambda x: x["node"]), "")
    at = digit(F.col("block"))
    sibling = F.struct(nodes(lambda x: x["digit"] < at).alias("l"), nodes(lambda x: x["digit"] > at).alias("r"))
    path = F.concat(F.coalesce("path", F.array().cast(PATH)), F.array(sibling))
    return got.select("group_", "block", "n_blocks", F.sha2(nodes(lambda x: F.lit(True)).cast("binary"), 256).alias("node"), path.alias("path"))


def tree(leaves: DataFrame, order: Sequence[str], path: str, levels: int, fanout: int) -> tuple[DataFrame, DataFrame]:
    """(``leaves`` with block and below; (group_, block, root, path)) of ``leaves`` (group_, leaf, ...), ordered by ``order`` in
    their group."""
    dealt = common.ranged(leaves, ["group_", *order], f"{path}/ranges")
    sizes = dealt.groupBy(F.col("group_").alias("g_")).agg(F.count(F.lit(1)).alias("n_leaves"))
    placed = common.prefix_sums(dealt, list(order), {"position": F.lit(1).cast("long")}, group=["group_"])
    placed = placed.join(common.broadcast_if_small(sizes, 300), F.col("group_").eqNullSafe(F.col("g_"))).drop("g_", "pid")
    size = F.lit(fanout**levels)
    placed = placed.withColumns({"block": F.floor(F.col("position") / size).cast("long"),
                                 "n_blocks": F.ceil(F.col("n_leaves") / size).cast("long")}).drop("n_leaves")
    rows = common.written(_blocks(placed, levels, fanout), f"{path}/rows")
    return rows.drop("node", "n_blocks"), butterfly(rows.where(F.col("node").isNotNull()), path, fanout)


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "source", fields: Sequence[str] = FIELDS,
             other: Sequence[Column] | None = None, levels: int = LEVELS, fanout: int = FANOUT) -> DataFrame:
    """(key, leaf, subroot, root, path, other_root) of every row of ``docs``: the root of its group and of all, the siblings on
    the way, and what the values ``other``, in place of the row's ``fields``, lead to with these siblings."""
    spark, path = docs.sparkSession, common.scratch(docs.sparkSession, "merkle")
    common.python_tasks(spark)
    own = [F.col(f"`{c}`") for c in fields]
    slim = docs.select(F.col(f"`{key}`").alias("key_"), F.col(f"`{group}`").cast("string").alias("group_"), leaf(own).alias("leaf"),
                       leaf(other if other is not None else own).alias("other"))
    rows, tops = tree(common.written(slim, f"{path}/leaves"), ["key_", "leaf"], f"{path}/rows", levels, fanout)

    groups = tops.where("block = 0").select(F.lit("").alias("group_"), F.col("group_").alias("member"), F.col("root").alias("leaf"))
    over, top = tree(groups, ["member"], f"{path}/groups", levels, fanout)
    top = top.select(F.col("block").alias("b_"), F.col("root").alias("whole"), F.col("path").alias("upper"))
    above = over.join(common.broadcast_if_small(top, BLOCK_BYTES), F.col("block") == F.col("b_")).select(
        F.col("member").alias("m_"), F.concat("below", "upper").alias("above"), "whole")
    tops = tops.join(common.broadcast_if_small(above, BLOCK_BYTES), F.col("group_").eqNullSafe(F.col("m_"))).select(
        F.col("group_").alias("g_"), F.col("block").alias("b_"), F.col("root").alias("subroot"), F.concat("path", "above").alias("upper"), F.col("whole").alias("root"))
    tops = common.written(tops, f"{path}/tops")

    found = rows.join(common.broadcast_if_small(tops, BLOCK_BYTES), F.col("group_").eqNullSafe(F.col("g_")) & (F.col("block") == F.col("b_")))
    found = found.withColumn("path", F.concat("below", "upper"))
    return found.select(F.col("key_").alias(key), "leaf", "subroot", "root", "path", folded(F.col("other")).alias("other_root"))


def folded(start: Column, path: str = "path") -> Column:
    """The root that a digest leads to with the siblings of ``path``."""
    return F.aggregate(F.col(path), start, lambda h, x: F.sha2(F.concat(x["l"], h, x["r"]).cast("binary"), 256))


def proof_digest(path: str = "path") -> Column:
    """The sha256 of all siblings."""
    return F.sha2(F.array_join(F.transform(F.col(path), lambda x: F.concat(x["l"], x["r"])), "").cast("binary"), 256)
