"""U2 that holds: write, audit, publish.

Tables are written first, where no reader looks. The written rows are checked against their keys; rows that break a key go
to a quarantine table, and the pointer that readers follow moves only if there are none. So a bad
load leaves the old snapshot current, and says which rows were at fault.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from detour.operators.graph import key_violations
from detour.operators.sizing import broadcast_if_bounded

QUARANTINE = "table string, reason string, row string"
LACKS_KEY, REPEATED = "lacks its key", "key occurs more than once"


class ConstraintViolation(ValueError):
    """Rows break a key; they are in the quarantine, and nothing was published."""


def audit(table: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that keep the key constraint, rows that break it, with their ``reason``): a key is never null and occurs once.

    Keys are counted with partial sums; a key that a third of the rows share isn't gathered, its rows are only met by
    the one row of its count."""
    bad = broadcast_if_bounded(key_violations(table, keys).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    lacks = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    broken = table.join(bad, same, "left_semi").withColumn("reason", F.when(lacks, F.lit(LACKS_KEY)).otherwise(F.lit(REPEATED)))
    return table.join(bad, same, "left_anti"), broken


def quarantine_rows(name: str, broken: DataFrame) -> DataFrame:
    """The broken rows of table ``name`` in the shape that all tables share: their content as text."""
    return broken.select(F.lit(name).alias("table"), "reason",
                         F.to_json(F.struct(*[c for c in broken.columns if c != "reason"]), {"ignoreNullFields": "false"}).alias("row"))


def audit_written(spark: SparkSession, tables: dict[str, tuple[DataFrame, list[str]]], quarantine: str) -> dict[str, int]:
    """Check written ``tables`` (name: table, key columns); write the rows that break a key to ``quarantine``; their number by
    table, for tables that have any."""
    parts = [quarantine_rows(name, audit(df, keys)[1]) for name, (df, keys) in tables.items()]
    reduce(DataFrame.unionByName, parts).write.parquet(quarantine)
    found = spark.read.schema(QUARANTINE).parquet(quarantine).groupBy("table").agg(F.count(F.lit(1)).alias("n"))
    return {r["table"]: r["n"] for r in found.collect()}  # a row a table


def require_clean(found: dict[str, int], quarantine: str) -> None:
    if found:
        raise ConstraintViolation(f"rows that break a key: {found}; see {quarantine}")
