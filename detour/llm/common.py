"""Tables, scratch folders, bounded broadcasts and distributed prefix sums."""

from __future__ import annotations

import ctypes
import gc
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import detour
from detour.llm import tokens
from detour.session import fresh_path

# Arrow batches of documents stay small whatever the row count: texts may be long.
ARROW_ROWS = 1000
ARROW_BYTES = 8 << 20

# A broadcast side is hinted only when its counted rows times their stated width fit here.
MAX_BROADCAST_BYTES = 64 << 20


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def python_tasks(spark: SparkSession) -> None:
    """Before Python runs in tasks: bound what one Arrow batch holds, and send this package
    to the workers (once a context), as ``--py-files`` would."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    sc = spark.sparkContext
    if not getattr(sc, "_detour_sent", False):
        package = os.path.dirname(os.path.abspath(detour.__file__))
        sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), "detour_package"), "zip",
                                         os.path.dirname(package), os.path.basename(package)))
        sc._detour_sent = True


def _give_back() -> None:
    """Return to the system what the worker has freed: allocators keep it otherwise, and workers live on."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def lean(work: Work, tokenizes: bool = False) -> Work:
    """``work`` for ``mapInArrow`` in a worker that holds little between tasks. Tokenizers and their caches of pieces, which
    earlier steps may have left in the worker, go unless ``work`` ``tokenizes``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not tokenizes:
            tokens.forget()
            _give_back()
        try:
            yield from work(batches)
        finally:
            _give_back()
    return run


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables below ``spark.checkpoint.dir``."""
    return fresh_path(spark, "llm", name)


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: cuts the lineage, survives lost executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, row_bytes: int, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only if the counted rows times ``row_bytes`` fit ``max_bytes``;
    otherwise the planner is left to shuffle. The result is the same either way."""
    limit = max_bytes // row_bytes
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def ranged(df: DataFrame, order: Sequence, path: str, pid: str = "pid") -> DataFrame:
    """``df`` dealt into ranges of ``order`` and written with the number of its range.

    Ranges ascend with ``order``; equal rows share a range. Written, because the sampled
    bounds of a range partitioning are not to be drawn twice.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(df.repartitionByRange(n, *order).withColumn(pid, F.spark_partition_id()), path)


def prefix_sums(df: DataFrame, order: Sequence, sums: dict[str, Column], group: Sequence[str] = (),
                pid: str = "pid", tie: str = "tie_") -> DataFrame:
    """Add, for each ``name: value``, the sum of ``value`` over all rows of the same
    ``group`` that come earlier in ``order``; ``df`` comes from :func:`ranged`.

    A window adds up inside one range; the ranges' totals (one row for each group and
    range) give every range its offset. So no group is gathered into one task, however
    many rows it holds; rows that are equal in ``order`` keep any order among themselves.
    """
    group = list(group)
    inside = Window.partitionBy(*group, pid).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*group).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*group, pid).agg(*[F.sum(v).alias(f"{n}_t") for n, v in sums.items()])
    offsets = totals.select(*[F.col(g).alias(f"{g}_o") for g in group], F.col(pid).alias(f"{pid}_o"),
                            *[F.coalesce(F.sum(f"{n}_t").over(before), F.lit(0)).alias(f"{n}_b") for n in sums])
    on = F.lit(True)
    for c in [*group, pid]:
        on = on & F.col(c).eqNullSafe(F.col(f"{c}_o"))
    out = df.withColumns({f"{n}_i": F.coalesce(F.sum(v).over(inside), F.lit(0)) for n, v in sums.items()})
    out = out.join(offsets, on, "left").withColumns({n: F.col(f"{n}_i") + F.col(f"{n}_b") for n in sums})
    drop = [f"{n}{s}" for n in sums for s in ("_i", "_b")] + [f"{c}_o" for c in [*group, pid]]
    return out.drop(*drop)


def neutral(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns called c0_, c1_, ... and {new name: old name}: nothing that an operator adds can
    clash with what the columns are called."""
    names = {f"c{i}_": c for i, c in enumerate(df.columns)}
    return df.toDF(*names), names


def restored(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(n).alias(c) for n, c in names.items()])


def located(docs: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The columns of ``docs``, read straight from files, and ``at_``: each row's file and row number there."""
    meta = docs.metadataColumn("_metadata")
    return docs.select(*(docs.columns if columns is None else columns),
                       F.struct(meta["file_path"].alias("file"), meta["row_index"].alias("row")).alias("at_"))


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` (all columns) but the rows whose ``at_`` is in ``dropped``."""
    meta = docs.metadataColumn("_metadata")
    names = {f"c{i}_": c for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for n, c in names.items()], meta["file_path"].alias("file_"), meta["row_index"].alias("row_"))
    gone = dropped.select(F.col("at_.file").alias("file_"), F.col("at_.row").alias("row_"))
    return restored(rows.join(broadcast_if_small(gone, 150), ["file_", "row_"], "left_anti"), names)
