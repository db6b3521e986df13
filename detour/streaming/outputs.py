"""R2: several outputs of one micro-batch, under one checkpoint.

A batch is read from the source once, kept while its outputs are written, and each output overwrites its own
(run_id, batch_id) partition. If the job dies between two outputs, the batch is replayed and both are written again: each
output holds each batch once, whichever of them were there already. Files of a partition aren't rewritten in place, so readers that
want whole batches read up to the last one the checkpoint has committed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from detour.streaming.sink import write_batch

Output = Callable[[DataFrame, int], DataFrame]  # of the batch and its number: the rows to write, without batch_id


class BatchOutputs:
    """A ``foreachBatch`` function: ``outputs`` are (path, rows of the batch), written in this order. ``prepare`` is
    what they share; its result is kept (in memory, or on disk where that is short) until the last is written."""

    def __init__(self, outputs: list[tuple[str, Output]], run_id: str, prepare: Callable[[DataFrame], DataFrame] | None = None):
        self.outputs, self.run_id, self.prepare = outputs, run_id, prepare

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        shared = (self.prepare(batch) if self.prepare else batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for path, rows in self.outputs:
                write_batch(rows(shared, batch_id).withColumn("batch_id", F.lit(int(batch_id)).cast("long")), path, self.run_id)
        finally:
            shared.unpersist()
