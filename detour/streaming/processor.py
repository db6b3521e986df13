"""The alert stream: broker records -> disrupted events -> alerts per micro-batch.

R1 parse and filter are the batch functions applied to a streaming DataFrame.
R2 ``foreachBatch`` joins each batch with the current per-line options snapshot
(resolved every batch through an append-only pointer table, so a re-seeded graph
is picked up without restarting the stream) and writes through the replay-safe
sink. R3 trigger, R4 checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from detour.operators.alerts import build_alerts
from detour.operators.parse import disrupted, parse_records, rejected
from detour.operators.sizing import MAX_BROADCAST_ROWS, row_count_at_most
from detour.fixed import BROKER_TIME_COLUMN, TRIGGER_INTERVAL
from detour.params import DEFAULT, Params
from detour.schemas import STATUS_EVENT
from detour.streaming.outputs import BatchOutputs
from detour.streaming.partials import batch_partials
from detour.streaming.sink import write_batch

RAW = "raw_value"

DEFAULT_TRIGGER = {"processingTime": TRIGGER_INTERVAL}


def disrupted_stream(records: DataFrame, schema=STATUS_EVENT, processed_at: Column | None = None) -> DataFrame:
    """Broker records -> parsed, disrupted, time-stamped events."""
    return disrupted(parse_records(records, schema), processed_at)


POINTER = "_versions"


def write_options_snapshot(options: DataFrame, path: str) -> str:
    """Materialise the per-line options (one row per line) that every batch joins. A snapshot
    never changes: an existing folder is refused, a new version needs a new one."""
    options.hint("rebalance").write.mode("errorifexists").parquet(path)
    return path


def publish_snapshot(spark: SparkSession, root: str, snapshot_path: str) -> None:
    """Make ``snapshot_path`` the current options for streams reading ``root``.

    Appends (version, path) to an append-only pointer table under ``root``: a new
    file becomes visible at job commit, old rows never change, so a reader sees
    either the previous or the new snapshot, never a half-written one."""
    (spark.createDataFrame([(snapshot_path,)], "path string")
          .select(F.unix_micros(F.current_timestamp()).alias("version"), "path")
          .coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/{POINTER}"))


def current_snapshot(spark: SparkSession, path: str) -> str:
    """``path`` itself, or, when it is a root with a pointer table, the newest
    published snapshot (one row read, per batch)."""
    try:
        ptr = spark.read.parquet(f"{path.rstrip('/')}/{POINTER}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":   # only an absent table means "no pointer"
            raise
        return path
    row = ptr.orderBy(F.col("version").desc(), F.col("path").desc()).select("path").first()
    return row[0] if row else path


class AlertBatchWriter:
    """R2: the ``foreachBatch`` function. One write action per batch; nothing is
    collected to the driver."""

    def __init__(self, options_path: str, history_path: str, run_id: str, p: Params = DEFAULT,
                 keep: list[str] | None = None, fmt: str = "parquet", partials_path: str | None = None,
                 ties: list[str] | None = None):
        self.options_path = options_path
        self.history_path = history_path
        self.run_id = run_id
        self.p = p
        self.keep = keep or []
        self.fmt = fmt                             # "delta" where its jar is on the classpath
        self.partials_path = partials_path         # for reports that read no alert (a second replay-safe write)
        self.ties = ties or []
        self._small: dict[str, bool] = {}          # snapshot path -> proven small (snapshots never change)

    def alerts(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The alerts of a batch of disrupted events, by the newest options."""
        spark = batch.sparkSession
        path = current_snapshot(spark, self.options_path)
        options = spark.read.parquet(path)
        if self.p.path_limit is not None:   # rows are bounded only under a path cap
            if path not in self._small:      # count once per snapshot, not once per batch
                self._small[path] = row_count_at_most(options, MAX_BROADCAST_ROWS)
            if self._small[path]:
                options = F.broadcast(options)
        return build_alerts(batch, options, self.p, batch_id=int(batch_id), keep=self.keep)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.partials_path is None:
            write_batch(self.alerts(batch, batch_id), self.history_path, self.run_id, self.fmt, int(batch_id))
            return
        outputs = [(self.history_path, lambda alerts, _: alerts),
                   (self.partials_path, lambda alerts, _: batch_partials(alerts, self.ties))]
        BatchOutputs(outputs, self.run_id, lambda events: self.alerts(events, batch_id))(batch, batch_id)


class AlertAndQuarantineWriter:
    """R2 + D18 from one read of the topic: the batch's alerts, and its records that don't parse."""

    def __init__(self, alerts: AlertBatchWriter, quarantine_path: str, schema=STATUS_EVENT, processed_at: Column | None = None):
        self.writer, self.schema, self.processed_at = alerts, schema, processed_at
        self.quarantine_path = quarantine_path

    def outputs(self) -> BatchOutputs:
        def parse(records: DataFrame) -> DataFrame:
            raw = F.col("value").cast("string").alias(RAW)
            kept = [c for c in records.columns if c not in ("value", "timestamp")]
            return parse_records(records.select("*", raw), self.schema, keep=[RAW, *kept])

        def alerts(parsed: DataFrame, batch_id: int) -> DataFrame:
            return self.writer.alerts(disrupted(parsed.drop(RAW), self.processed_at), batch_id)

        def unparsed(parsed: DataFrame, _: int) -> DataFrame:
            return parsed.filter(rejected(parsed, self.schema)).select(RAW, BROKER_TIME_COLUMN)

        return BatchOutputs([(self.writer.history_path, alerts), (self.quarantine_path, unparsed)], self.writer.run_id, parse)


def start_alert_stream(events: DataFrame, writer: Callable[[DataFrame, int], None], checkpoint: str,
                       trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Start the alert query over disrupted events (output of :func:`disrupted_stream`), or over broker records for
    the outputs of an :class:`AlertAndQuarantineWriter`."""
    w = events.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or DEFAULT_TRIGGER))
    if name:
        w = w.queryName(name)
    return w.start()


def start_event_sink(events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """File sink for the disrupted events themselves (exactly-once via the sink log)."""
    return (events.writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or DEFAULT_TRIGGER)).start())
