"""K2 / R6 over a long time: closed batches of the history go into few large files.

The stream writes one folder a micro-batch. A compaction copies the batches that are closed (all of a
run but the newest ``keep_open``) into a segment with a date level, and appends a version to the manifest: the segments, and for
each run the batch through which it is compacted. Readers take the segments and, of the folders, only later batches,
so each alert is read once at any time: before the version is there, after it, while the stream writes
on, and when a batch that is compacted already is replayed (its folder is written again, and not read).
Segments of one level are merged into one of the next when there are ``fan_in`` of them, so a row is copied a few times,
not at each compaction. ``vacuum`` deletes what no version of the last ``grace`` needs.

Folders of names with an underscore are no partitions to Spark: what reads the plain folders goes on as before. One compaction
at a time; a folder that is overwritten while it is copied fails the copy, which then leaves nothing behind that is read.
"""

from __future__ import annotations

import uuid
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from detour.sources import manifest

COLUMNS = "segments array<struct<path:string,level:int>>, compacted array<struct<run_id:string,through:long>>"
MANIFEST, SEGMENTS, DATE = "_manifest", "_segments", "alert_date"


def _root(path: str) -> str:
    return path.rstrip("/")


def newest(spark: SparkSession, path: str) -> Row | None:
    return manifest.newest(spark, f"{_root(path)}/{MANIFEST}", COLUMNS)


def _through(version: Row | None) -> Column:
    """The batch through which the row's run is compacted, -1 for none."""
    pairs = [F.lit(x) for c in (version["compacted"] if version else []) for x in (c["run_id"], c["through"])]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col("run_id")), F.lit(-1)) if pairs else F.lit(-1)


def _folders(spark: SparkSession, path: str) -> DataFrame | None:
    """The batches' own folders; None if there are none."""
    try:
        df = spark.read.parquet(_root(path))
    except AnalysisException as e:
        if e.getCondition() not in manifest.ABSENT:
            raise
        return None
    return df.withColumns({"run_id": F.col("run_id").cast("string"), "batch_id": F.col("batch_id").cast("long")})


def _segments(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Segments are few: fewer than ``fan_in`` of a level."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [spark.read.parquet(p) for p in paths])


def read_compacted(spark: SparkSession, path: str, version: Row | None = None) -> DataFrame:
    """The history: the segments of the newest version, and the batches that it doesn't have (other folders are pruned)."""
    version = version or newest(spark, path)
    live = _folders(spark, path)
    if version is None:
        if live is None:
            raise ValueError(f"no history at {path}")
        return live
    if live is not None:
        live = live.filter(F.col("batch_id") > _through(version))
    held = _segments(spark, [s["path"] for s in version["segments"]]).drop(DATE)
    return held if live is None else live.unionByName(held, allowMissingColumns=True)


def _write_segment(rows: DataFrame, path: str) -> str:
    out = f"{_root(path)}/{SEGMENTS}/{uuid.uuid4().hex}"
    rows.hint("rebalance", DATE).write.partitionBy(DATE).parquet(out)
    return out


def compact(spark: SparkSession, path: str, keep_open: int = 1, fan_in: int = 8, clock: str = "processed_at_utc") -> bool:
    """Copy the closed batches that aren't compacted yet into a segment; whether there were any. ``clock`` is the column
    (a text or timestamp) whose date is the segments' date level."""
    if keep_open < 1:
        raise ValueError("the newest batch of a run may still be written")
    version, live = newest(spark, path), _folders(spark, path)
    if live is None:
        return False
    live = live.filter(F.col("batch_id") > _through(version))
    latest = Window.partitionBy("run_id").orderBy(F.col("batch_id").desc())
    closed = (live.select("run_id", "batch_id").distinct().withColumn("newer", F.row_number().over(latest) - 1)
              .filter(F.col("newer") >= keep_open).groupBy("run_id").agg(F.max("batch_id").alias("through"))).collect()  # a row a run
    if not closed:
        return False
    through = {r["run_id"]: r["through"] for r in closed}
    upto = F.element_at(F.create_map(*[F.lit(x) for kv in through.items() for x in kv]), F.col("run_id"))
    rows = live.filter(F.col("batch_id") <= upto)
    segments = [(s["path"], s["level"]) for s in (version["segments"] if version else [])]
    segments.append((_write_segment(rows.withColumn(DATE, F.to_date(F.substring(F.col(clock).cast("string"), 1, 10))), path), 0))
    level = 0
    while len(same := [s for s in segments if s[1] == level]) >= fan_in:
        merged = _write_segment(_segments(spark, [s[0] for s in same]), path)
        segments = [s for s in segments if s[1] != level] + [(merged, level + 1)]
        level += 1
    done = {c["run_id"]: c["through"] for c in (version["compacted"] if version else [])} | through
    manifest.append(spark, f"{_root(path)}/{MANIFEST}", COLUMNS, (segments, sorted(done.items())), version)
    return True


def vacuum(spark: SparkSession, path: str, grace_seconds: int = 86_400) -> int:
    """Delete the folders and segments that no version needs but those superseded more than ``grace_seconds`` ago; how many.

    Readers that have begun within the grace time, and the stream, keep what they read."""
    table = manifest.versions(spark, f"{_root(path)}/{MANIFEST}", COLUMNS)
    if table is None:
        return 0
    rows = table.withColumn("old", F.col("written_at") <= F.current_timestamp() - F.make_dt_interval(secs=F.lit(grace_seconds))).orderBy("version").collect()
    safe = [r for r in rows if r["old"]]
    if not safe:
        return 0
    needed = {s["path"].rpartition("/")[2] for r in rows if r["version"] >= safe[-1]["version"] for s in r["segments"]}
    done = {c["run_id"]: c["through"] for c in safe[-1]["compacted"]}
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(_root(path)).getFileSystem(spark._jsc.hadoopConfiguration())

    def listed(pattern: str) -> list:
        return [s.getPath() for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{_root(path)}/{pattern}")) or []]

    gone = [p for p in listed(f"{SEGMENTS}/*") if p.getName() not in needed and p.getName() in _superseded(rows, needed)]
    for p in listed("run_id=*/batch_id=*"):
        run = unquote(p.getParent().getName().partition("=")[2])
        if int(p.getName().partition("=")[2]) <= done.get(run, -1):
            gone.append(p)
    for p in gone:
        fs.delete(p, True)
    return len(gone)


def _superseded(rows: list[Row], needed: set[str]) -> set[str]:
    """Segments that some version had: others may be of a compaction that is still running."""
    return {s["path"].rpartition("/")[2] for r in rows for s in r["segments"]} - needed
