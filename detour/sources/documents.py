"""JSON documents from the transit feed, read with explicit schemas.

The feed's HTTP responses are landed as JSON files: one document per line, or, with
``multiline``, one document or one array of documents per file in any layout. What
doesn't parse is kept as text in ``_corrupt`` for the quarantine; a batch read also
numbers the documents by file and place (``doc_seq``), the order of their writes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from detour import schemas as S

CORRUPT = "_corrupt"
REQUIRED_POINT = ("id", "commonName", "lat", "lon")   # a station or stop without one can't be a node
REJECTED = "kind string, reason string, raw string"


def read_json(spark: SparkSession, path: str, schema: StructType, streaming: bool = False, multiline: bool = False,
              max_files: int | None = None) -> DataFrame:
    """``max_files``: of a batch, in a stream."""
    r = spark.readStream if streaming else spark.read
    if streaming and max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    r = r.schema(StructType([*schema.fields, StructField(CORRUPT, StringType())]))
    df = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", multiline).json(path)
    if streaming:
        return df
    return df.withColumn("doc_seq", F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place")))


def read_line_status(spark: SparkSession, path: str, streaming: bool = False, multiline: bool = False,
                     max_files: int | None = None) -> DataFrame:
    """S3: raw line records ``id, name, lineStatuses[]``, and ``_corrupt``."""
    return read_json(spark, path, S.RAW_LINE, streaming, multiline, max_files)


def landed(docs: DataFrame, path: str) -> DataFrame:
    """Parsed once, into a table: several outputs and the quarantine read it again."""
    docs.write.parquet(path)
    return docs.sparkSession.read.schema(docs.schema).parquet(path)


def parsed(docs: DataFrame) -> DataFrame:
    """The documents that parsed."""
    return docs.filter(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in docs.columns else docs


def unparsed(docs: DataFrame, kind: str) -> DataFrame:
    """The others, as rejected rows (kind, reason, raw); ``docs`` must be landed."""
    if CORRUPT not in docs.columns:
        return docs.sparkSession.createDataFrame([], REJECTED)
    return docs.filter(F.col(CORRUPT).isNotNull()).select(
        F.lit(kind).alias("kind"), F.lit("not parsed").alias("reason"), F.col(CORRUPT).alias("raw"))


def _lacks(keys: Sequence[str]) -> Column:
    lacks = F.lit(False)
    for k in keys:
        lacks = lacks | F.col(k).isNull()
    return lacks


def complete(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that have all of ``keys``."""
    return points.filter(~_lacks(keys))


def incomplete(points: DataFrame, keys: Sequence[str], kind: str) -> DataFrame:
    """The others, as rejected rows with their content."""
    return points.filter(_lacks(keys)).select(
        F.lit(kind).alias("kind"), F.lit("lacks one of " + ", ".join(keys)).alias("reason"),
        F.to_json(F.struct(*[c for c in points.columns if c not in ("seq", "doc_seq")])).alias("raw"))


def _doc_seq(docs: DataFrame) -> Column:
    """The order of the documents: their place in the files, or none where they didn't come from files."""
    return (F.col("doc_seq") if "doc_seq" in docs.columns else F.lit(0)).alias("doc_seq")


def station_points(docs: DataFrame) -> DataFrame:
    """Station documents -> one row per stop point; ``seq`` orders the writes
    (document, then list position)."""
    return parsed(docs).select(_doc_seq(docs), F.posexplode("stopPoints").alias("pos", "p")).select(
        F.struct("doc_seq", "pos").alias("seq"), "p.*")


def nearby_stop_points(docs: DataFrame) -> DataFrame:
    """Nearby-stop documents -> (station_id, seq, stop fields, lines[])."""
    return parsed(docs).select("station_id", _doc_seq(docs), F.posexplode("stopPoints").alias("pos", "s")).select(
        "station_id", F.struct("doc_seq", "pos").alias("seq"), "s.*")


def membership_points(docs: DataFrame) -> DataFrame:
    """Line membership documents -> (line_id, seq, id, stopType)."""
    return parsed(docs).select("line_id", _doc_seq(docs), F.posexplode("stops").alias("pos", "s")).select(
        "line_id", F.struct("doc_seq", "pos").alias("seq"), "s.id", "s.stopType")


def rejected_documents(station_docs: DataFrame, nearby_docs: DataFrame, member_docs: DataFrame) -> DataFrame:
    """(kind, reason, raw): documents that don't parse, and stations, stops, routes and members
    without the keys that a node or edge needs."""
    routes = nearby_stop_points(nearby_docs).select(F.explode("lines").alias("l")).select("l.*")
    parts = [unparsed(station_docs, "station document"), unparsed(nearby_docs, "nearby document"), unparsed(member_docs, "member document"),
             incomplete(station_points(station_docs), REQUIRED_POINT, "station"),
             incomplete(nearby_stop_points(nearby_docs), ("station_id", *REQUIRED_POINT), "stop"),
             incomplete(routes, ("id",), "route"), incomplete(membership_points(member_docs), ("line_id", "id"), "member")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
